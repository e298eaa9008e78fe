"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: letters lose case and accents, homoglyphs of other scripts become
their Latin look-alikes, digits and signs that stand for letters before or
within a word are replaced, look-alikes of "l" and "i" are one letter, and
everything else separates words. Signs at the end of a word may be letters,
punctuation or a number: the word counts without them and in its further forms,
with the signs up to each change of sign as letters.

Learning (labelled rows only): terms are whole words and stems (beginnings of
words, which catch inflections). A term's weight is the log odds of occurring
in toxic against clean texts. It is kept when it is in a few toxic texts at
least (the same number whatever the input), when the lower confidence bound of
its weight is high enough, and when some toxic texts have no clearly stronger
term to blame (so terms that merely come along are left out). Two-word phrases around a lexicon term that are found in clean
texts become exception phrases; a match inside one does not count.

Score: each matched word counts its strongest term's weight; the sum over the
text's length in words is calibrated to a probability by isotonic regression on
the training rows.

Defined results: null and empty texts score as texts without a match; without
training rows of both labels the lexicon is empty and every text gets the
overall rate (0.5 without any); repeated rows get equal scores; null labels and
labels of unknown documents are not learned from; a doc_id labelled or found
more than once counts each time; equally strong terms are taken the shorter first,
then by code point; long texts are taken whole; an empty table gives an empty table;
other columns are ignored. More than MAX_ENTRIES terms or exception phrases end the job
with an error, never with a shortened lexicon.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.calibration import calibrated, histogram, isotonic
from tillstream.llm.common import crc_remainder, load, small_side, staged

MIN_DOCS = 3  # toxic texts with the word, and clean texts with an exception phrase
MIN_BLAME = 2  # toxic texts in which a lexicon term is about the strongest
MIN_BOUND = 0.8  # lower 95 % bound of the log odds
BLAME_MARGIN = 0.7  # how far below the strongest bound of its text a term still is to blame
STEMS = range(4, 9)  # letters of a stem
SHORT_TEXT = 50  # words added to every length
THRESHOLD = 0.3
BROADCAST_LABELS = 1_000_000
#: The lexicon and the exception phrases are refused beyond this many entries.
MAX_ENTRIES = 200_000
LOW, HIGH, BINS = 0.0, 0.4, 2001

# Look-alike letters (from -> to), and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i",
    "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "т": "t", "ц": "u", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e",
    "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "γ": "y", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɑ": "a",
    "ɡ": "g", "ɩ": "i",
}
#: One character that stands for several letters.
SEVERAL = {"ß": "ss", "ẞ": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl",
           "ﬅ": "st", "ﬆ": "st", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe"}
SIGNS = {
    "0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "€": "e", "£": "l", "!": "i", "|": "i", "+": "t",
}
ONE_LETTER = {"l": "i"}  # look-alikes folded into one letter

_TABLED = 0x20000
_tables: tuple[np.ndarray, np.ndarray] | None = None


def _fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """Folded letter of every code point (0: none), and letter of every sign (0: none)."""
    global _tables
    if _tables is None:
        letters, signs = np.zeros(_TABLED, np.uint32), np.zeros(_TABLED, np.uint32)
        for i in range(_TABLED):
            if 0xD800 <= i < 0xE000:
                continue
            low = unicodedata.normalize("NFKD", chr(i)).lower()[:1]
            low = HOMOGLYPHS.get(chr(i).lower(), HOMOGLYPHS.get(low, low))[:1]
            if low.isalpha():
                letters[i] = ord(ONE_LETTER.get(low, low))
        for sign, letter in SIGNS.items():
            signs[ord(sign)] = ord(ONE_LETTER.get(letter, letter))
        _tables = letters, signs
    return _tables


def _marked(texts: list[str]) -> list[str]:
    """Folded texts, in which the signs at the end of a word are left as they are."""
    letters, signs = _fold_tables()
    for one, several in SEVERAL.items():
        texts = [t.replace(one, several) if one in t else t for t in texts]
    codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"),
                          np.uint32)
    known = codes < _TABLED
    low = np.where(known, codes, 0)
    folded = np.where(known, letters[low], codes)
    sign = np.where(known, signs[low], 0)
    is_mark = (codes >= 0x300) & (codes < 0x370)  # combining marks vanish
    # a sign stands for a letter when the next character that is no sign is a letter
    place = np.arange(len(codes))
    is_plain = (sign == 0) & ~is_mark
    following = np.minimum.accumulate(np.where(is_plain, place, len(codes) - 1)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(is_plain, place, 0))
    is_sign = (sign > 0) & (folded == 0)
    final = is_sign & (folded[following] == 0) & (folded[before] > 0)
    folded = np.where(is_sign & (folded[following] > 0), sign, np.where(final, codes, folded))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))  # texts begin after a newline each
    keep = ~is_mark
    keep[1:] &= (folded[1:] > 0) | (folded[:-1] > 0) | is_mark[:-1]
    keep[bounds] = True  # the newlines between the texts stay
    shown = np.where(folded > 0, folded, 32)
    shown[bounds] = 10
    whole = shown[keep].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [" " + t.strip(" ") + " " for t in whole.split("\n")[1:-1]]


_LETTER_OF = {sign: ONE_LETTER.get(letter, letter) for sign, letter in SIGNS.items()}
_NO_SIGNS = str.maketrans("", "", "".join(SIGNS))
_FINAL = re.compile(f"([^ ]*?)([{re.escape(''.join(SIGNS))}]+) ")
_SAME = re.compile(r"(.)\1*")


def _ends(marked: str) -> Iterator[tuple[int, str, list[str]]]:
    """Place in the folded text of the blank before each word that signs follow, the word, and
    its forms with the signs as letters.
    """
    gone = 0
    for m in _FINAL.finditer(marked):
        word, signs = m.groups()
        yield m.start() - 1 - gone, word, [
            word + "".join(map(_LETTER_OF.get, signs[:run.end()])) for run in _SAME.finditer(signs)]
        gone += len(signs)


def fold(texts: list[str]) -> list[str]:
    """Folded texts: words of letters with one blank before, between and after them."""
    return [t.translate(_NO_SIGNS) for t in _marked(texts)]


def _folded(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[str, str]]:
    """Each text folded, and with the signs at the end of its words."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield from ((m.translate(_NO_SIGNS), m) for m in _marked(part))
            part, size = [], 0
    yield from ((m.translate(_NO_SIGNS), m) for m in _marked(part))


def _terms(word: str) -> list[str]:
    """A word's terms: itself, marked by a blank at its end, and its stems."""
    return [word + " ", *(word[:k] for k in STEMS if k <= len(word))]


def _end_terms(word: str, form: str) -> list[str]:
    """Terms of a word's form with signs as letters that the word itself lacks."""
    return [form + " ", *(form[:k] for k in STEMS if len(word) < k <= len(form))]


class Matcher:
    """Aho-Corasick over terms (a blank before each) and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: set[str]):
        self.weights, self.any, self.spares = weights, bool(weights), bool(exceptions)
        self.reach = max((p.count(" ") for p in exceptions), default=0)
        self.automaton = ahocorasick.Automaton()
        for term in weights:
            self.automaton.add_word(f" {term}", (term, False))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (phrase + " ", True))
        if self.any:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, str]:
        """Place of the blank before each matched word that stands in no exception phrase,
        and its strongest term.
        """
        best: dict[int, str] = {}
        spared: list[tuple[int, int]] = []
        if not self.any:
            return best
        for end, (term, is_exception) in self.automaton.iter(folded):
            begin = end - len(term)
            if is_exception:
                spared.append((begin, end))
            elif begin not in best or self.weights[term] > self.weights[best[begin]]:
                best[begin] = term
        for begin, end in spared:
            at = begin
            while 0 <= at < end:  # the words of the phrase
                best.pop(at, None)
                at = folded.find(" ", at + 1)
        return best

    def end_hits(self, folded: str, marked: str) -> Iterator[tuple[int, str, str, str]]:
        """Place, word, form and strongest term of each form with signs as letters that matches."""
        if not self.any or len(folded) == len(marked):
            return
        for at, word, forms in _ends(marked):
            for form in forms:
                found = [t for t in _end_terms(word, form) if t in self.weights]
                if found and not (self.spares and self._spared(folded, at, word, form)):
                    yield at, word, form, max(found, key=self.weights.get)

    def _spared(self, folded: str, at: int, word: str, form: str) -> bool:
        """Whether an exception phrase holds the word at ``at`` in this form."""
        first, last = at, folded.find(" ", at + 1)
        for _ in range(self.reach):  # as many words as a phrase can hold on either side
            first, last = max(folded.rfind(" ", 0, first), 0), folded.find(" ", last + 1) if (
                last + 1 < len(folded)) else last
        text = f"{folded[first:at + 1]}{form}{folded[at + 1 + len(word):last + 1]}"
        return any(is_exception and end - len(term) <= at - first < end
                   for end, (term, is_exception) in self.automaton.iter(text))

    def raw(self, folded: str, marked: str = "") -> float:
        """Weights of the matched words over the length in words."""
        best = {at: self.weights[t] for at, t in self.hits(folded).items()}
        for at, _, _, term in self.end_hits(folded, marked or folded):
            best[at] = max(best.get(at, self.weights[term]), self.weights[term])
        if not best:
            return 0.0
        return sum(best.values()) / (SHORT_TEXT + folded.count(" ") - 1)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """th, text, toxic of the documents with a label."""
    known = labels.filter("toxic in (0, 1)").select(
        F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
    known = small_side(known, BROADCAST_LABELS)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        known, F.col("doc_id") == F.col("l_id")).select(
        F.xxhash64("text").alias("th"), "text", "toxic")


def _term_rows(rows: DataFrame) -> DataFrame:
    """th, word, toxic, n: one row for each term of a toxic text; sums over clean texts."""
    schema = "th bigint, word string, toxic int, n bigint"

    def run(batches):
        def batch(th, word, toxic, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(th, pa.int64()), pa.array(word, pa.string()),
                 pa.array(toxic, pa.int32()), pa.array(n, pa.int64())],
                ["th", "word", "toxic", "n"])
        clean: Counter[str] = Counter()
        for b in batches:
            th, words = [], []
            for (t, marked), key, toxic in zip(
                    _folded(b.column("text").to_pylist()), b.column("th").to_pylist(),
                    b.column("toxic").to_pylist()):
                found = {term for word in set(t.split()) for term in _terms(word)}
                for _, word, forms in _ends(marked):
                    found.update(term for form in forms for term in _end_terms(word, form))
                if toxic:
                    th += [key] * len(found)
                    words += found
                else:
                    clean.update(found)
            if words:
                yield batch(th, words, [1] * len(words), [1] * len(words))
            if len(clean) > 500_000:
                yield batch([None] * len(clean), list(clean), [0] * len(clean),
                            list(clean.values()))
                clean.clear()
        if clean:
            yield batch([None] * len(clean), list(clean), [0] * len(clean), list(clean.values()))
    return rows.mapInArrow(run, schema)


def _lexicon(rows: DataFrame) -> dict[str, float]:
    counted = staged(_term_rows(rows), "toxic-terms")
    # copies of a toxic text count once
    toxic = counted.filter("toxic = 1").select("th", "word").distinct()
    toxic_docs = rows.filter("toxic = 1").agg(F.count_distinct("th")).first()[0]
    clean_docs = rows.filter("toxic = 0").count()
    if not toxic_docs or not clean_docs:
        return {}
    both = toxic.groupBy("word").agg(F.count("*").alias("t")).filter(F.col("t") >= MIN_DOCS).join(
        counted.filter("toxic = 0").groupBy("word").agg(F.sum("n").alias("c")), "word", "left")
    c = F.coalesce("c", F.lit(0))
    weight = (F.log((F.col("t") + 0.5) / (toxic_docs + 1.0))
              - F.log((c + 0.5) / (clean_docs + 1.0)))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (c + 0.5))
    words = staged(both.select("word", "t", weight.alias("weight"),
                               (weight - 1.96 * spread).alias("bound"))
                   .filter(F.col("bound") >= MIN_BOUND), "toxic-candidates")
    # each toxic text blames its strongest term and those close to it
    suspects = staged(toxic.join(small_side(words, MAX_ENTRIES), "word")
                      .select("th", "word", "bound"), "toxic-suspects")
    blamed = (suspects.join(suspects.groupBy("th").agg(F.max("bound").alias("most")), "th")
              .filter(F.col("bound") >= F.col("most") - BLAME_MARGIN)
              .groupBy("word").agg(F.count("*").alias("blame"))
              .filter(F.col("blame") >= MIN_BLAME))
    kept = words.join(blamed, "word").limit(MAX_ENTRIES + 1).collect()
    if len(kept) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} lexicon terms; raise MIN_BOUND")
    return _without_nested([(r["word"], r["t"], r["weight"], r["bound"]) for r in kept])


def _without_nested(found: list[tuple[str, int, float, float]]) -> dict[str, float]:
    """Leaves out a term that a stem as strong covers, and a stem no more frequent than its words."""
    lexicon: dict[str, float] = {}
    frequent: dict[str, int] = {}  # of every beginning of a kept term
    for term, t, weight, _ in sorted(found, key=lambda x: (-round(x[3], 1), not x[0].endswith(" "),
                                                           len(x[0]), x[0])):
        word = term.rstrip(" ")
        covered = any(word[:k] in lexicon for k in STEMS if k < len(term))
        if covered or (term == word and t <= 1.05 * frequent.get(word, 0)):
            continue
        lexicon[term] = weight
        for k in STEMS:
            if k <= len(word):
                frequent[word[:k]] = max(frequent.get(word[:k], 0), t)
    return lexicon


def _exceptions(rows: DataFrame, lexicon: dict[str, float]) -> set[str]:
    """Two-word phrases around a lexicon word that speak for a clean text."""
    def run(batches):
        matcher = Matcher(lexicon, set())
        for b in batches:
            seen: Counter[tuple[str, int]] = Counter()
            for (t, marked), toxic in zip(_folded(b.column("text").to_pylist()),
                                          b.column("toxic").to_pylist()):
                found = set()
                matched = [(at, None) for at in matcher.hits(t)]
                matched += [(at, form) for at, _, form, _ in matcher.end_hits(t, marked)]
                for at, form in matched:
                    before = t[max(0, t.rfind(" ", 0, at)):at].strip(" ")
                    end = t.find(" ", at + 1)
                    word, after = t[at + 1:end], t[end + 1:max(end, t.find(" ", end + 1))]
                    word = word if form is None else form
                    found |= {f"{before} {word}"} if before else set()
                    found |= {f"{word} {after}"} if after else set()
                seen.update((p, toxic) for p in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in seen], pa.string()),
                 pa.array([k for _, k in seen], pa.int32()),
                 pa.array(list(seen.values()), pa.int64())], ["phrase", "toxic", "n"])
    counts = rows.mapInArrow(run, "phrase string, toxic int, n bigint").groupBy("phrase").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    found = counts.filter((F.col("c") >= MIN_DOCS) & (F.col("c") > 2 * F.col("t"))).select(
        "phrase").limit(MAX_ENTRIES + 1).collect()
    if len(found) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} exception phrases")
    return {r["phrase"] for r in found}


def learn(docs: DataFrame, labels: DataFrame, exceptions: set[str] = frozenset()) -> dict:
    """Model from the labelled ones among ``docs``; ``exceptions`` are further phrases."""
    rows = _labelled(docs, labels)
    lexicon = _lexicon(rows)
    spared = (_exceptions(rows, lexicon) if lexicon else set()) | {
        " ".join(t.split()) for t in fold(sorted(exceptions))}
    raw = rows.select("toxic", _raw_column(lexicon, spared)(F.col("text")).alias("raw"))
    pos, n = histogram(raw, F.col("raw"), "toxic", LOW, HIGH, BINS)
    return {"lexicon": lexicon, "exceptions": spared, "curve": isotonic(pos, n, 1.0)}


def _raw_column(lexicon: dict[str, float], spared: set[str]):
    @F.arrow_udf("double")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(lexicon, spared)
        for texts in batches:
            yield pa.array([matcher.raw(*t) for t in _folded(texts.to_pylist())], pa.float64())
    return raw


def toxicity(model: dict, text: Column) -> Column:
    """Score of a text column."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(model["lexicon"], model["exceptions"])
        for texts in batches:
            raw = np.array([matcher.raw(*t) for t in _folded(texts.to_pylist())], np.float64)
            yield pa.array(calibrated(raw, LOW, HIGH, model["curve"]), pa.float64())
    return score(F.coalesce(text, F.lit("")))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    train = docs.filter(crc_remainder("doc_id", 4) != 2)
    model = learn(train, load(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"),
        toxicity(model, F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
