"""Language ID, quality, toxicity: held-out accuracy, parts against brute force, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import calibration, langid, quality, toxicity
from tillstream.llm.common import crc_remainder

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF01}/labels.parquet")


# -- language ID

def test_gram_counts_equal_a_plain_count():
    texts = ["Ab c", "", "the the", "1 2", "é😀x y"]
    counts, n = langid.gram_counts(texts)
    assert list(n) == [3, 0, 6, 0, 3]
    for i, t in enumerate(texts):
        marked, gap = [], False
        for c in t.lower():
            if c.isalpha():
                marked.append(c)
                gap = True
            elif gap:
                marked.append(" ")
                gap = False
        if gap:
            marked.append(" ")
        letters = sum(c != " " for c in marked)
        assert counts[i].sum() == letters + max(0, len(marked) - 1) + max(0, len(marked) - 2)
    alone, _ = langid.gram_counts(texts[:1])
    assert (alone[0] == counts[0]).all()  # a text's counts do not depend on its neighbours


def test_language_held_out_accuracy(docs, odd, none):
    model = langid.learn(langid.training_rows(docs))
    out = docs.filter(crc_remainder("doc_id", 4) == 2).select(
        "lang", langid.identified(model, F.col("text")).alias("r")).collect()
    assert np.mean([r["lang"] == r["r"]["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["r"]["score"] <= 1 for r in out)
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    cyrillic = langid.identify(model, ["Съешь же ещё этих мягких французских булок " * 20])
    assert cyrillic[2][0]  # far from every centroid
    got = odd.select("text", langid.identified(model, F.col("text")).alias("r")).collect()
    for r in got:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["r"]["lang_pred"] == "und") == (not lettered)
        assert lettered or (r["r"]["score"] == 0 and r["r"]["rejected"])
    assert len({(r["r"]["lang_pred"], r["r"]["score"]) for r in got if r["text"] is None}) == 1
    assert langid.accepted(odd, model).columns == odd.columns
    assert langid.accepted(none, model).count() == 0


def test_language_learns_from_odd_and_no_rows(odd, none):
    model = langid.learn(odd)
    assert set(model["langs"]) <= {"en", "de", "fr"}
    empty = langid.learn(none)
    assert langid.identify(empty, ["abc"])[0] == ["und"]
    assert langid.accepted(odd, empty).count() == 0


# -- calibration

def test_isotonic():
    pos, n = np.array([0, 3, 0, 1, 5, 0.0]), np.array([4, 4, 0, 4, 5, 0.0])
    curve = calibration.isotonic(pos, n, 1e-9)
    assert (np.diff(curve) >= 0).all()
    assert np.allclose(curve[[0, 1, 3, 4]], [0, .5, .5, 1], atol=1e-6)  # 3/4 and 1/4 are pooled
    assert (calibration.isotonic(np.zeros(4), np.zeros(4), 1.0) == 0.5).all()


# -- quality

def test_quality_held_out(docs, labels, odd, none):
    stats = quality.statistics(docs)
    model = quality.learn(stats.filter(crc_remainder("doc_id", 3) != 1), labels)
    out = stats.filter(crc_remainder("doc_id", 3) == 1).join(labels, "doc_id").select(
        "quality", quality.quality(model, F.col("x")).alias("s")).collect()
    assert np.mean([(r["s"] >= 0.5) == r["quality"] for r in out]) > 0.95
    got = quality.statistics(odd).select(quality.quality(model, F.col("x")).alias("s")).collect()
    assert len(got) == odd.count() and all(0 <= r["s"] <= 1 for r in got)
    assert quality.statistics(none).count() == 0
    blank = quality.learn(quality.statistics(none), labels.limit(0))
    assert [r["s"] for r in quality.statistics(odd).limit(2).select(
        quality.quality(blank, F.col("x")).alias("s")).collect()] == [0.5, 0.5]


def test_normal_equations_equal_direct_sums(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(quality.STATISTICS)))
    y, half = rng.integers(0, 2, 200), rng.integers(0, 2, 200)
    rows = spark.createDataFrame(
        [(a.tolist(), int(b), int(c)) for a, b, c in zip(x, y, half)],
        "x array<double>, quality int, half bigint").repartition(3)
    model = {"mean": x.mean(0), "spread": x.std(0)}
    parts = quality._normal_equations(rows, model)
    z = quality._fourier(x, model)
    for h in (0, 1):
        zz, zy, n = parts[h]
        assert n == (half == h).sum()
        assert np.allclose(zz, z[half == h].T @ z[half == h])
        assert np.allclose(zy, z[half == h].T @ y[half == h])


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, len(quality.STATISTICS)))
    z = quality._fourier(x, {"mean": 0.0, "spread": 1.0})[:, :-1]
    exact = np.exp(-quality.GAMMA * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).mean() < 0.1


# -- toxicity

def test_fold():
    assert toxicity.fold(["You IDI0T!! tra5h### 123 (l0ser) сlоwn $tupid", "", "  ", "ÉA\nb",
                          "ídiot ＩＤＩＯＴ", "😀"]) == [
        " you idiot trash ioser ciown stupid ", "  ", "  ", " ea b ", " idiot idiot ", "  "]


def test_matcher_exceptions_and_stems():
    m = toxicity.Matcher({"moron ": 2.0, "vequ": 3.0, "vequa ": 1.0}, {"oxy moron", "moron vaiiey"})  # folded
    hits = lambda t: sorted(m.hits(toxicity.fold([t])[0]).values())
    assert hits("a moron, and M0RON!") == ["moron ", "moron "]
    assert hits("morons oxy moron moron valley") == []
    assert hits("vequa vequt xvequ") == ["vequ", "vequ"]
    assert toxicity.Matcher({}, set()).hits(" moron ") == {}


def test_toxicity_held_out(docs, labels, odd, none):
    train = docs.filter(crc_remainder("doc_id", 4) != 2)
    model = toxicity.learn(train, labels)
    out = docs.filter(crc_remainder("doc_id", 4) == 2).join(labels, "doc_id").select(
        "toxic", toxicity.toxicity(model, F.col("text")).alias("s")).collect()
    right = [(r["s"] >= toxicity.THRESHOLD) == r["toxic"] for r in out]
    assert np.mean(right) > 0.9
    lure = docs.sparkSession.createDataFrame(
        [("a b c d e f ldi0t he was a stup1d m0r0n, trаsh",), ("a b c d e f he was kind",)], "t string")
    high, low = [r["s"] for r in lure.select(toxicity.toxicity(model, F.col("t")).alias("s")).collect()]
    assert high >= toxicity.THRESHOLD > low
    got = odd.select(toxicity.toxicity(model, F.col("text")).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in got)
    blank = toxicity.learn(none, labels)
    assert blank["lexicon"] == {}
    assert {r["s"] for r in odd.select(toxicity.toxicity(blank, F.col("text")).alias("s")).collect()
            } == {0.5}


def test_signs_at_the_end_of_a_word():
    m = toxicity.Matcher({"hate ": 2.0, "heii ": 3.0, "ass ": 1.0, "idiots ": 2.0, "damn ": 1.0},
                         {"ciass ass"})
    raw = lambda t: m.raw(*next(toxicity._folded([t]))) * (toxicity.SHORT_TEXT + len(t.split()))
    assert raw("I hat3 you") == raw("hat3") == 2.0
    assert raw("go to hel1, h3l1!") == 6.0
    assert raw("an a55! and a55?") == 2.0 and raw("IDIOT5") == 2.0
    # closing punctuation and numbers do no harm, an exception holds for the form it names
    assert raw("damn! damn1 damn") == 3.0
    assert raw("hat 3, as 55 and mambo5!") == 0.0
    assert raw("class a55") == 0.0 and raw("class hat3") == 2.0
    # the forms are learned from, each text once
    assert toxicity.fold(["hat3 a55! me2"]) == [" hat a me "]


def test_rare_certain_terms_are_learned_at_any_size(spark):
    rows = [(i, f"you moron number {chr(97 + i % 26)}x of row q{i % 50}z", 1) for i in range(2000)]
    rows += [(2000 + i, f"what a zuckling of row q{i}z", 1) for i in range(7)]
    rows += [(3000 + i, f"a kind number {chr(97 + i % 26)}x of what row q{i % 50}z", 0)
             for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(4)
    model = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    m = toxicity.Matcher(model["lexicon"], model["exceptions"])
    assert m.raw(*next(toxicity._folded(["you moron"]))) > 0
    assert m.raw(*next(toxicity._folded(["a zuckling"]))) > 0
    assert m.raw(*next(toxicity._folded(["a kind row"]))) == 0


def test_one_character_for_several_letters():
    assert toxicity.fold(["straße STRAẞE ﬁne æon"]) == [" strasse strasse fine aeon "]


def test_phrases_of_long_words_and_many_hits_in_one_text(spark):
    """Exceptions with words of any length; time in proportion to a text's hits."""
    import time
    long = "x" * 2000
    rows = [(f"moron {long} day", 0)] * 30 + [("you moron number", 1)] * 60
    table = spark.createDataFrame(rows, "text string, toxic int")
    assert f"moron {long}" in toxicity._exceptions(table, {"moron ": 2.0})
    m = toxicity.Matcher({"hate ": 2.0, "ass ": 1.0}, {"ciass ass", "i hate to say"})
    text = "an a55! class a55? i hat3 to say hat3 and hat3 " * 20_000
    start = time.time()
    hits = list(m.end_hits(*next(toxicity._folded([text]))))
    assert time.time() - start < 30
    assert len(hits) == 3 * 20_000  # "an a55", "say hat3" and "and hat3"
