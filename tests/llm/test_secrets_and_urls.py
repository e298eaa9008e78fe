import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from tillstream.llm import secrets, urlfilter

HEX = "0123456789abcdef" * 2
CASES = [
    "token = \"" + HEX + "\"", "PASSWORD:hunter22", "api_key='abc'", "apikey=abcdefgh secret: 1234567",
    "AKIA" + "A" * 12 + " AKIA123", "x" + HEX + HEX + "g", "paſſword=abcdefgh", "toKen=abcdefgh",
    "secret=\"password=abcdefgh", "😀 token=12345678 é password=ABCDEFGH1", HEX[:31], "", "AKIAtoken=AKIA00000000000000",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_equal_the_plain_patterns(text):
    want = []
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
                        r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""")
    for kind, (pattern, ok) in enumerate([
            (assign, lambda m: len(m[2]) >= 8), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
            (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]):
        want += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    assert [p for p in secrets.parts_of(text) if p[1] < 3] == sorted(want)


def test_weak_parts_need_a_complement(spark, odd, none):
    far = " padding" * 40
    rows = [
        (1, "user: alice then pwd=abc12 here"),              # both weak parts, linked
        (2, "user: alice and nothing else"),                  # alone
        (3, "user: alice" + far + " pwd=abc12"),              # out of scope
        (4, "mail bob@example.com near token=abcdefgh1"),     # a base secret complements the mail
        (5, "see https://db.example.com/x with a1b2c3d4e5f6g7h8i9 ok"),  # endpoint and random token
        (6, "see https://db.example.com/x only"),
        (1, "user: alice"),                                   # another text of doc 1
        (7, "token=abcdefgh1"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], [secrets.KINDS[p["kind"]] for p in r["spans"]])
                 for r in secrets.scan(docs).collect())
    assert got == [(1, []), (1, ["user", "weak"]), (2, []), (3, []), (4, ["user", "assign"]),
                   (5, ["endpoint", "weak"]), (6, []), (7, ["assign"])]
    clean = {(r["doc_id"], r["text"]) for r in secrets.redacted(docs).collect()}
    assert (1, "<secret> then <secret> here") in clean and (2, rows[1][1]) in clean
    assert (4, "mail <secret> near <secret>") in clean and (1, "user: alice") in clean
    out = secrets.redacted(odd)
    assert out.dtypes == odd.dtypes
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert secrets.scan(none).count() == 0 and secrets.redacted(none).count() == 0
    assert [len(r["spans"]) for r in secrets.scan(odd).collect()] == [0] * odd.count()


def test_interval_join_equals_brute_force(spark):
    import random
    rng = random.Random(2)
    rows = []
    for d in range(6):
        text = ""
        for _ in range(120):
            text += rng.choice(["user: alice ", "pwd=abc12 ", "x" * rng.randrange(90) + " ",
                                "http://h.example/p ", "token=abcdefgh1 ", "\n\n"])
        rows.append((d, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: [(p["start"], p["kind"], p["end"]) for p in r["spans"]]
           for r in secrets.scan(docs, scope=40).collect()}
    for d, text in rows:
        every = secrets.parts_of(text)
        want = []
        for s, k, e in every:
            own = secrets.ROLE[secrets.KINDS[k]]
            fits = [secrets.ROLE[secrets.KINDS[k2]] for s2, k2, e2 in every
                    if max(s2 - e, s - e2) <= 40]
            if k < 3 or any(r == "secret" if own == "access" else r != own for r in fits):
                want.append((s, k, e))
        assert got[d] == want


def test_digest_of_the_query(spark, tmp_path):
    text = "é token=abcdefgh1 x " + HEX
    spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in secrets.op6_secret_scan(spark, str(tmp_path)).collect()}
    listed = f"assign:2:17,hex:20:{20 + len(HEX)}"
    assert rows[1]["spans"] == listed and rows[1]["n_assign"] == rows[1]["n_hex"] == 1
    assert rows[1]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert rows[2]["spans"] == "" and rows[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()


# -- urls

def judged(spark, urls, **settings):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return {r["page_id"]: r for r in urlfilter.judge(df, **settings).collect()}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("https://www.example.net/de/", "www.example.net", "/de/", "net/", "block"),
        ("https://badexample.com/de/1", "badexample.com", "/de/1", None, None),
        ("x://example.com/de/://org/fr/", "example.com", "/de/://org/fr/", "example.com/de/", "block"),
        ("http://net", "net", "", None, None),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://a.org?x=/fr/", "a.org", "", None, None),
        ("http://a.org/fr/#q", "a.org", "/fr/", "org/fr/", "allow"),
        ("a.org/fr/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("http://É.NET/Ü", "É.net", "/Ü", "net/", "block"),
        ("http://a\nb.net/c", "a\nb.net", "/c", "net/", "block"),
    ]
    got = judged(spark, [c[0] for c in cases])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_mining_equals_brute_force(spark):
    import random
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        t = sorted({rng.choice("abcd"), rng.choice("efg"), rng.choice("hi")})
        bad = "a" in t and "e" in t or "h" in t and "g" in t and rng.random() < .95
        rows.append((t, "block" if bad else "allow"))
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    support, confidence = 0.02, 0.9
    rules = {}
    for k in (1, 2, 3):
        for x in itertools.combinations("abcdefghi", k):
            has = [v for t, v in rows if set(x) <= set(t)]
            for v in ("allow", "block"):
                n = has.count(v)
                if n and n >= support * len(rows) and n / len(has) >= confidence:
                    rules[x, v] = (n / len(has), n / len(rows))
    kept = {(x, v): c for (x, v), c in rules.items() if not any(
        v2 == v and set(y) < set(x) and len(y) == len(x) - 1 and c2[0] >= c[0]
        for (y, v2), c2 in rules.items())}
    mined = urlfilter.mine(df, support, confidence)
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"])
           for r in mined.collect()}
    assert got.keys() == kept.keys()
    assert all(abs(got[k][i] - kept[k][i]) < 1e-9 for k in got for i in (0, 1))
    sets = spark.createDataFrame([(sorted(t),) for t in {tuple(t) for t, _ in rows}],
                                 "tokens array<string>")
    said = {tuple(r["tokens"]): r["mined_verdict"]
            for r in urlfilter.matched(sets, mined).collect()}
    for t in {tuple(t) for t, _ in rows}:
        fits = [(-c, -s, v, x) for (x, v), (c, s) in kept.items() if set(x) <= set(t)]
        assert said.get(t) == (min(fits)[2] if fits else None)


def test_url_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = urlfilter.judge(pages.withColumn("host", F.lit("clash")).withColumn("tokens", F.lit(1)))
    rows = out.collect()
    assert len(rows) == pages.count() and {r["verdict"] for r in rows} == {"allow", "block"}
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_very_many_parts_in_one_text():
    """100,000 parts in one text: seconds, and the spans of the plain form."""
    import random
    import time
    rng = random.Random(3)
    pieces = ["password=abcdefgh{}", "{:032x}", "AKIA{:016X}", "u{}@mail.example.com", "http://h{}.example/x",
              "user=name{}", "tok{:x}Zq9fA3kLm8{}", "plain words {}"]
    text = " ".join(rng.choice(pieces).format(i, i) for i in range(110_000))
    start = time.time()
    got = secrets.parts_of(text)
    assert time.time() - start < 30 and len(got) > 80_000
    small = text[:6000]
    taken = []
    for s, k, e in sorted(secrets.parts_of(small), key=lambda p: p[1] >= 3):
        if k >= 3:  # a later kind overlaps no other part
            assert not any(s < b and a < e for a, b in taken)
        taken.append((s, e))
    assert secrets._merged([(5, 9), (1, 3), (3, 4), (8, 12)]) == ([1, 5], [4, 12])


def test_rules_on_deeper_segments_and_query_keys(spark):
    rows = [(i, f"http://h{i % 9}.net/x/a{i}/ads/b{i}" if i % 2 else f"http://h{i % 9}.example.net/en/a{i}/ok/c")
            for i in range(400)]
    rows += [(1000 + i, f"http://w{i}.biz/z/y/ads/x{i}") for i in range(5)] + [
        (2000 + i, f"http://w{i}.biz/z/y/ok/x{i}?b=1") for i in range(5)]
    rows += [(3000 + i, f"http://k{i}.net/p{i}?track{i}=1&u=2") for i in range(300)] + [
        (4000 + i, f"http://v{i}.info/p?a=1&track{i}=3#u") for i in range(5)] + [
        (5000, None), (5001, "no url")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r.page_id: r for r in urlfilter.judge(pages).collect()}
    assert {got[1000 + i].verdict for i in range(5)} == {"block"}
    assert {got[1000 + i].mined for i in range(5)} == {"p:ads"}
    assert {got[2000 + i].verdict for i in range(5)} == {"allow"}
    assert {got[4000 + i].verdict for i in range(5)} == {"block"}
    assert {got[4000 + i].mined for i in range(5)} <= {"q:track#", "q:u", "n:1"}
    assert got[5000].verdict == got[5001].verdict == "allow"
