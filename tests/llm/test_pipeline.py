"""The pipeline stage by stage against invariants and brute force."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402

from tillstream.llm import langid, mixing, secrets, simhash_dedup  # noqa: E402
from tillstream.llm.common import staged  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), "test"))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
    assert stages[-1].columns == [*stages[0].columns, "taken"]


def test_language_stage_keeps_clean_texts(stages):
    before, after = stages[:2]
    model = langid.learn(langid.training_rows(before))
    rows = before.collect()
    _, _, rejected = langid.identify(model, [r["text"] for r in rows])
    assert ids(after) == {r["doc_id"] for r, x in zip(rows, rejected) if not x}
    assert after.count() >= 0.99 * before.count()


def test_one_of_each_near_duplicate_group(stages):
    rows = stages[1].collect()
    prints = simhash_dedup.simhash64([r["text"].encode() for r in rows])
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if int(prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    least = defaultdict(lambda: 1 << 60)
    for g, r in zip(group, rows):
        least[g] = min(least[g], r["doc_id"])
    assert ids(stages[2]) == set(least.values())


def test_no_benchmark_passage_is_left(spark, stages):
    fold = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [fold(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r["doc_id"] for r in stages[2].collect() if any(i in fold(r["text"]) for i in items)}
    assert ids(stages[2]) - ids(stages[3]) == leaking


def test_secrets_are_replaced(stages):
    before = {r["doc_id"]: r for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert before.keys() == after.keys()
    for d, r in after.items():
        base = [p for p in secrets.parts_of(before[d]["text"]) if p[1] < secrets.BASE]
        assert not [p for p in secrets.parts_of(r["text"]) if p[1] < secrets.BASE]
        assert r["n_chars"] == len(r["text"]) if base else True
        if not base and not [p for p in secrets.parts_of(before[d]["text"])]:
            assert r == before[d]


def test_mixture(stages):
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(stages[4]).collect() if r["taken"]}
    assert {r["doc_id"]: r["taken"] for r in stages[5].collect()} == want


def test_run_returns_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[-1].collect()))


def test_odd_documents_pass_all_stages(spark, odd, none):
    columns, docs = odd.columns, odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, SF).count() == 0
        docs = staged(stage(spark, docs, SF), "odd")
        assert docs.columns == columns
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.columns == [c for c in columns if c != "taken"] + ["taken"]
    out.count()
