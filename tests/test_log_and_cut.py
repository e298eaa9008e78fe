"""Dense offsets and bounded replay, one cut over four outputs, stored intake metrics."""

from collections import Counter

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import SF001
from tillstream.constants import (HADOOP_OUTPUT, LOYALTY_OUTPUT, SHIPMENT_OUTPUT,
                                  STORE_SALES_OUTPUT)
from tillstream.operators import loyalty, stateless, store_sales
from tillstream.operators.metrics import intake_summary, observe_intake
from tillstream.session import scratch_path, utc
from tillstream.sources import adapters
from tillstream.sources.log import read_log, with_offsets, write_log
from tillstream.sources.tables import read_table
from tillstream.streaming import cut
from tillstream.streaming.intake import IntakeTable, read_intake
from tillstream.streaming.sinks import run_bounded

SLOW = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(max_examples=12, **SLOW)
@given(st.lists(st.tuples(st.sampled_from([0, 1, None]), st.integers(0, 90)), max_size=40),
       st.integers(1, 50))
def test_offsets_are_dense_in_order_of_arrival(spark, rows, width):
    rows = [(p, at, i) for i, (p, at) in enumerate(rows)]
    df = spark.createDataFrame(rows, "partition int, at int, i int")
    got = with_offsets(df, ["at", "i"], F.floor(F.col("at") / width)).collect()
    want = {}
    for p in (0, 1, None):
        for n, r in enumerate(sorted((r for r in rows if r[0] == p), key=lambda r: r[1:])):
            want[r[2]] = n
    assert {r.i: r.offset for r in got} == want and len(got) == len(rows)


def test_bounded_replay_prunes(spark, tmp_path):
    df = spark.range(20_000).select(
        (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("at"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))
    path = str(tmp_path / "log")
    write_log(with_offsets(df, ["at"], F.floor(F.col("at") / 700)), path, files=6)
    out = read_log(spark, path, 1, 100, 150)
    assert sorted((r.offset, r.value) for r in out.collect()) == [
        (n, f"v{3 * n + 1}") for n in range(100, 150)]
    assert read_log(spark, path, 2).count() == 6666 and read_log(spark, path, 7).count() == 0
    pushed = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = pushed[pushed.index("PushedFilters"):]
    for part in ("EqualTo(partition,1)", "GreaterThanOrEqual(offset,100)", "LessThan(offset,150)"):
        assert part in pushed
    spans = []
    for f in out.inputFiles():
        meta = pq.read_metadata(f.removeprefix("file:"))
        names = [meta.schema.column(i).name for i in range(len(meta.schema))]
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("partition", "offset")]
            spans.append([(s.min, s.max) for s in stats])
    assert len(spans) >= 4
    hit = [s for s in spans if s[0][0] <= 1 <= s[0][1] and s[1][0] < 150 and s[1][1] >= 100]
    assert 0 < len(hit) <= 2, "a replay of 50 records reads the row groups that can hold them"


class Failure(RuntimeError):
    pass


def _cut_counts(spark, root):
    return {n: cut.read_cut(spark, root, n).count() for n in
            (SHIPMENT_OUTPUT, HADOOP_OUTPUT, LOYALTY_OUTPUT, STORE_SALES_OUTPUT)}


@pytest.mark.parametrize("after", [SHIPMENT_OUTPUT, LOYALTY_OUTPUT, STORE_SALES_OUTPUT])
def test_failed_batch_is_in_no_output_and_its_replay_in_each_once(spark, invoices, after):
    root = scratch_path(spark, "cut-test")
    old, new = invoices.where("k <= 3"), invoices.where("k > 3")

    def fail(name, batch_id):
        if name == after and batch_id == 1:
            raise Failure
    with utc(spark):
        assert set(_cut_counts(spark, root).values()) == {0}
        cut.cut_writer(root)(old, 0)
        first = _cut_counts(spark, root)
        assert first == {SHIPMENT_OUTPUT: 2, HADOOP_OUTPUT: 4, LOYALTY_OUTPUT: 1,
                         STORE_SALES_OUTPUT: 12}
        with pytest.raises(Failure):
            cut.cut_writer(root, fail)(new, 1)
        assert _cut_counts(spark, root) == first
        cut.cut_writer(root)(new, 1)
        cut.cut_writer(root)(old, 1)  # replayed after its commit: left as it is
        ship = cut.read_cut(spark, root, SHIPMENT_OUTPUT)
        assert Counter(r.invoiceNumber for r in ship.collect()) == Counter(
            r.invoiceNumber for r in stateless.shipment_filter(invoices).collect())
        lines = cut.read_cut(spark, root, HADOOP_OUTPUT)
        want = stateless.hadoop_records(invoices, keep=("key",))
        assert sorted(map(repr, lines.select(*want.columns).collect())) == sorted(
            map(repr, want.collect()))
        cards = cut.read_cut(spark, root, LOYALTY_OUTPUT)
        assert sorted(map(repr, cards.collect())) == sorted(
            map(repr, loyalty.loyalty_latest(invoices).select(*cards.columns).collect()))
        sales = cut.read_cut(spark, root, STORE_SALES_OUTPUT)
        assert sorted(map(repr, sales.collect())) == sorted(
            map(repr, store_sales.hopping_store_sales(invoices).collect()))
        assert cut.committed_batches(spark, root).count() == 2


def test_intake_rows_of_every_batch(spark):
    root = scratch_path(spark, "intake-test")
    orders = read_table(spark, SF001, "orders")
    parts = [orders.where(F.col("o_orderkey") % 3 == i) for i in range(3)]

    def invoices(of):
        return adapters.invoices(spark, SF001, lines=False, items=False, address=False, orders=of)
    with utc(spark), IntakeTable(spark, f"{root}/table"):
        for p in parts:
            p.write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(orders.schema).parquet(f"{root}/in")
            run_bounded(observe_intake(invoices(stream)), f"{root}/ck", "append", ("noop", root))
    with utc(spark):
        got = {r.batch_id: r for r in read_intake(spark, f"{root}/table").collect()}
        assert sorted(got) == [0, 1, 2]
        for i, p in enumerate(parts):
            want = intake_summary(invoices(p)).first().asDict()
            assert {k: got[i][k] for k in want} == want
        # nothing is stored after the listener has been removed
        run_bounded(observe_intake(invoices(spark.readStream.schema(orders.schema).parquet(
            f"{root}/in"))), f"{root}/other", "append", ("noop", root))
        assert read_intake(spark, f"{root}/table").count() == 3


def test_empty_intake_table(spark):
    assert read_intake(spark, scratch_path(spark, "no-intake")).count() == 0
