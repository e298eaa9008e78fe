"""The stream that the fan-out reads: whole invoices, built once; the cut's own lines."""

import re

import pytest
from pyspark.sql import functions as F

from support import SF001
from tillstream.plans import streams
from tillstream.session import utc
from tillstream.sources import adapters


def _stream_folders(df) -> list[str]:
    """The folder that a file stream reads."""
    return re.findall(r"FileSource\[([^\]]+)\]", df._jdf.queryExecution().analyzed().toString())


@pytest.mark.parametrize("in_time", [True, False])
def test_the_fanout_streams_whole_invoices(spark, in_time):
    """The tables are joined before the stream, not in every micro-batch of every output."""
    with utc(spark):
        inv = streams._invoice_stream(spark, SF001, in_time)
        assert inv.isStreaming
        assert "Join" not in inv._jdf.queryExecution().analyzed().toString()
        batch = adapters.invoices(spark, SF001)
        rows = spark.read.schema(inv.schema).parquet(*_stream_folders(inv))
        assert inv.columns == batch.columns
        assert rows.exceptAll(batch).count() == batch.exceptAll(rows).count() == 0


def test_parts_in_time_are_ordered(spark):
    """Store sales drop what comes behind the watermark: a part's files follow the earlier ones."""
    inv = streams._invoice_stream(spark, SF001)
    files = spark.read.schema(inv.schema).parquet(*_stream_folders(inv)).select(
        F.col("_metadata.file_modification_time").alias("at"), "event_time").groupBy("at").agg(
        F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).orderBy("at").collect()
    assert len(files) >= streams.PARTS_OF_TABLE
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


def test_cut_reads_the_lines_of_its_own_part(spark, monkeypatch):
    seen, build = [], adapters.invoices

    def invoices(spark, sf_dir, **kw):
        seen.append({r[0] for r in kw["lineitem"].selectExpr("l_orderkey % 4").distinct().collect()})
        return build(spark, sf_dir, **kw)
    monkeypatch.setattr(adapters, "invoices", invoices)
    streams.fanout_consistent_cut(spark, SF001)
    assert seen == [{0}, {1}, {2}, {2}, {3}]
