"""Prefix aggregates in a given order, spread over buckets.

A plain window per key sorts all rows of the key in one task. Here a window runs
within each (key, bucket) only; the aggregate of a key's earlier buckets comes from
one row for each (key, bucket), aggregated map-side, prefix-aggregated per key and
joined back.

Buckets can be a function of the order (such as the hour): the key's rows are then
shuffled once, without sampling or a job while the plan is built, but rows that all lie
in one bucket are one window group. ``sliced`` gives buckets of even size instead,
whatever the keys and the order look like: the rows are range-partitioned by key and
order, numbered by their range and written down, and both sides read what was written
(the input's last stage runs twice, for the range bounds and for the rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillstream.session import scratch_path

#: How a value is aggregated: the function, and what combines two of its results.
KINDS = ("sum", "max", "min", "count")


def plus(a: Column, b: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):  # one digit less, so that the sum keeps its scale
        narrow = f"decimal({kind.precision - 1},{kind.scale})"
        return a.cast(narrow) + b.cast(narrow)
    return a + b


def sliced(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None,
           name: str = "slices") -> DataFrame:
    """The rows with ``_slice``, the number of their range of (keys, order): a bucket for
    ``prefix``. Ranges are about equally large (rows of equal key and order stay together);
    their number is ``slices``, or four times the session's shuffle partitions, so that the
    ranges spread evenly over tasks."""
    spark = df.sparkSession
    n = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    df.repartitionByRange(n, *keys, *order).withColumn(
        "_slice", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def prefix(df: DataFrame, keys: list[str], order: list[Column | str], values: dict[str, str],
           bucket: Column, out: str = "run_") -> DataFrame:
    """Adds ``<out><value>``: the aggregate of the value over the key's rows up to and
    including this one in ``order``.

    ``values`` maps a column to "sum", "count", "max" or "min". ``bucket`` is a whole
    number that must follow ``order`` (a lesser bucket for earlier rows only); a null one
    is the first. Null keys are one group; null values count as nothing, so a maximum
    without any value is null and a sum without any is 0.
    """
    if unknown := set(values.values()).difference(KINDS):
        raise ValueError(f"unknown aggregate {sorted(unknown)}")
    # (text, null flag) stands for a key and no bucket is null, so that plain equality joins
    # and the rows stay where the window's shuffle has put them
    names = [(k, f"_k{i}", f"_n{i}") for i, k in enumerate(keys)]
    own = [c for _, k, n in names for c in (k, n)]
    group = own + ["_bucket"]
    d = df.withColumns({**{k: F.coalesce(F.col(c).cast("string"), F.lit("")) for c, k, _ in names},
                        **{n: F.col(c).isNull() for c, _, n in names},
                        "_bucket": F.coalesce(bucket.cast("bigint"), F.lit(-(1 << 63)))})
    kinds = {v: d.agg(getattr(F, how)(v).alias(v)).schema[v].dataType
             for v, how in values.items()}

    def start(c: Column, v: str) -> Column:
        return F.coalesce(c, F.lit(0).cast(kinds[v])) if values[v] in ("sum", "count") else c

    def both(a: Column, b: Column, v: str) -> Column:
        if values[v] in ("sum", "count"):
            return plus(start(a, v), start(b, v), kinds[v])
        return F.greatest(a, b) if values[v] == "max" else F.least(a, b)
    upto = (Window.partitionBy(*group).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.select("*", *[getattr(F, how)(v).over(upto).alias(f"_in_{v}")
                            for v, how in values.items()])
    ends = d.groupBy(*group).agg(*[getattr(F, how)(v).alias(v) for v, how in values.items()])
    earlier = (Window.partitionBy(*own).orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    combine = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
    offsets = ends.select(*group, *[
        combine[how](v).over(earlier).cast(kinds[v]).alias(f"_before_{v}")
        for v, how in values.items()])
    return local.join(offsets, group).select(*df.columns, *[
        both(F.col(f"_in_{v}"), F.col(f"_before_{v}"), v).alias(f"{out}{v}") for v in values])
