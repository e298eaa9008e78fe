"""Exact, order-independent sums of DOUBLE amounts.

Per-row results (earned points, taxes, line totals) are plain DOUBLE
arithmetic. Totals must not depend on the order in which partitions combine,
so every amount is carried to its sum in one of these parts:

* an amount that is a whole number of 10^-4 units: two BIGINTs (high and low
  bits of the unit count), summed in generated code;
* any other amount below 10^15: a DECIMAL(38, 12);
* the rest (very large, infinite, NaN): a DOUBLE sum.

Nothing is skipped or capped; only the DOUBLE part can depend on the order.
"""

from pyspark.sql import Column, functions as F

UNIT = 10_000.0  # whole units of the BIGINT part in 1.0
_WHOLE_BELOW = 1e13
_DECIMAL_BELOW = 1e15
_LOW_BITS = 20
PARTS = ("_hi", "_lo", "_dec", "_rest")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money_parts(col) -> list[Column]:
    """The four parts of an amount, named ``PARTS``; null where a part has nothing."""
    x = _c(col)
    units = F.rint(x * F.lit(UNIT))
    whole = (F.abs(x) <= _WHOLE_BELOW) & (units / F.lit(UNIT) == x)
    count = F.when(whole, units.cast("long"))
    decimal = (F.abs(x) < _DECIMAL_BELOW) & ~whole
    return [F.shiftright(count, _LOW_BITS).alias("_hi"),
            count.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).alias("_lo"),
            F.when(decimal, x.cast("decimal(38,12)")).alias("_dec"),
            F.when(~whole & ~decimal, x).alias("_rest")]


def part_sums(prefix: str = "") -> list[Column]:
    """Aggregates that add up columns named ``PARTS``."""
    return [F.sum(prefix + p).alias(p) for p in PARTS]


def money_total(hi: Column, lo: Column, dec: Column, rest: Column) -> Column:
    """Summed parts -> DOUBLE. Nothing summed gives 0.0."""
    def zero(c):
        return F.coalesce(c.cast("decimal(30,0)"), F.lit(0).cast("decimal(30,0)"))
    units = (zero(hi) * F.lit(1 << _LOW_BITS) + zero(lo)).cast("decimal(34,0)")
    whole = (units * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(37,12)")
    decimal = F.coalesce(dec.cast("decimal(37,12)"), F.lit(0).cast("decimal(37,12)"))
    return (whole + decimal).cast("double") + F.coalesce(rest, F.lit(0.0))


def total_of(prefix: str = "") -> Column:
    """``money_total`` of columns named ``PARTS``."""
    return money_total(*[F.col(prefix + p) for p in PARTS])


def money_sum(col) -> Column:
    """Aggregate: total of an amount column as DOUBLE; an all-null group gives 0.0."""
    return money_total(*[F.sum(p) for p in money_parts(col)])
