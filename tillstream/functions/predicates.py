"""Case-insensitive value tests used by the filters and conditional columns.

A null input gives null, which a filter treats as false: such rows are
dropped instead of stopping the job.
"""

from pyspark.sql import Column, functions as F

from tillstream.constants import HOME_DELIVERY, PRIME


def equals_ignore_case(col, value: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(c) == F.lit(value.upper())


def is_home_delivery(col="deliveryType") -> Column:
    return equals_ignore_case(col, HOME_DELIVERY)


def is_prime(col="customerType") -> Column:
    return equals_ignore_case(col, PRIME)
