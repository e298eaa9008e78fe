"""Column-level building blocks (all native Spark expressions, no Python UDFs)."""

from tillstream.functions.predicates import is_home_delivery, is_prime, equals_ignore_case
from tillstream.functions.money import (
    money_parts, money_sum, money_total, part_sums, total_of,
)
from tillstream.functions.time import event_time_from_millis, millis_of, now_millis

__all__ = [
    "is_home_delivery", "is_prime", "equals_ignore_case",
    "money_parts", "money_sum", "money_total", "part_sums", "total_of",
    "event_time_from_millis", "millis_of", "now_millis",
]
