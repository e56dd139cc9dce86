"""Column-level helpers: plain ``Column`` expressions, no UDFs."""

from paylater.functions.dates import day_diff, day_of_week0, days_before
from paylater.functions.keys import surrogate_key
from paylater.functions.money import money_avg, money_sum, rate_avg, ratio, sorted_set, text_null_concat

__all__ = [
    "surrogate_key", "day_diff", "day_of_week0", "days_before",
    "money_sum", "money_avg", "ratio", "sorted_set", "text_null_concat",
]
