"""Column functions: text in, typed values out."""

from tapeloom.functions.measures import category, earning_per_share, guarded_ratio, total_return
from tapeloom.functions.text import clean_percent, clean_price, strip_rupee, to_float
from tapeloom.functions.times import formatted, parse_timestamp

__all__ = [
    "category",
    "clean_percent",
    "clean_price",
    "earning_per_share",
    "formatted",
    "guarded_ratio",
    "parse_timestamp",
    "strip_rupee",
    "to_float",
    "total_return",
]
