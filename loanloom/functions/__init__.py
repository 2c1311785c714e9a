"""Column builders. Each takes and returns ``Column`` and stays inside generated code."""

from loanloom.functions.labels import binary_label, class_weight
from loanloom.functions.shares import share_percent
from loanloom.functions.splits import hash_bucket
from loanloom.functions.text import parse_failed, split_item, unit_value

__all__ = [
    "binary_label",
    "class_weight",
    "hash_bucket",
    "parse_failed",
    "share_percent",
    "split_item",
    "unit_value",
]
