from tierline.functions.collation import BINARY, sort_key
from tierline.functions.columns import (
    blank_to_null,
    half_up_ratio,
    is_present,
    matches,
    month_of,
    to_type,
    to_whole_number,
)

__all__ = [
    "BINARY",
    "blank_to_null",
    "half_up_ratio",
    "is_present",
    "matches",
    "month_of",
    "sort_key",
    "to_type",
    "to_whole_number",
]
