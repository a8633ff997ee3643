"""Column-level helpers (built-in Spark expressions only)."""

from tallyspark.functions.columns import (
    classify_patterns,
    day_shift,
    equals_one,
    hex_epoch_day,
    hex_epoch_millis,
    not_like_folded,
    nth_token,
    null_default_not_equal,
    padded_id,
    prefix,
    present_flag,
    stamp_to_day_text,
    tax_net,
    to_int,
    unknown_if_blank,
)

__all__ = [
    "classify_patterns", "day_shift", "equals_one", "hex_epoch_day", "hex_epoch_millis",
    "not_like_folded", "nth_token", "null_default_not_equal", "padded_id", "prefix",
    "present_flag", "stamp_to_day_text", "tax_net", "to_int", "unknown_if_blank",
]
