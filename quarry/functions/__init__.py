"""Column expressions.  Everything here returns a ``pyspark.sql.Column`` built
from built-in functions, so it stays inside whole-stage codegen."""

from quarry.functions.binning import bucketize
from quarry.functions.numeric import lossless, ratio, round_half_up, round_python, round_ratio, total
from quarry.functions.parsing import (
    epoch_year,
    field,
    java_trim,
    last_field,
    middle_join,
    parsed_once,
    split_fields,
    strict_field,
    strict_number,
    to_timestamp_any,
    try_number,
)
from quarry.functions.text import PIG_DELIMITERS, explode_tokens, tokenize

__all__ = [
    "PIG_DELIMITERS", "bucketize", "explode_tokens", "epoch_year", "lossless", "field", "java_trim", "last_field",
    "middle_join", "parsed_once", "ratio", "round_half_up", "round_python", "round_ratio", "split_fields",
    "strict_field", "strict_number", "to_timestamp_any", "tokenize", "total", "try_number",
]
