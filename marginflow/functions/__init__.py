from marginflow.functions.numeric import r2, r4, ratio, round_half_away
from marginflow.functions.text import (blank_to_null, canonical_category, float_key_string,
                                       key_string, null_if_prefixed, strip_non_ascii, trimmed,
                                       upper_blank_to_null)

__all__ = [
    "r2", "r4", "ratio", "round_half_away",
    "blank_to_null", "canonical_category", "float_key_string", "key_string",
    "null_if_prefixed", "strip_non_ascii", "trimmed", "upper_blank_to_null",
]
