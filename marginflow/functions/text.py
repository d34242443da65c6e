"""Text and key cleansing helpers (all built-in Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginflow.functions.numeric import _col

# --- fixed values: category canonicalisation and junk tags ------------------
# Substring (case-insensitive) -> canonical primary-industry label; first
# match wins.
CANONICAL_INDUSTRIES = (
    ("finance", "Finance, Insurance & Institutions"),
    ("fashion", "Fashion & Lifestyle"),
)
# Lower-case prefixes of secondary-industry tags that are artefacts, not data.
JUNK_TAG_PREFIXES = ("#n/a", "gern am mammaly")
# -----------------------------------------------------------------------------

NON_ASCII = r"[^\x00-\x7F]"
# Leading/trailing Unicode space separators (category Zs: U+0020, no-break
# space, em space, ideographic space, ...), the set the target engine's trim
# removes; Spark's trim() removes U+0020 only.  Tabs and newlines stay.
EDGE_SPACES = r"^\p{Zs}+|\p{Zs}+$"


def trimmed(c) -> Column:
    """Strip edge space separators.  Fast path: a plain ``trim``; the regex
    only runs when what is left begins or ends with a non-ASCII character
    (its UTF-8 sorts above U+007F), which is rare."""
    t = F.trim(_col(c))
    edge_non_ascii = (F.substring(t, 1, 1) > F.lit("\x7f")) | (F.substring(t, -1, 1) > F.lit("\x7f"))
    return F.when(edge_non_ascii, F.regexp_replace(t, EDGE_SPACES, "")).otherwise(t)


def blank_to_null(c) -> Column:
    """trim, then '' -> NULL."""
    return F.nullif(trimmed(c), F.lit(""))


def upper_blank_to_null(c) -> Column:
    return F.nullif(F.upper(trimmed(c)), F.lit(""))


def strip_non_ascii(c) -> Column:
    """Remove every non-ASCII code point (emoji, variation selectors, ZWJ),
    then trim (only ASCII spaces can remain)."""
    return F.trim(F.regexp_replace(_col(c), NON_ASCII, ""))


def canonical_category(c, rules=CANONICAL_INDUSTRIES) -> Column:
    """Replace a label by its canonical form when it contains a keyword."""
    col = _col(c)
    low = F.lower(col)
    expr = None
    for keyword, label in rules:
        cond = low.like(f"%{keyword}%")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(col)


def null_if_prefixed(c, prefixes=JUNK_TAG_PREFIXES) -> Column:
    """NULL when the lower-cased value starts with one of ``prefixes``."""
    col = _col(c)
    low = F.lower(col)
    cond = None
    for p in prefixes:
        part = low.like(f"{p}%")
        cond = part if cond is None else (cond | part)
    return F.when(cond, F.lit(None).cast("string")).otherwise(col)


def key_string(c) -> Column:
    """Business keys are strings."""
    return _col(c).cast("string")


def float_key_string(c) -> Column:
    """Nullable float-formatted foreign key (102.0) -> '102'; NULL stays NULL.

    Whole numbers and keys that are no numbers stay as they are.  Fractions
    round half-to-even like a double -> integer cast in the target engine
    (Spark's cast truncates), in decimals, so long ids keep every digit.
    """
    text = F.trim(_col(c).cast("string"))
    number = F.bround(text.try_cast("decimal(38,10)"), 0).cast("decimal(38,0)").cast("string")
    # '102.0' by far most often: no decimal for it
    plain = F.when(text.rlike(r"^[1-9]\d{0,17}\.0$"), F.substring_index(text, ".", 1))
    return plain.when(text.rlike(r"^[+-]?\d+$"), text).otherwise(F.coalesce(number, text))
