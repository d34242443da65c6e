"""Column helpers: rounding, guarded ratios, text and key rules."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from marginflow.functions import (blank_to_null, canonical_category, float_key_string,
                                  null_if_prefixed, r2, r4, ratio, strip_non_ascii,
                                  upper_blank_to_null)
from marginflow.sources import testdata as T


def _one(spark, values, expr_fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x")).alias("y")).collect()]


ROUNDING_EDGES = [1.005, 2.675, 0.285, 0.125, -2.5, -0.125, 1234.5678, 0.0, 2.5, 3.5, -1.005,
                  -0.004, -0.00004, 0.004, -0.0, -0.005, -0.00005]


def test_round_half_away_matches_duckdb(spark):
    rnd = random.Random(7)
    values = ROUNDING_EDGES + [rnd.uniform(-1e6, 1e6) for _ in range(3000)] \
        + [rnd.randint(-10**6, 10**6) / 8 for _ in range(2000)] \
        + [rnd.randint(-10**6, 10**6) / 1000 for _ in range(2000)]
    for digits, fn in ((2, r2), (4, r4)):
        ours = _one(spark, values, fn)
        con = duckdb.connect()
        theirs = [r[0] for r in con.execute(
            f"SELECT round(x, {digits}) FROM (SELECT unnest(?) AS x, generate_subscripts(?, 1) AS i) ORDER BY i",
            [values, values]).fetchall()]
        bad = [(v, a, b) for v, a, b in zip(values, ours, theirs) if a != b]
        assert not bad, bad[:5]


def test_binary_rounding_not_decimal_text(spark):
    assert _one(spark, [1.005, 0.285, 0.125, -2.5], r2) == [1.0, 0.28, 0.13, -2.5]


def test_ratio_guards_zero_negative_null(spark):
    df = spark.createDataFrame([(10, 2), (10, 0), (10, -1), (10, None), (None, 4)], "n long, d long")
    got = [r[0] for r in df.select(ratio("n", "d")).collect()]
    assert got == [5.0, None, None, None, None]


def test_ratio_is_double_division(spark):
    df = spark.createDataFrame([(1, 3)], "n long, d long")
    (v,) = df.select(ratio("n", "d")).first()
    assert isinstance(v, float) and v == 1 / 3


def test_float_key_string(spark):
    got = _one(spark, [102.0, None, 2.5, 3.5, 2.7, 7.0e10], float_key_string)
    assert got == ["102", None, "2", "4", "3", "70000000000"]


def test_float_keys_as_text(spark):
    keys = ["102.0", "007.0", "-5.0", "0.0", " 9.0 ", "1234567890123456789.0", "123456789012345678.0", "5.00", "C-1.0", "1e3", "2.5"]
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, x string").select("i", float_key_string("x").alias("k")).orderBy("i")
    assert [r.k for r in rows.collect()] == ["102", "7", "-5", "0", "9", "1234567890123456789", "123456789012345678", "5",
                                             "C-1.0", "1000", "2"]


@pytest.mark.parametrize("label,expected", [
    (T.INDUSTRY_BY_SEGMENT["HOUSEHOLD"], "Home & Living"),
    (T.INDUSTRY_BY_SEGMENT["MACHINERY"], "Finance, Insurance & Institutions"),
    (T.INDUSTRY_BY_SEGMENT["FURNITURE"], "Fashion & Lifestyle"),
    (T.INDUSTRY_BY_SEGMENT["AUTOMOBILE"], "Mobility & Automotive"),
    ("Retail", "Retail"),
    ("  Personal FINANCE advice ", "Finance, Insurance & Institutions"),
    (None, None),
])
def test_industry_labels(spark, label, expected):
    got = _one(spark, [label], lambda c: canonical_category(strip_non_ascii(c)), "string")
    assert got == [expected]


def test_secondary_tag_rules(spark):
    vals = ["#N/A (lookup failed)", "gern am mammaly Test ", "  ", "", " BUILDING ", None, "n/a ok"]
    got = _one(spark, vals, lambda c: null_if_prefixed(blank_to_null(c)), "string")
    assert got == [None, None, None, None, "BUILDING", None, "n/a ok"]


def test_status_upper_blank(spark):
    got = _one(spark, [" paused ", "", "active", None], upper_blank_to_null, "string")
    assert got == ["PAUSED", None, "ACTIVE", None]


def test_rounding_helper_is_not_nan_safe_issue(spark):
    got = _one(spark, [float("inf")], r2)
    assert math.isinf(got[0]) or got[0] is None


SPACE_PROBES = [0x20, 0xA0, 0x1680, 0x2000, 0x2003, 0x200A, 0x202F, 0x205F, 0x3000, 0x09, 0x0A,
                0x0D, 0x85, 0x200B, 0xFEFF, 0x2028]


def test_trim_matches_duckdb_per_code_point(spark):
    from marginflow.functions import trimmed
    vals = [chr(c) + "ab" + chr(c) + " c" + chr(c) for c in SPACE_PROBES]
    ours = _one(spark, vals, trimmed, "string")
    con = duckdb.connect()
    theirs = [con.execute("SELECT trim(?)", [v]).fetchone()[0] for v in vals]
    assert ours == theirs
