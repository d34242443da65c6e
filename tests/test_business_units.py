"""Business-layer NULL semantics on small hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from marginflow.operators.aggregates import month_start, sum_if

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_productive_split_null_in_neither(spark):
    df = spark.createDataFrame([("x", True, 2.0), ("x", False, 3.0), ("x", None, 5.0)],
                               "k string, p boolean, h double")
    r = df.groupBy("k").agg(F.sum("h").alias("total"), sum_if(F.col("p"), "h").alias("prod"),
                            sum_if(~F.col("p"), "h").alias("nonprod")).first()
    assert (r.total, r.prod, r.nonprod) == (10.0, 2.0, 3.0)


def test_month_start_is_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 17),)], "d date")
    assert df.select(month_start("d")).first()[0] == dt.date(2024, 3, 1)


def test_null_ordering_is_explicit(spark):
    df = spark.createDataFrame([(None,), (2.0,), (1.0,)], "v double")
    asc = [r[0] for r in df.orderBy(F.asc_nulls_last("v")).collect()]
    desc = [r[0] for r in df.orderBy(F.desc_nulls_last("v")).collect()]
    assert asc == [1.0, 2.0, None] and desc == [2.0, 1.0, None]


def test_client_social_pivot_model_cases(spark):
    """The registered pivot on hand-made raw rows (ELSE-0 sums, NULL averages
    and maxima, days counted once, NULL values and LinkedIn ignored)."""
    from marginflow.plans.business import client_social_pivot
    from marginflow.plans.context import Workspace
    from marginflow.sources.schemas import RAW_SCHEMAS

    def frame(name, rows):
        return spark.createDataFrame(rows, RAW_SCHEMAS[name])

    social = frame("social_metrics", [
        ("1", "p1", "10.0", D1, "Facebook", 5, 3, 100, 0, 0, 0, 1),
        ("1", "p1", "10.0", D2, "Facebook", 7, None, 110, 0, 0, 0, 2),
        ("2", "p2", "20.0", D1, " Facebook ", 1, 1, 50, 0, 0, 0, 0),
        ("2", "p2", "20.0", D1, "Instagram", 2, 2, 70, 0, 0, 0, 0),
        ("3", "p3", "30.0", D1, "LinkedIn", 9, 9, 999, 0, 0, 0, 9),
        ("4", "p4", "40.0", D1, "Instagram", 1, 1, 10, 0, 0, 0, 0),
        ("5", "p5", "40.0", D1, "Instagram", 1, 2, 20, 0, 0, 0, 0),
        ("6", "p6", None, D1, "Instagram", 1, 2, 20, 0, 0, 0, 0),       # no campaign: dropped
        ("7", "p7", "99.0", D1, "Instagram", 1, 2, 20, 0, 0, 0, 0),       # unknown campaign: dropped
    ])
    campaigns = frame("campaigns", [(str(c), str(k), "a", "c", "Meta Ads", None, "", 1.0)
                                    for c, k in ((10, 100), (20, 200), (30, 300), (40, 400))])
    clients = frame("clients", [(str(k), f"n{k}", None, None, "DE") for k in (100, 200, 300, 400)])
    raw = {"social_metrics": social, "campaigns": campaigns, "clients": clients}
    ws = Workspace(spark, {n: (lambda df=df: df) for n, df in raw.items()})
    got = {r.client_id: r for r in client_social_pivot(ws).collect()}
    assert set(got) == {"100", "200", "300", "400"}
    a = got["100"]
    assert (a.n_report_days_social, a.n_report_days_facebook, a.n_report_days_instagram) == (2, 2, 0)
    assert (a.total_new_followers_facebook, a.avg_daily_new_followers_facebook) == (3, 3.0)
    assert (a.total_engaged_users_facebook, a.avg_daily_engaged_users_facebook) == (12, 6.0)
    assert (a.current_total_followers_facebook, a.total_new_followers_instagram,
            a.avg_daily_new_followers_instagram, a.current_total_followers_instagram) == (110, 0, None, None)
    b = got["200"]
    assert (b.n_report_days_social, b.n_report_days_facebook, b.n_report_days_instagram) == (1, 1, 1)
    n = got["300"]
    assert (n.n_report_days_social, n.n_report_days_facebook, n.total_new_followers_facebook,
            n.avg_daily_new_followers_facebook, n.current_total_followers_facebook) == (1, 0, 0, None, None)
    t = got["400"]   # two pages on one day: one day, averages over rows
    assert (t.n_report_days_instagram, t.total_new_followers_instagram,
            t.avg_daily_new_followers_instagram, t.current_total_followers_instagram) == (1, 3, 1.5, 20)
