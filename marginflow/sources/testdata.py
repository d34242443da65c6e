"""Derive the seven raw sources from the TPC-H-style test tables.

The mapping (FIXTURES.md section 3) turns orders into campaigns, customers
into clients, suppliers into employees, parts into projects, lineitems into
daily ad metrics and time entries, and events into social page metrics,
with deliberate dirt (padding, emoji, junk tags, orphan ids, NULL keys).
Every derivation is a DataFrame plan; nothing passes through the driver.  Every
row of the tables is kept: orphans are made by moving foreign keys (time
entries whose employee id no master has, or that a neighbour client gets).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the fixture mapping ------------------------------------
PLATFORM_BY_PRIORITY = {
    "1-URGENT": "Meta Ads",
    "2-HIGH": " Meta Ads ",
    "3-MEDIUM": "TikTok Ads",
    "4-NOT SPECIFIED": "Google Ads",
}
PLATFORM_OTHER = "Pinterest Ads"
INDUSTRY_BY_SEGMENT = {
    "HOUSEHOLD": "\U0001F3E0 Home & Living",
    "MACHINERY": "\U0001F3DB️ Finance, Insurance & Institutions",
    "FURNITURE": "\U0001F9CD‍♀️ Fashion & Lifestyle",
    "AUTOMOBILE": "\U0001F697 Mobility & Automotive",
}
SECONDARY_LOOKUP_ERROR = "#N/A (lookup failed)"
SECONDARY_FREE_TEXT = "gern am mammaly Test "
CAMPAIGN_STATUS_BY_ORDER_STATUS = {"O": "active", "F": " PAUSED ", "P": ""}
WINDOW_BY_RETURNFLAG = {"A": "1d_click", "N": "7d_click", "R": "28d_click"}
SOCIAL_PLATFORM_BY_EVENT = {
    "click": "Facebook", "view": "Facebook",
    "signup": " Instagram ", "purchase": " Instagram ",
    "error": "LinkedIn",
}
PROJECT_START = _dt.date(1995, 1, 1)
PROJECT_END = _dt.date(2001, 12, 31)
BACKDATED_FIRST = _dt.date(1994, 6, 1)   # time rows of clients with custkey % 10 = 1
BACKDATED_OTHER = _dt.date(1994, 7, 1)
# time entries of suppliers with key % 25 = 7: employee ids outside the master
ORPHAN_EMPLOYEE_OFFSET = 10_000_000_000
# time entries of clients with key % 10 = 0 belong to the client two keys on,
# which leaves clients without internal cost
COST_FREE_OFFSET = 2
# -----------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")

# Declared schemas of the test tables (the same at every scale factor), so a
# read needs no schema-inference job.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _mapping(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None
                else expr.when(col == key, F.lit(value)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def platform_of(priority: Column) -> Column:
    return _mapping(priority, PLATFORM_BY_PRIORITY, PLATFORM_OTHER)


class TestTables:
    """Lazy access to the parquet test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._relations: dict[str, DataFrame] = {}
        # (rows, key, name) -> the rows dealt out by the key
        self.deal: Callable[[DataFrame, str, str], DataFrame] = lambda df, key, name: df

    def _path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._relations:
            reader = self.spark.read
            if name in TEST_SCHEMAS:
                reader = reader.schema(TEST_SCHEMAS[name])
            self._relations[name] = reader.parquet(self._path(name))
        return self._relations[name]

    def state(self) -> tuple:
        """Modification times and sizes of the tables, to notice that a folder
        was rewritten.  A table may be one file or a folder of files: its size
        is that of all its files."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        out = []
        for name in TABLES:
            path = jvm.org.apache.hadoop.fs.Path(self._path(name))
            fs = path.getFileSystem(conf)
            out.append((fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()))
        return tuple(out)


def _nations(t: TestTables) -> Column:
    """Nation names by key: one map (the schema defines 25 nations), as a scalar
    subquery.  A join would make Spark estimate clients and employees at the
    product of both sizes and never plan them as the small side that they are."""
    named = F.struct("n_nationkey", "n_name")
    return t.table("nation").agg(F.map_from_entries(F.collect_list(named))).scalar()


def raw_clients(t: TestTables) -> DataFrame:
    c = t.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = _nations(t)
    key = F.col("c_custkey")
    secondary = (F.when(key % 50 == 0, F.lit(SECONDARY_LOOKUP_ERROR))
                 .when(key % 50 == 1, F.lit(SECONDARY_FREE_TEXT))
                 .when(key % 3 == 0, F.lit("  "))
                 .otherwise(F.col("c_mktsegment")))
    return (c.where(F.map_contains_key(nations, F.col("c_nationkey")))
            .select(
                key.alias("client_id"),
                F.when(key % 60 == 0, F.concat(F.col("c_name"), F.lit(" ")))
                 .otherwise(F.col("c_name")).alias("client_name"),
                _mapping(F.col("c_mktsegment"), INDUSTRY_BY_SEGMENT).alias("primary_industry"),
                secondary.alias("secondary_industry"),
                F.concat(F.try_element_at(nations, F.col("c_nationkey")), F.lit(" ")).alias("country")))


def raw_campaigns(t: TestTables, customers: DataFrame | None = None) -> DataFrame:
    o = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                 "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customers if customers is not None else t.table("customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(
                F.col("o_orderkey").alias("campaign_id"),
                F.col("o_custkey").alias("account_id"),
                F.concat(F.col("c_name"), F.lit(" ")).alias("account_name"),
                F.concat(F.lit("Campaign_"), F.col("o_orderkey").cast("string")).alias("campaign_name"),
                platform_of(F.col("o_orderpriority")).alias("platform"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("start_date"),
                _mapping(F.col("o_orderstatus"), CAMPAIGN_STATUS_BY_ORDER_STATUS).alias("campaign_status"),
                F.floor("o_totalprice").cast("double").alias("daily_budget_eur")))


def raw_employees(t: TestTables) -> DataFrame:
    s = t.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = _nations(t)
    key = F.col("s_suppkey")
    return (s.where(F.map_contains_key(nations, F.col("s_nationkey")))
            .select(
                key.alias("employee_id"),
                F.concat(F.col("s_name"), F.lit(" ")).alias("employee_name"),
                F.when(key % 10 == 9, F.lit("")).otherwise(F.try_element_at(nations, F.col("s_nationkey"))).alias("department_name"),
                F.when(key % 4 == 0, F.lit("")).otherwise(F.lit("PC")).alias("team_name"),
                (F.lit(75) + F.lit(5) * (key % 5)).cast("double").alias("hourly_rate_eur"),
                F.lit("Active").alias("status")))


def raw_projects(t: TestTables) -> DataFrame:
    p = t.table("part").select("p_partkey", "p_name", "p_retailprice")
    c = t.table("customer").select("c_custkey", "c_name")
    # four parts for three customers at every scale: owners grow with the tables
    owner = F.expr("(p_partkey * 3) div 4")
    return (p.join(c, owner == F.col("c_custkey"), "inner")
            .select(
                F.col("p_partkey").alias("project_id"),
                owner.alias("client_id"),
                F.col("c_name").alias("client_name"),
                F.col("p_name").alias("project_name"),
                F.lit(PROJECT_START).alias("project_start_date"),
                F.lit(PROJECT_END).alias("project_end_date"),
                F.floor("p_retailprice").cast("double").alias("monthly_budget_eur")))


def _line_order_customer(t: TestTables, line_cols, owner: Column | None = None) -> DataFrame:
    """Lines with their order's customer (or the customer ``owner``).  Orders
    meet their customer first: there are fewer of them than lines.

    Lines meet their order by its key as text, which is the business key of the
    campaign: dealt out for the order, they are for the campaign, too."""
    li = t.deal(t.table("lineitem").select(F.col("l_orderkey").cast("string").alias("order_id"), *line_cols), "order_id", "lines")
    o = t.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    if owner is not None:
        o = o.withColumn("o_custkey", owner)
    c = t.table("customer").select("c_custkey", "c_name")
    oc = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return li.join(oc, li.order_id == oc.o_orderkey.cast("string"), "inner")


def raw_ad_metrics(t: TestTables) -> DataFrame:
    base = _line_order_customer(
        t, ["l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_shipdate"])
    q = F.col("l_quantity")
    return base.select(
        F.col("order_id").alias("campaign_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("c_name").alias("client_name"),
        platform_of(F.col("o_orderpriority")).alias("platform"),
        F.col("l_shipdate").cast("date").alias("report_date"),
        _mapping(F.col("l_returnflag"), WINDOW_BY_RETURNFLAG).alias("attribution_window"),
        F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("double").alias("spend_eur"),
        (q * 100).cast("bigint").alias("impressions"),
        F.when(F.col("l_discount") > 0, q).otherwise(F.lit(0.0)).cast("bigint").alias("clicks"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("conversions"),
        F.col("l_extendedprice").alias("cpm"),
        F.col("l_discount").alias("ctr"),
        F.col("l_tax").alias("cvr"),
        q.alias("cpc"),
        F.col("l_linenumber").cast("double").alias("cpa"),
        (F.floor(F.col("l_extendedprice") * 4).cast("double") / 4).alias("revenue_eur"),
        q.alias("roas"))


def raw_time_tracking(t: TestTables) -> DataFrame:
    base = _line_order_customer(
        t, ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_linestatus", "l_shipdate"],
        owner=F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") + COST_FREE_OFFSET).otherwise(F.col("o_custkey")))
    supp = F.col("l_suppkey")
    part = F.col("l_partkey")
    hours = F.col("l_quantity") / 8
    report_date = (F.when(F.col("o_custkey") % 10 == 1,
                          F.when(F.col("l_linenumber") == 1, F.lit(BACKDATED_FIRST))
                           .otherwise(F.lit(BACKDATED_OTHER)))
                   .otherwise(F.col("l_shipdate").cast("date")))
    return base.select(
        F.when(supp % 25 == 7, supp + ORPHAN_EMPLOYEE_OFFSET).otherwise(supp).alias("employee_id"),
        F.col("o_custkey").alias("client_id"),
        F.when(part % 5 == 0, F.lit(None).cast("double")).otherwise(part.cast("double")).alias("project_id"),
        F.concat(F.lit("Supplier "), supp.cast("string")).alias("employee_name"),
        F.concat(F.col("c_name"), F.lit(" ")).alias("client_name"),
        report_date.alias("report_date"),
        hours.alias("hours_worked"),
        F.lit("Dept ").alias("department_name"),
        (hours * (F.lit(75) + F.lit(5) * (supp % 5))).alias("cost_eur"),
        F.when(part % 11 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("l_linestatus") == "F").alias("is_productive"))


def raw_social_metrics(t: TestTables) -> DataFrame:
    e = t.table("events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    return e.select(
        F.col("user_id").alias("page_id"),
        F.concat(F.lit("Page_"), F.col("user_id").cast("string")).alias("page_name"),
        # three events in a row share a campaign
        F.when(eid % 5 == 0, F.lit(None).cast("double")).otherwise((eid - eid % 3).cast("double")).alias("campaign_id"),
        F.col("ts").cast("date").alias("report_date"),
        _mapping(F.col("event_type"), SOCIAL_PLATFORM_BY_EVENT).alias("platform"),
        (eid % 97).alias("engaged_users"),
        F.floor("value").cast("bigint").alias("new_followers"),
        eid.alias("total_followers"),
        (eid * 3).alias("impressions"),
        eid.alias("organic_impressions"),
        (eid % 11).alias("profile_views"),
        (eid % 13).alias("website_clicks"))


BUILDERS = {
    "clients": raw_clients,
    "campaigns": raw_campaigns,
    "employees": raw_employees,
    "projects": raw_projects,
    "ad_metrics": raw_ad_metrics,
    "time_tracking": raw_time_tracking,
    "social_metrics": raw_social_metrics,
}
