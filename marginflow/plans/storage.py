"""Sources and sinks as queries: a raw source through CSV files with bad rows,
and a fact table through published versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.operators.aggregates import month_start
from marginflow.plans.context import Workspace
from marginflow.plans.operational import unified_ad_metrics
from marginflow.session import ensure_checkpoint_dir
from marginflow.sources.published import PinnedVersion, publish, scratch_folder
from marginflow.sources.quarantine import read_quarantined
from marginflow.sources.sinks import materialize, write_csv

# --- fixed values of the CSV query: which rows are spoilt ------------------------
SHORT_EVERY = 40      # employee % 40 = 1: an extra line with two cells only
TYPE_EVERY = 25       # employee % 25 = 2: hours that are no number
FLAG_EVERY = 50       # employee % 50 = 3: a boolean outside the known words
# ---------------------------------------------------------------------------------


def time_tracking_through_csv(ws: Workspace) -> DataFrame:
    """The time entries written as CSV, some of them spoilt and some followed by
    a cut-off line, and read again: every good row with its values, every
    rejected one with its reasons.

    Columns: status ('good', 'rejected'), employee_id, client_id, project_id,
    report_date, hours_worked, cost_eur, is_productive (NULL if rejected) and
    reasons (comma-joined, NULL if good).  Of a rejected row the employee is
    taken from its record.
    """
    spark = ws.spark
    raw = ws.raw("time_tracking")
    key = F.col("employee_id").cast("bigint")
    cells = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    spoilt = (cells.withColumn("hours_worked", F.when(key % TYPE_EVERY == 2, F.lit("n/a")).otherwise(F.col("hours_worked")))
              .withColumn("is_productive", F.when(key % FLAG_EVERY == 3, F.lit("maybe")).otherwise(F.col("is_productive"))))
    folder = scratch_folder(ensure_checkpoint_dir(spark), "csv-time-tracking")
    write_csv(spoilt, f"{folder}/rows")
    write_csv(cells.where(key % SHORT_EVERY == 1).select("employee_id", "client_id"), f"{folder}/cut-off")
    read = read_quarantined(spark, "time_tracking", folder, columns=raw.columns)
    names = ["employee_id", "client_id", "project_id", "report_date", "hours_worked", "cost_eur", "is_productive"]
    good = read.good.select(F.lit("good").alias("status"), *names, F.lit(None).cast("string").alias("reasons"))
    # a record is a JSON object of its cells, or the line itself
    employee = F.coalesce(F.get_json_object("record", "$.employee_id"), F.split("record", ",")[0])
    rejected = read.rejected.select(F.lit("rejected").alias("status"), employee.alias("employee_id"),
                                    *[F.lit(None).cast(good.schema[n].dataType).alias(n) for n in names[1:]],
                                    F.array_join("reasons", ",").alias("reasons"))
    return good.unionByName(rejected)


def pinned_monthly_spend(ws: Workspace) -> DataFrame:
    """Spend per month and platform from a pinned version.

    The unified metrics are published twice, the second time without their
    last year; the session stays on the first version, stored by month, and reads
    the months of the campaigns' first quarter (a join, pruned at run time).
    Columns: report_month, platform, n_rows, spend_eur.
    """
    spark = ws.spark
    # from the stored sums: the KPIs take as much disk again and follow from them
    facts = unified_ad_metrics(ws)
    if not ws.stored("model:unified_sums"):
        facts = materialize(spark, facts, "unified-ad-metrics")
    out = scratch_folder(ensure_checkpoint_dir(spark), "published")
    publish(spark, out, {"ol_unified_ad_metrics": facts}, monthly={"ol_unified_ad_metrics": "report_date"})
    pinned = PinnedVersion(spark, out)
    last = facts.agg(F.max("report_date").alias("last"))
    older = facts.join(F.broadcast(last), F.col("report_date") < F.add_months("last", -12)).drop("last")  # one row
    publish(spark, out, {"ol_unified_ad_metrics": older}, monthly={"ol_unified_ad_metrics": "report_date"})
    months = (pinned_months(ws))
    rows = pinned.table("ol_unified_ad_metrics").join(months, "report_month")
    return rows.groupBy("report_month", "platform").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("spend_eur").alias("spend_eur"))


def pinned_months(ws: Workspace) -> DataFrame:
    """First quarters in which campaigns started."""
    starts = ws.cl("campaigns").select(month_start("start_date").alias("report_month"))
    return starts.where(F.month("report_month") <= 3).distinct()
