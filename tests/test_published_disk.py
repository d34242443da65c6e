"""Published versions take the disk of their files: no exchange of whole rows, no second copy of the facts."""

from datetime import date

from pyspark.sql import functions as F

from marginflow.plans import catalog, storage
from marginflow.sources import published
from tests.conftest import SF_SMALL


def test_months_are_written_without_an_exchange(spark, tmp_path, monkeypatch):
    plans = []
    write = published.write_table

    def recorded(df, *args, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args, **kw)
    monkeypatch.setattr(published, "write_table", recorded)
    monkeypatch.setattr(published, "MONTH_FILES", 3, raising=False)
    df = spark.range(0, 600, 1, 8).select("id", F.date_add(F.lit(date(2000, 1, 1)), (F.col("id") % 90).cast("int")).alias("day"))
    published.write_monthly(df, f"{tmp_path}/facts", "day")
    assert "Exchange" not in plans[0], plans[0]
    back = spark.read.parquet(f"{tmp_path}/facts")
    assert sorted(r[0] for r in back.select("id").collect()) == list(range(600))
    assert back.where("report_month <> trunc(day, 'month')").count() == 0
    files = back.select("report_month", F.input_file_name().alias("f")).distinct().groupBy("report_month").count().collect()
    assert len(files) == 3 and all(r["count"] <= 3 for r in files)


def test_the_query_stores_the_sums_only(spark, monkeypatch):
    rows = lambda: sorted(map(tuple, catalog.QUERIES["src_pinned_monthly_spend"](spark, SF_SMALL).collect()))
    expected = sorted(map(tuple, storage.pinned_monthly_spend(catalog.workspace(spark, SF_SMALL).fresh()).collect()))

    def none(*args):
        raise AssertionError("the unified metrics are stored once more")
    monkeypatch.setattr(storage, "materialize", none)
    assert rows() == expected and expected
