"""CSV sources with bad rows: good rows typed, bad rows set aside with the
reason and the file they came from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.sources.readers import FALSE_TEXT, TRUE_TEXT, conform
from marginflow.sources.schemas import RAW_SCHEMAS
from marginflow.sources.sinks import materialize

CORRUPT = "_corrupt_record"


@dataclass
class Quarantined:
    """``good``: the declared columns, typed.  ``rejected``: (source, file,
    record, reasons), record as it stands in the file where it does not have
    the header's columns, else a JSON object of its cells."""

    good: DataFrame
    rejected: DataFrame


def has_quoted_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line of the files has an odd number of quotes: a quoted field
    goes on over its end (or the row is malformed, and only a parser of whole
    files can tell).  One scan of the text, split like any text."""
    quotes = F.char_length("value") - F.char_length(F.replace(F.col("value"), F.lit('"')))
    found = spark.read.text(path, recursiveFileLookup=True).agg(F.max(quotes % 2).alias("odd")).first()
    return bool(found.odd)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files' header."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option(
        "recursiveFileLookup", True).csv(path).columns


def read_quarantined(spark: SparkSession, name: str, path: str, columns: list[str] | None = None,
                     multi_line: bool | None = None) -> Quarantined:
    """Read the CSV files of a raw source (header, RFC-4180 quoting, UTF-8,
    empty cell -> NULL) without failing on bad rows.

    A row is rejected if it does not have the header's columns, or if a cell
    is no value of its declared type; every reason is named.  Files without a
    quoted line break (checked, unless ``multi_line`` says) are read in splits;
    others one file to a task.  The parsed rows are written once to the shared
    folder; both results scan that table.  A missing declared column fails the
    read, as no row could be good.
    """
    if multi_line is None:
        multi_line = has_quoted_line_breaks(spark, path)
    columns = columns or header_of(spark, path)
    declared = {f.name: f.dataType for f in RAW_SCHEMAS[name].fields}
    if missing := [c for c in declared if c not in columns]:
        raise ValueError(f"raw source {name} lacks the columns {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    rows = (spark.read.schema(text).option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True).csv(path)
            .select("*", F.col("_metadata.file_path").alias("_file")))
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("columns"))]
    reasons += [F.when(F.col(CORRUPT).isNull() & _no_value(F.col(c), t), F.lit(f"type:{c}")) for c, t in declared.items()
                if not isinstance(t, T.StringType)]
    parsed = materialize(spark, rows.withColumn("_reasons", F.array_compact(F.array(*reasons))), f"csv-{name}")
    good = conform(name, parsed.where(F.size("_reasons") == 0).select(*columns)).select(*declared)
    cells = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rejected = parsed.where(F.size("_reasons") > 0).select(
        F.lit(name).alias("source"), F.col("_file").alias("file"), F.coalesce(CORRUPT, cells).alias("record"),
        F.col("_reasons").alias("reasons"))
    return Quarantined(good, rejected)


def _no_value(cell: Column, target: T.DataType) -> Column:
    """The cell holds text that is no value of the type."""
    if isinstance(target, T.BooleanType):
        low = F.lower(F.trim(cell))
        return F.coalesce((low != "") & ~low.isin(*TRUE_TEXT, *FALSE_TEXT), F.lit(False))
    number = "decimal(38,10)" if isinstance(target, T.LongType) else target.simpleString()
    return cell.isNotNull() & cell.try_cast(number).isNull()
