"""Readers for raw sources (parquet or CSV with header) and IL views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.sources.schemas import RAW_SCHEMAS

# Text booleans that are read; anything else fails the read.
TRUE_TEXT = ("true", "t", "1", "yes", "y")
FALSE_TEXT = ("false", "f", "0", "no", "n")


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
             multi_line: bool = True) -> DataFrame:
    """Read one raw source: every column of the files, the declared ones in
    their declared types.

    Columns are found by name (parquet footer or CSV header; no inference
    over the data); a missing declared column fails here, further columns pass
    through unchanged.  CSV: header row, RFC-4180 quoting (fields may hold
    commas, emoji and line breaks), UTF-8, empty cell -> NULL.  Business keys
    stay text.  ``multi_line=False`` lets Spark split large CSV files, for
    files without line breaks in quoted fields.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        df = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line).option("encoding", "UTF-8")
              .option("inferSchema", False).csv(path))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return conform(name, df)


def conform(name: str, df: DataFrame) -> DataFrame:
    """``df`` with the declared columns of a raw source in their declared types."""
    declared = {f.name: f.dataType for f in RAW_SCHEMAS[name].fields}
    missing = [c for c in declared if c not in df.columns]
    if missing:
        raise ValueError(f"raw source {name} lacks the columns {missing}")
    return df.select([_typed(df.schema[c].dataType, F.col(c), declared[c]).alias(c) if c in declared else F.col(c)
                      for c in df.columns])


def _typed(source: T.DataType, col: Column, target: T.DataType) -> Column:
    if source == target:
        return col
    if isinstance(source, T.StringType) and isinstance(target, T.BooleanType):
        low = F.lower(F.trim(col))
        return (F.when(low.isin(*TRUE_TEXT), F.lit(True)).when(low.isin(*FALSE_TEXT), F.lit(False))
                .when(low != "", F.raise_error(F.concat(F.lit("not a boolean: "), col)).cast("boolean")))
    if isinstance(source, T.StringType) and isinstance(target, T.LongType):
        # '102.0' style counts: in decimals, rounding half-even
        return F.bround(col.cast("decimal(38,10)"), 0).cast("bigint")
    return col.cast(target)


def interface_view(spark: SparkSession, name: str, df: DataFrame, prefix: str = "il_") -> DataFrame:
    """Expose a raw source unchanged as a temp view and read through it."""
    df.createOrReplaceTempView(prefix + name)
    return spark.table(prefix + name)


def register_interface_views(raw: dict[str, DataFrame], prefix: str = "il_") -> None:
    """Interface layer: each raw source exposed unchanged as a temp view."""
    for name, df in raw.items():
        df.createOrReplaceTempView(prefix + name)
