"""Raw telemetry CSV: 31 positional text columns with a header row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_day
from ..schema import INT_COLUMNS, PLAYER_ROUNDS_COLUMNS, RAW_COLUMNS, RAW_FOR_FACT, RAW_SCHEMA


def read_raw_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """All 31 columns as text, by position (no schema inference)."""
    return (spark.read.schema(RAW_SCHEMA).option("header", header).option("mode", "PERMISSIVE")
            .csv(path))


def raw_to_player_rounds(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Project the 15 canonical columns and cast the integer ones.

    Header lines repeated inside concatenated files (``matchid`` in the match
    column) are dropped.  With ``strict`` a bad integer fails the job (ANSI
    cast); otherwise it becomes NULL and the row is flagged in ``_error`` so
    ``split_valid`` can quarantine it, like a row with an empty integer field
    or a date that is no calendar day.
    """
    body = raw.where(F.col("matchid").isNull() | (F.col("matchid") != F.lit("matchid")))
    cols, bad, null = [], [], []
    for name in PLAYER_ROUNDS_COLUMNS:
        src = F.col(RAW_FOR_FACT[name])
        if name in INT_COLUMNS:
            text = F.trim(src)
            val = text.cast("int") if strict else text.try_cast("int")
            bad.append(src.isNotNull() & val.isNull())
            null.append(src.isNull())
            cols.append(val.alias(name))
        else:
            cols.append(src.alias(name))
    any_bad, any_null = reduce(Column.__or__, bad), reduce(Column.__or__, null)
    err = F.when(F.col("matchid").isNull(), F.lit("short_row")) \
           .when(any_bad, F.lit("bad_int")).when(any_null, F.lit("null_field")) \
           .when(~is_day(F.col(RAW_FOR_FACT["date"])), F.lit("bad_date")) \
           .otherwise(F.lit(None).cast("string"))
    return body.select(F.explode(F.array(F.struct(*cols, err.alias("_error")))).alias("_row")).select("_row.*")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_error``, quarantined rows with it)."""
    good = df.where(F.col("_error").isNull()).drop("_error")
    bad = df.where(F.col("_error").isNotNull())
    return good, bad


def player_rounds_to_raw(pr: DataFrame) -> DataFrame:
    """Canonical rows laid out as the 31 raw columns (unused ones empty)."""
    back = {raw: fact for fact, raw in RAW_FOR_FACT.items()}
    return pr.select(*[
        (F.col(back[c]).cast("string") if c in back else F.lit("")).alias(c) for c in RAW_COLUMNS])


def write_raw_csv(pr: DataFrame, path: str) -> None:
    player_rounds_to_raw(pr).write.mode("overwrite").option("header", True).csv(path)
