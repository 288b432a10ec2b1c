"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave import session
from tickweave.session import ensure_utc, forget  # noqa: F401 - forget is for the operators

#: The whitespace of the operators' contracts: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back, and its path. Cuts the lineage: a lost executor costs the tasks that
    were running, and every reader sees the same rows. The table lives as long
    as a frame that reads it (``session.written``); ``forget`` deletes it
    sooner, where all its readers have been written themselves."""
    ensure_utc(df.sparkSession)
    back = session.written(df, f"llm-{name}")
    return back, session.written_path(back)


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
