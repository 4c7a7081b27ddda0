"""Small helpers shared by the operators."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space; every other code point belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, wherever they were started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, and a lost executor costs nothing already written."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces_of(total: int | float | None, each: int, least: int = 1) -> int:
    """How many groups of about ``each`` units ``total`` units make."""
    return max(least, math.ceil((total or 0) / each))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one column-pruned scan, one number to the driver."""
    return docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
