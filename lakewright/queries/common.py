"""Loading of test tables and derivation of operator inputs from them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a derivation in Spark; ``{name}`` stands for a test table."""
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{n: load(spark, sf_dir, n) for n in names})


def plain(text: str) -> str:
    """The derivation as text for the checking engine, in brackets."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", text) + ")"
