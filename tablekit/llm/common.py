"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A top-level column, also when its name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus ``value``, computed once a row.  A plain column would be
    copied into every later expression that uses it; a generator's is not."""
    return df.select("*", F.explode(F.array(value)).alias(name))
