"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.session import new_work_dir

#: A word: a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column | str) -> Column:
    """The words of a text; NULL text has none."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD), F.lit(0))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: later steps never recompute or lose it."""
    spark = df.sparkSession
    path = new_work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that clashes with none of df's (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(df: DataFrame) -> Column:
    """Hash of the identifying columns; together with doc_id it names a row up to exact repeats."""
    return F.xxhash64(F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source")) if {"lang", "source"} <= set(df.columns) \
        else F.xxhash64(F.col("doc_id"), F.col("text"))


def let(value: Column, body) -> Column:
    """body(value) with ``value`` evaluated once per row.

    An alias used inside a lambda may be inlined by the optimizer and then be
    evaluated once per array element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]
