"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.session import checkpoint_dir

#: Fixed values of the operators' contracts: what separates words, and what a word is.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Rows from which a kept table has more than one partition.
KEPT_ROWS = 100_000


def kept(df: DataFrame) -> DataFrame:
    """``checkpointed``, in partitions that suit its number of rows: a small table then costs the shuffles after it few files."""
    df = checkpointed(df)
    return df.coalesce(-(-max(df.count(), 1) // KEPT_ROWS))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the right side's keys are dropped."""
    other = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    joined = left.join(other, on, how)
    return joined.drop(*[f"__r_{c}" for c in keys])


def wrapped(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Whole rows of ``docs`` in one struct ``row``, beside the ``columns`` that an operator needs.

    Whatever other columns a table has, their names can then not meet those of
    the operator; ``select("row.*")`` brings them back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)
