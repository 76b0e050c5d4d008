"""Helpers shared by the training-data operators: stage tables, row digests,
one-pass bindings inside a native expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlink.session import materialize


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back, so
    that later steps re-read files instead of recomputing what is upstream."""
    return materialize(df, f"llm-{name}", compression=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read by Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body
    uses it (a lambda variable is never inlined by the optimizer)."""
    return F.transform(F.array(value), body)[0]


def text_of(name: str) -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def digest_of(text: Column) -> Column:
    """64-bit digest of a text: with the id it names a row's content."""
    return F.xxhash64(text)


def take_columns(docs: DataFrame, **names: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that other
    columns of the input never clash with what the operator adds."""
    return docs.select(*[F.col(f"`{src}`").alias(own) for own, src in names.items()])
