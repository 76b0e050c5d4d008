"""Reference lists and summary outputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_lookup(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Reference CSV with a header, quoted commas and multi-line quoted cells
    (S2).  An explicit schema avoids an inference pass; without one every
    column is read as text."""
    r = (spark.read.option("header", True).option("multiLine", True)
         .option("quote", '"').option("escape", '"'))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def append_conform(dfs: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """Stack frames into one typed frame: columns matched by name, missing ones
    NULL, every column cast to the declared type (S4 S5 U3 U4 U5).  One plan,
    no intermediate appends."""
    out = None
    for df in dfs:
        have = {c.lower(): c for c in df.columns}
        cols = [(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields]
        d = df.select(*cols)
        out = d if out is None else out.unionByName(d)
    if out is None:
        raise ValueError("append_conform needs at least one frame")
    return out


class DeclaredTable:
    """A stored table with declared columns that several sources append to, each
    into its own partition (S4 S5).

    ``append`` conforms a source's frames to the declaration and replaces that
    source's rows and no others (dynamic partition overwrite): an arm that runs
    again, or a job that starts again half way, leaves each row once."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, source: str = "source"):
        if source in schema.names:
            raise ValueError(f"{source} names the partition and is no declared column")
        self.spark, self.path, self.schema, self.source = spark, path, schema, source

    def append(self, name: str, dfs: Sequence[DataFrame]) -> None:
        rows = append_conform(dfs, self.schema).withColumn(self.source, F.lit(name))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.source)
         .parquet(self.path))

    def read(self) -> DataFrame:
        """All rows, the source last; the declared types, without inference."""
        whole = StructType([*self.schema.fields, StructField(self.source, StringType())])
        return self.spark.read.schema(whole).parquet(self.path)


def write_sorted(df: DataFrame, path: str, order: Sequence[str | Column], bounds: Sequence[str]) -> None:
    """``df`` in ``order`` over many files (O1): range partitions, each sorted, and
    a manifest with one row per part: its number, rows, the rows before it, and the
    smallest and largest ``bounds`` columns in it.

    No task sees more than its range; the order should be unique, so that a key
    with many rows is cut over parts."""
    place = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", place)
    rows = rows.withColumn("_part", F.shiftright("_m", 33).cast("int"))
    rows = rows.withColumn("_place", F.col("_m") - F.shiftleft(F.col("_part").cast("bigint"), 33)).drop("_m")
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
    key = F.struct(*bounds)
    parts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min_by(key, "_place").alias("first"),
                                         F.max_by(key, "_place").alias("last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
    parts.write.mode("overwrite").parquet(f"{path}/manifest")


def read_sorted(spark: SparkSession, path: str, name: str = "pos") -> DataFrame:
    """The rows with their 1-based place ``name`` in the whole order."""
    rows, parts = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/manifest")
    found = rows.join(parts.select("_part", "before"), "_part")
    return found.withColumn(name, F.col("before") + F.col("_place") + 1).drop("_part", "_place", "before")


def write_summary_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Summary table as CSV with a header (S7).  Summaries are small; the write
    stays distributed (one file per partition)."""
    df.write.mode(mode).option("header", True).csv(path)


def build_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build-once artifact (S8): read ``path`` if a finished parquet table is
    there, else build, write and read it back."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
