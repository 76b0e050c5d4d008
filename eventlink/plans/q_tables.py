"""Stored results: a declared table with appends, a globally sorted result, a
weighted running sum (S4 S5 O1 W8)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..operators import events
from ..session import scratch_folder
from ..sources.lookup import DeclaredTable, read_sorted, write_sorted
from ..sources.tables import Fixtures
from .oracle import compose
from .pipeline import Pipeline
from .registry import register


def _pipe(spark, sf_dir) -> Pipeline:
    return Pipeline(Fixtures(spark, sf_dir))


@register("running_los", 1, "W5 W8 (weighted running sum)", compose("""
SELECT patid, encounterid, CAST(SUM(COALESCE(days, 0)) OVER (PARTITION BY patid ORDER BY admit_date, encounterid
                                                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_days
FROM (SELECT *, date_diff('day', admit_date, discharge_date) AS days FROM o_admit) a"""))
def running_los(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    a = p.admit.withColumn("days", F.datediff("discharge_date", "admit_date"))
    rows = events.running_stats(a, counter="days", skew_safe=p.skew_safe)
    return rows.select("patid", "encounterid", F.col("running_n").alias("running_days"))


EVENT_TABLE = StructType([StructField("patid", LongType()), StructField("encounterid", LongType()),
                          StructField("enc_type", StringType()), StructField("admit_date", DateType()),
                          StructField("discharge_date", DateType()), StructField("provider_id", StringType())])


# The second source has no discharge date; it is appended twice.
@register("declared_events", 10, "S4 S5 U3 U4 U5 (declared table, each source replaces its own rows)", compose("""
SELECT patid, encounterid, enc_type, admit_date, discharge_date, CAST(provider_id AS VARCHAR) AS provider_id, 'EHR' AS src
FROM o_admit WHERE encounterid % 2 = 0
UNION ALL
SELECT patid, encounterid, enc_type, admit_date, NULL, CAST(provider_id AS VARCHAR), 'CMS' FROM o_admit WHERE encounterid % 2 = 1"""))
def declared_events(spark, sf_dir):
    a = _pipe(spark, sf_dir).admit
    table = DeclaredTable(spark, scratch_folder(spark, "declared-events"), EVENT_TABLE, "src")
    arms = {"CMS": a.filter("encounterid % 2 = 1").drop("discharge_date"), "EHR": a.filter("encounterid % 2 = 0")}
    for name in ("CMS", "EHR", "CMS"):
        table.append(name, [arms[name]])
    return table.read()


@register("sorted_events", 10, "O1 (globally sorted result)", compose("""
SELECT row_number() OVER (ORDER BY patid, admit_date DESC, encounterid) AS pos, patid, encounterid, admit_date FROM o_admit"""))
def sorted_events(spark, sf_dir):
    path = scratch_folder(spark, "sorted-events")
    rows = _pipe(spark, sf_dir).admit.select("patid", "encounterid", "admit_date")
    write_sorted(rows, path, ["patid", F.desc("admit_date"), "encounterid"], ["patid", "admit_date"])
    return read_sorted(spark, path)
