"""Entropy profiles, univariate ("table one") summaries and wide pivots
(§2.4 A8 A9 A15, §2.8 R8, §2.11 C19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import attach_scalars, exact_quantiles


def entropy_profile(long: DataFrame, id: str = "patid", var: str = "var", val: str = "val",
                    absent_is_level: bool = False) -> DataFrame:
    """Per variable: ``pe = ln(#values)``, ``ee1 = sum p1 ln(1/p1)`` with
    ``p1 = ids(value) / all ids``, ``ee2`` with ``p2 = ids(value) / ids(var)``
    (C19: A8).  ``absent_is_level=True`` counts "absent" as one more value and
    adds ``ee3 = ee1 if ee2 == 0 else ee2`` (A9).

    One distinct pass over (id, var, value), reused by the three counts: ids per
    (var, value), ids per var, ids overall (one row, a scalar subquery).
    """
    d = long.select(F.col(id).alias("_id"), var, val).distinct()
    n_all = d.agg(F.countDistinct("_id").alias("_N"))
    per_val = d.groupBy(var, val).agg(F.count("_id").alias("_vn"))
    per_var = d.groupBy(var).agg(F.countDistinct("_id").alias("_varn"))
    j = attach_scalars(per_val.join(per_var, var), n_all)
    j = j.withColumn("_p1", F.col("_vn") / F.col("_N")).withColumn("_p2", F.col("_vn") / F.col("_varn"))
    extra = 1 if absent_is_level else 0
    out = j.groupBy(var).agg(
        F.ln(F.count(F.lit(1)) + F.lit(extra)).alias("pe"),
        F.sum(F.col("_p1") * F.ln(1 / F.col("_p1"))).alias("ee1"),
        F.sum(F.col("_p2") * F.ln(1 / F.col("_p2"))).alias("ee2"))
    if absent_is_level:
        out = out.withColumn("ee3", F.when(F.col("ee2") == 0, F.col("ee1")).otherwise(F.col("ee2")))
    return out


def univariate_summary(long: DataFrame, var: str = "var", val: str = "val", type_: str = "type",
                       by: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Mixed univariate summary over a typed long table (A15), overall or by a
    group column.  Numeric variables: ``n, mean, sd, median, q1, q3`` (exact
    percentiles; values that are not numbers count as missing); categorical: ``n`` and ``pct`` (share of the variable's
    non-missing rows) per level.  Quantiles are exact and distributed
    (:func:`ranks.exact_quantiles`), so no variable's values sit in one task."""
    g = [by] if by else []
    numeric = long.filter(F.col(type_) == "N").withColumn("_x", F.col(val).try_cast("double"))
    mom = numeric.groupBy(*g, var).agg(F.count("_x").alias("n"), F.avg("_x").alias("mean"),
                                       F.stddev_samp("_x").alias("sd"))
    qs = exact_quantiles(numeric, [*g, var], "_x", {"median": 0.5, "q1": 0.25, "q3": 0.75}).drop("n")
    num = (mom.join(qs, [*g, var], "left")
           .withColumn("level", F.lit(None).cast("string")).withColumn("pct", F.lit(None).cast("double")))
    cat = long.filter(F.col(type_) == "C").groupBy(*g, var, F.col(val).alias("level")).agg(
        F.count(F.lit(1)).alias("n"))
    tot = cat.groupBy(*g, var).agg(F.sum("n").alias("_t"))
    cat = (cat.join(tot, [*g, var]).withColumn("pct", F.col("n") / F.col("_t")).drop("_t")
           .withColumn("mean", F.lit(None).cast("double")).withColumn("sd", F.lit(None).cast("double"))
           .withColumn("median", F.lit(None).cast("double")).withColumn("q1", F.lit(None).cast("double"))
           .withColumn("q3", F.lit(None).cast("double")))
    cols = [*g, var, "level", "n", "pct", "mean", "sd", "median", "q1", "q3"]
    out = num.select(*cols).unionByName(cat.select(*cols))
    if labels is not None:  # (var, var_label): pretty names, the variable itself when unlabelled
        lab = labels.groupBy(F.col("var").alias(var)).agg(F.min("var_label").alias("var_label"))
        out = out.join(lab, var, "left").withColumn("var_label", F.coalesce("var_label", var))
    return out


def pivot_fill(long: DataFrame, row: str, var: str, val: str, variables: Sequence[str],
               fill: str = "NI", order: Sequence[str] = ()) -> DataFrame:
    """Long -> wide for the listed variables, missing cells ``fill``.
    Of several values per (row, variable) the first one by ``order``, then by
    value: a total order.  The value list is explicit, so Spark plans a single
    aggregation (no extra job to discover the levels)."""
    w = (long.filter(F.col(var).isin(list(variables)))
         .groupBy(row).pivot(var, list(variables)).agg(F.min(F.struct(*order, val))[val]))
    return w.fillna(fill, subset=list(variables))


def collapse_labels(df: DataFrame, group: Sequence[str], label: str, sep: str = "\n",
                    out: str = "labels") -> DataFrame:
    """All labels of a group in one text, sorted, joined by ``sep`` (A11).  The
    list per group is bounded by the group's distinct labels."""
    return df.groupBy(*group).agg(F.array_join(F.sort_array(F.collect_set(label)), sep).alias(out))
