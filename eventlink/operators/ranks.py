"""Global order statistics without an unpartitioned window.

``row_number()/dense_rank() over (order by k)`` with no ``PARTITION BY`` makes
Spark move every row into one task.  Here the distinct keys are range
partitioned (Spark samples the bounds), sorted inside each partition and
numbered locally; a tiny table of per-partition counts gives each partition
its offset.  The numbered key table is written once (shared checkpoint
folder), so the ids are fixed even if a task is re-run after executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def by_key(df: DataFrame) -> DataFrame:
    """``df``, a table with a row per person or event, as a join side that is shuffled.
    Spark would broadcast it while its files are small; compressed columns say little
    about the rows that a broadcast holds in the driver and in every executor."""
    return df.hint("merge")


_LOCAL_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row in partition


def numbered_keys(df: DataFrame, keys: Sequence[str], name: str = "rowid", partitions: int | None = None,
                  descending: bool = False, persist: bool = True) -> DataFrame:
    """Distinct ``keys`` with a dense 1-based rank ``name`` in key order."""
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    d = df.select(*keys).distinct()
    # Without an explicit count AQE sizes the range partitions from the data
    # (coalescing adjacent ranges keeps the order, so the numbering holds).
    d = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    k = d.sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    if persist:
        k = materialize(k, f"keys-{name}")
    k = k.withColumn("_p", F.shiftright("_m", _LOCAL_BITS)).withColumn(
        "_l", F.col("_m") - F.shiftleft(F.col("_p"), _LOCAL_BITS))
    counts = k.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: this window's single task holds `partitions` rows.
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (k.join(F.broadcast(offsets.select("_p", "_off")), "_p")
            .select(*keys, (F.col("_off") + F.col("_l") + 1).cast("bigint").alias(name)))


def numbered_rows(df: DataFrame, order: Sequence[str], name: str = "_pos", descending: bool = False,
                  persist: bool = True) -> DataFrame:
    """Every row of ``df`` with its 1-based position in ``order`` (which should
    be unique).  Like :func:`numbered_keys` but numbers the rows themselves: no
    distinct and no join back, one range shuffle and one write."""
    cols = [F.col(k).desc() if descending else F.col(k).asc() for k in order]
    k = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_m", F.monotonically_increasing_id())
    if persist:
        k = materialize(k, f"rows-{name}")
    k = k.withColumn("_p", F.shiftright("_m", _LOCAL_BITS))
    counts = k.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    pos = F.col("_off") + F.col("_m") - F.shiftleft(F.col("_p"), _LOCAL_BITS) + 1
    return (k.join(F.broadcast(offsets.select("_p", "_off")), "_p")
            .select(*df.columns, pos.cast("bigint").alias(name)))


def positioned(df: DataFrame, order: Sequence[str], following: Sequence[str], name: str = "_pos",
               next: str = "_next") -> DataFrame:
    """Every row of ``df`` with its 1-based position in ``order`` (unique), the
    struct ``next`` of the ``following`` columns of the row behind it, and its
    range partition ``_p``.

    One range shuffle and one write.  The next row is a ``lead`` inside the
    range partition; only a partition's last row takes it from the first row of
    the partition behind, out of a table with one row per partition."""
    k = _staged_in_order(df, order, False, f"rows-{name}")
    row = F.struct(*following)
    wp = Window.orderBy("_p")  # one row per partition
    parts = k.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min_by(row, "_m").alias("_head"))
    parts = parts.select("_p", F.lead("_head").over(wp).alias("_head"), F.coalesce(
        F.sum("_n").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    k = k.withColumn(next, F.lead(row).over(Window.partitionBy("_p").orderBy("_m")))
    pos = F.col("_off") + F.col("_m") - F.shiftleft(F.col("_p"), _LOCAL_BITS) + 1
    return k.join(F.broadcast(parts), "_p").select(
        *df.columns, pos.cast("bigint").alias(name), F.coalesce(next, "_head").alias(next), "_p")


def surrogate_id(df: DataFrame, keys: Sequence[str], name: str = "rowid", persist: bool = True) -> DataFrame:
    """``dense_rank() over (order by keys)`` attached to every row (W9).  Null
    keys take part and are ranked first, as in the window."""
    ids = numbered_keys(df, keys, name, persist=persist)
    own = df.columns
    same = [df[k].eqNullSafe(ids[k]) for k in keys]
    return df.join(ids, reduce(lambda a, b: a & b, same)).select(*[df[c] for c in own], ids[name])


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row) to every
    row of ``df`` (J15) as a scalar subquery: Spark evaluates it once and reads
    the value in each task -- no join, no cross product."""
    cols = one_row.columns
    sc = one_row.select(F.struct(*cols).alias("_sc")).scalar()
    return df.withColumn("_sc", sc).select("*", *[F.col("_sc")[c].alias(c) for c in cols]).drop("_sc")


def _staged_in_order(df: DataFrame, order: Sequence[str], descending: bool, name: str) -> DataFrame:
    """Rows range partitioned and sorted by ``order``, written once, with their
    partition ``_p`` and their place in it ``_m``."""
    cols = [F.col(k).desc() if descending else F.col(k).asc() for k in order]
    k = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_m", F.monotonically_increasing_id())
    return materialize(k, name).withColumn("_p", F.shiftright("_m", _LOCAL_BITS))


def global_cumsum(df: DataFrame, order: Sequence[str], values: Sequence[str], descending: bool = False,
                  suffix: str = "_cum") -> DataFrame:
    """Running sums of ``values`` in the global order of ``order`` (unique
    keys), used by the ROC / precision-recall evaluation on distinct scores.

    One range shuffle and one write: the sums run inside the sorted range
    partitions and are shifted by the totals of the preceding partitions (a
    table with one row per partition)."""
    k = _staged_in_order(df, order, descending, "cumsum")
    w = Window.partitionBy("_p").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    local = k.select("*", *[F.sum(v).over(w).alias(f"_loc_{v}") for v in values])
    # One row per partition: this window's single task holds `partitions` rows.
    wp = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    total = k.groupBy("_p").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    total = total.select("_p", *[F.coalesce(F.sum(f"_t_{v}").over(wp), F.lit(0)).alias(f"_off_{v}") for v in values])
    return local.join(F.broadcast(total), "_p").select(
        *df.columns, *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(f"{v}{suffix}") for v in values])


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float],
                    weight: str | None = None) -> DataFrame:
    """Exact per-group quantiles (linear interpolation, as ``percentile`` /
    ``quantile_cont``) without holding a group's values in one task.

    Values are counted per (group, value) first, so repeats never travel; the
    counts are cumulated in (group, value) order (:func:`global_cumsum`, a group
    holding a third of all rows spans many tasks), and the two order statistics
    around each target rank are conditional maxima, aggregated map-side.
    Values that are not numbers are ignored, as nulls are.  ``weight``: a column
    with the number of times that a row counts."""
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    keyed = [F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]
    names = [f"_g{i}" for i in range(len(groups))]
    base = df.select(*keyed, F.col(value).try_cast("double").alias("_v"), times.alias("_w"))
    counts = base.filter(F.col("_v").isNotNull() & (F.col("_w") > 0)).groupBy(*names, "_v").agg(F.sum("_w").alias("_c"))
    cum = global_cumsum(counts, [*names, "_v"], ["_c"])
    per = cum.groupBy(*[F.col(n).alias(f"{n}_of") for n in names]).agg(
        F.min(F.col("_c_cum") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"))
    if names:
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_of")) for n in names])
        rows = cum.join(per, same)
    else:
        rows = attach_scalars(cum, per)

    def at(rank: Column) -> Column:  # the value at a 0-based rank of the group
        place = F.col("_start") + rank
        return F.max(F.when((place >= F.col("_c_cum") - F.col("_c")) & (place < F.col("_c_cum")), F.col("_v")))

    found = []
    for i, p in enumerate(probs.values()):
        target = (F.col("_n") - 1) * F.lit(float(p))
        found += [at(F.floor(target)).alias(f"_lo{i}"), at(F.ceil(target)).alias(f"_hi{i}")]
    q = rows.groupBy(*names, "_n").agg(*found)
    part = [(F.col("_n") - 1) * F.lit(float(p)) - F.floor((F.col("_n") - 1) * F.lit(float(p))) for p in probs.values()]
    return q.select(*[F.col(n).alias(g) for n, g in zip(names, groups)], F.col("_n").alias("n"),
                    *[(F.col(f"_lo{i}") + part[i] * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name)
                      for i, name in enumerate(probs)])


def segmented_cumsum(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str],
                     descending: bool = False, suffix: str = "_cum", total: str = "_total") -> DataFrame:
    """Running sums of ``values`` in ``order`` that start anew in each group of
    ``by``, and each group's whole sums.

    One pass over all groups: the sums run through (by, order) as in
    :func:`global_cumsum`, whose range partitions cut a large group over many
    tasks, and a group's start (one row per group) is taken off again.  Null
    group keys are a group."""
    cum = global_cumsum(df, [*by, *order], values, descending, "_all")
    names = {b: f"{b}_of" for b in by}
    per = cum.groupBy(*[F.col(b).alias(n) for b, n in names.items()]).agg(
        *[F.min(F.col(f"{v}_all") - F.col(v)).alias(f"{v}_start") for v in values],
        *[F.sum(v).alias(f"{v}{total}") for v in values])
    if by:
        rows = cum.join(per, reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(n)) for b, n in names.items()]))
    else:
        rows = attach_scalars(cum, per)
    return rows.select(*df.columns, *[(F.col(f"{v}_all") - F.col(f"{v}_start")).alias(f"{v}{suffix}") for v in values],
                       *[f"{v}{total}" for v in values])
