"""Evaluation of many models in one pass: measures at every cutoff and overall
measures with intervals, calibration, and a stratified bootstrap band (§2.4
A17-A20, C20).

``by`` names the columns that tell models apart.  Rows are reduced to one per
(model, score) first; running counts come from :func:`ranks.segmented_cumsum`,
so neither a model nor a score gets a window of its own, and every statistic is
an aggregate.  Rows without a score are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .evaluate import Z95, chi2_upper_tail
from .ranks import attach_scalars, exact_quantiles, segmented_cumsum

MODEL = ("model",)


def model_counts(scores: DataFrame, by: Sequence[str] = MODEL, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """by, score, pos, neg: one row per model and distinct score."""
    hit = (F.col(actual) == 1).cast("bigint")
    return scores.filter(F.col(pred).isNotNull()).groupBy(*by, F.col(pred).alias("score")).agg(
        F.sum(F.coalesce(hit, F.lit(0))).alias("pos"), F.sum(1 - F.coalesce(hit, F.lit(0))).alias("neg"))


def reached(scores: DataFrame, by: Sequence[str] = MODEL, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """by, score, pos, neg, tp, fp (counts at the score or above), P, N."""
    c = segmented_cumsum(model_counts(scores, by, pred, actual), by, ["score"], ["pos", "neg"], descending=True)
    return c.select(*by, "score", "pos", "neg", F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                    F.col("pos_total").alias("P"), F.col("neg_total").alias("N"))


def between(x: Column, low: float | None = 0.0, high: float | None = 1.0) -> Column:
    """``x`` kept within bounds; null stays null."""
    bounded = x if low is None else F.greatest(x, F.lit(low))
    return F.when(x.isNotNull(), bounded if high is None else F.least(bounded, F.lit(high)))


def wilson(hits: Column, n: Column) -> tuple[Column, Column, Column]:
    """A share with its Wilson limits; null without cases."""
    n = F.when(n > 0, n).cast("double")
    p = hits / n
    z2 = Z95 * Z95
    middle, wide = (p + z2 / (2 * n)) / (1 + z2 / n), Z95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return p, between(middle - wide), between(middle + wide)


def perf_at(scores: DataFrame, by: Sequence[str] = MODEL, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """by, cutoff, meas, meas_val_m, meas_val_lb, meas_val_ub: recall, specificity,
    precision and negative predictive value at every cutoff (positive from the
    cutoff on), each with closed-form limits (A17)."""
    c = reached(scores, by, pred, actual)
    tn, fn = F.col("N") - F.col("fp"), F.col("P") - F.col("tp")
    shares = {"rec_sens": (F.col("tp"), F.col("P")), "spec": (tn, F.col("N")),
              "prec": (F.col("tp"), F.col("tp") + F.col("fp")), "npv": (tn, tn + fn)}
    rows = [F.struct(F.lit(name).alias("meas"), *[x.alias(f"meas_val_{k}") for k, x in zip(("m", "lb", "ub"), wilson(*s))])
            for name, s in shares.items()]
    found = c.select(*by, F.col("score").alias("cutoff"), F.explode(F.array(*rows)).alias("_r"))
    return found.select(*by, "cutoff", "_r.*").filter(F.col("meas_val_m").isNotNull())


def perf_summ(scores: DataFrame, by: Sequence[str] = MODEL, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """by, overall_meas, meas_val_m, meas_val_lb, meas_val_ub: ``roauc`` (ties count
    half, DeLong interval), ``prauc1`` (mean precision over the positives) and
    ``prev`` (Wilson) (A17 A18).

    The interval of ``prauc1`` comes from its influence values.  With D = tp + fp
    at a score, precision tp / D moves by P * fp / D^2 per unit of recall and by
    -N * tp / D^2 per unit of false positive rate; what one case adds to all
    scores at or below its own is a running sum of these, so two more sums over
    the distinct scores give every case's influence.  A model without cases of
    both classes gets null limits, and no value where there is none."""
    c = reached(scores, by, pred, actual)
    p, n = F.col("P").cast("double"), F.col("N").cast("double")
    d = (F.col("tp") + F.col("fp")).cast("double")
    c = (c.withColumn("prec", F.col("tp") / d)
         .withColumn("up", F.col("pos") * F.col("fp") / (d * d))   # mass pos/P times P * fp / D^2
         .withColumn("down", F.try_divide(F.col("pos") * n * F.col("tp") / (d * d), p)))
    sums = segmented_cumsum(c, by, ["score"], ["up", "down"])
    v10 = F.try_divide(n - F.col("fp") + F.col("neg") * 0.5, n)
    v01 = F.try_divide(F.col("tp") - F.col("pos") + F.col("pos") * 0.5, p)
    means = sums.groupBy(*by).agg(
        F.max("P").alias("_P"), F.max("N").alias("_N"),
        F.try_divide(F.sum(F.col("pos") * v10), F.max(p)).alias("_auc"),
        F.sum(F.col("pos") * v10 * v10).alias("_q10"), F.sum(F.col("neg") * v01 * v01).alias("_q01"),
        F.try_divide(F.sum(F.col("pos") * F.col("prec")), F.max(p)).alias("_ap"),
        F.sum(F.try_divide(F.col("up") * F.col("tp"), p)).alias("_c1"),
        F.sum(F.try_divide(F.col("down") * F.col("fp"), n)).alias("_c0"))
    same = None
    for b in by:
        means = means.withColumnRenamed(b, f"{b}_of")
        equal = F.col(b).eqNullSafe(F.col(f"{b}_of"))
        same = equal if same is None else same & equal
    each = sums.join(means, same) if by else attach_scalars(sums, means)
    of_pos = F.col("prec") - F.col("_ap") + F.col("up_cum") - F.col("_c1")
    of_neg = F.col("_c0") - F.col("down_cum")
    spread = each.groupBy(*by).agg(
        *[F.first(x).alias(x) for x in ("_P", "_N", "_auc", "_q10", "_q01", "_ap")],
        F.sum(F.col("pos") * of_pos * of_pos).alias("_vp"), F.sum(F.col("neg") * of_neg * of_neg).alias("_vn"))
    p, n = F.col("_P").cast("double"), F.col("_N").cast("double")
    s10 = F.try_divide(F.col("_q10") - p * F.col("_auc") * F.col("_auc"), p - 1)
    s01 = F.try_divide(F.col("_q01") - n * F.col("_auc") * F.col("_auc"), n - 1)
    se = {"roauc": F.sqrt(between(F.try_divide(s10, p) + F.try_divide(s01, n), high=None)),
          "prauc1": F.sqrt(F.try_divide(F.col("_vp"), p * p) + F.try_divide(F.col("_vn"), n * n))}
    limits = lambda m, s: (m, between(m - Z95 * s), between(m + Z95 * s))
    rows = {"roauc": limits(F.when(n > 0, F.col("_auc")), se["roauc"]), "prauc1": limits(F.col("_ap"), se["prauc1"]),
            "prev": wilson(F.col("_P"), F.col("_P") + F.col("_N"))}
    cells = [F.struct(F.lit(name).alias("overall_meas"), *[x.alias(f"meas_val_{k}") for k, x in zip(("m", "lb", "ub"), v)])
             for name, v in rows.items()]
    return spread.select(*by, F.explode(F.array(*cells)).alias("_r")).select(*by, "_r.*")


def roc_points(scores: DataFrame, by: Sequence[str] = MODEL, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """by, cutoff, sens, spec, recall, prec: the curves of all models."""
    c = reached(scores, by, pred, actual)
    sens = F.try_divide("tp", "P")
    return c.select(*by, F.col("score").alias("cutoff"), sens.alias("sens"),
                    F.try_divide(F.col("N") - F.col("fp"), "N").alias("spec"), sens.alias("recall"),
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("prec"))


def calibration(scores: DataFrame, n_bin: int = 20, by: Sequence[str] = MODEL, id: str = "id", pred: str = "pred",
                actual: str = "actual") -> DataFrame:
    """by, bin, n, y_p, pred_p, binCI_lower, binCI_upper, obs, expct: bins of equal
    count in (pred, id) order, per model (A20)."""
    one = scores.filter(F.col(pred).isNotNull()).select(*by, id, pred, actual, F.lit(1).cast("bigint").alias("_one"))
    c = segmented_cumsum(one, by, [pred, id], ["_one"])
    c = c.withColumn("bin", (F.floor((F.col("_one_cum") - 1) * n_bin / F.col("_one_total")) + 1).cast("int"))
    b = c.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(actual).alias("y_p"), F.avg(pred).alias("pred_p"),
                                  F.sum(actual).cast("double").alias("obs"), F.sum(pred).alias("expct"))
    _, low, high = wilson(F.col("obs"), F.col("n"))
    return b.select(*by, "bin", "n", "y_p", "pred_p", low.alias("binCI_lower"), high.alias("binCI_upper"), "obs", "expct")


def calibration_tests(bins: DataFrame, by: Sequence[str] = MODEL) -> DataFrame:
    """by, test, statistics, dof, pval: Hosmer-Lemeshow per model, for any number
    of bins."""
    part = F.pow(F.col("obs") - F.col("expct"), 2) / (F.col("expct") * (1 - F.col("expct") / F.col("n")))
    s = bins.groupBy(*by).agg(F.sum(part).alias("statistics"), (F.count(F.lit(1)) - 2).alias("dof"))
    return s.select(*by, F.lit("hosmer_lemeshow").alias("test"), "statistics", "dof",
                    chi2_upper_tail(F.col("statistics"), F.col("dof")).alias("pval"))


# -- stratified bootstrap -----------------------------------------------------

BLOCK = 4096


def _seeded(seed: int, *parts: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, *parts])))


def stratified_band(scores: DataFrame, reps: int = 500, points: int = 25, by: Sequence[str] = MODEL, pred: str = "pred",
                    actual: str = "actual", seed: int = 42, block: int = BLOCK) -> DataFrame:
    """by, x (specificity), sens_lb, sens_m, sens_ub: bootstrap band of sensitivity
    with positives and negatives drawn apart (A19).

    Each replicate draws exactly P of the positives and N of the negatives with
    replacement: a multinomial draw of the score-level counts, split over a tree of
    two levels.  The first draw deals a class over blocks of ``block`` consecutive
    scores, the next ones deal a block's share over its scores, each seeded by
    replicate, class and block, so that a task that runs again draws the same.  Rows
    are never multiplied; a task holds the counts of one block."""
    by = list(by)
    c = model_counts(scores, by, pred, actual).withColumn("_one", F.lit(1).cast("bigint"))
    ranked = segmented_cumsum(c, by, ["score"], ["_one", "pos", "neg"], descending=True)
    ranked = ranked.withColumn("_blk", F.floor((F.col("_one_cum") - 1) / block)).select(
        *by, "_blk", F.col("_one_cum").alias("_place"), "pos", "neg", F.col("pos_total").alias("_P"), F.col("neg_total").alias("_N"))
    ranked = materialize(ranked, "ranked-scores")
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name in by)
    blocks = ranked.groupBy(*by, "_blk").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                             F.first("_P").alias("_P"), F.first("_N").alias("_N"))

    def share(g: pd.DataFrame) -> pd.DataFrame:
        """Draws of each block, and of the blocks before it, in each replicate."""
        g = g.sort_values("_blk")
        out = []
        for rep in range(1, reps + 1):
            drawn = [_seeded(seed, rep, side).multinomial(t := int(g[c].sum()), g[c].to_numpy() / max(t, 1))
                     for side, c in enumerate(("pos", "neg"))]
            out.append(np.stack([np.full(len(g), rep), *drawn, *[np.cumsum(x) - x for x in drawn]]))
        cells = np.stack(out, axis=2).reshape(5, -1)  # block by block
        part = g.loc[g.index.repeat(reps), [*by, "_blk", "_P", "_N"]].reset_index(drop=True)
        return part.assign(**{n: v for n, v in zip(("rep", "_dp", "_dn", "_op", "_on"), cells)})

    # one row per block and replicate
    drawn = blocks.groupBy(*by).applyInPandas(share, f"{keys}, _blk long, _P long, _N long, rep long, _dp long, _dn long, "
                                                     "_op long, _on long")
    drawn = materialize(drawn, "block-draws")
    last = points - 1

    def reach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The best sensitivity at each specificity that a point of the block reaches."""
        left = left.sort_values("_place")
        out = []
        shares = [left[c].to_numpy() / max(int(left[c].sum()), 1) for c in ("pos", "neg")]
        for r in right.itertuples(index=False):
            values = dict(zip(right.columns, r))
            tp, fp = (np.cumsum(_seeded(seed, int(values["rep"]), side, int(values["_blk"]), 1).multinomial(
                int(values[d]), shares[side])) + values[o] for side, (d, o) in enumerate((("_dp", "_op"), ("_dn", "_on"))))
            g = np.floor((1 - fp / max(values["_N"], 1)) * last + 1e-9).astype(np.int64)
            best = np.full(points, -1.0)
            np.maximum.at(best, g, tp / max(values["_P"], 1))
            at = np.flatnonzero(best >= 0)
            out.append(pd.DataFrame({"rep": values["rep"], "g": at, "sens": best[at]}))
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"rep": [], "g": [], "sens": []})
        return found.assign(**{b: left[b].iloc[0] for b in by})[[*by, "rep", "g", "sens"]]

    groups = [*by, "_blk"]
    met = ranked.groupBy(*groups).cogroup(drawn.groupBy(*groups)).applyInPandas(reach, f"{keys}, rep long, g long, sens double")
    met = materialize(met.groupBy(*by, "rep", "g").agg(F.max("sens").alias("sens")), "band-points")
    # the best over all points at or above a specificity; the point before the first score is (spec 1, sens 0)
    grid = met.select(*by, "rep").distinct().withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))
    grid = grid.withColumn("sens", F.lit(0.0)).unionByName(met)
    above = Window.partitionBy(*by, "rep").orderBy(F.col("g").desc()).rangeBetween(Window.unboundedPreceding, 0)
    at = grid.select(*by, "rep", "g", F.max("sens").over(above).alias("sens")).distinct()  # points rows a replicate
    q = exact_quantiles(at.withColumn("x", F.col("g") / F.lit(float(last))), [*by, "x"], "sens",
                        {"sens_lb": 0.025, "sens_m": 0.5, "sens_ub": 0.975})
    return q.select(*by, "x", "sens_lb", "sens_m", "sens_ub")
