"""Evaluation of several models in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports
from ..sources.tables import Fixtures
from .oracle import compose
from .registry import register

# Four models over the score fixture: as it is, tied scores, a subset of the rows, no signal.
MODELS = {"base": ("pred", "true"), "sdoh_s": ("floor(pred * 100) / 100", "true"), "sdoh_i": ("pred * pred", "id % 3 > 0"),
          "sdoh_si": ("abs(pred - 0.5)", "id % 5 > 1")}
_MODELS = " UNION ALL ".join(f"SELECT '{m}' AS model, id, actual, {pred} AS pred FROM fx_scores WHERE {rows}"
                             for m, (pred, rows) in MODELS.items())
Z = 1.959963984540054


def model_scores(fx: Fixtures):
    arms = [fx.fx_scores.where(rows).select(F.lit(m).alias("model"), "id", "actual", F.expr(pred).alias("pred"))
            for m, (pred, rows) in MODELS.items()]
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    return out


def _r(c):
    return F.round(F.col(c), 9).alias(c)


_REACHED = """
SELECT model, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER m AS p, sum(neg) OVER m AS n
FROM (SELECT model, pred AS score, CAST(count(*) FILTER (actual = 1) AS DOUBLE) AS pos,
             CAST(count(*) FILTER (actual <> 1) AS DOUBLE) AS neg FROM o_models WHERE pred IS NOT NULL GROUP BY model, pred) c
WINDOW w AS (PARTITION BY model ORDER BY score DESC), m AS (PARTITION BY model)"""

_WILSON = (f"round(x / t, 9) AS meas_val_m, "
           f"round(greatest((x / t + {Z} * {Z} / (2 * t) - {Z} * sqrt(x / t * (1 - x / t) / t + {Z} * {Z} / (4 * t * t))) "
           f"/ (1 + {Z} * {Z} / t), 0), 9) AS meas_val_lb, "
           f"round(least((x / t + {Z} * {Z} / (2 * t) + {Z} * sqrt(x / t * (1 - x / t) / t + {Z} * {Z} / (4 * t * t))) "
           f"/ (1 + {Z} * {Z} / t), 1), 9) AS meas_val_ub")

_PERF_AT = " UNION ALL ".join(
    f"SELECT model, score AS cutoff, '{name}' AS meas, {_WILSON} FROM (SELECT model, score, {x} AS x, {t} AS t FROM o_reached) r "
    "WHERE t > 0" for name, x, t in (("rec_sens", "tp", "p"), ("spec", "n - fp", "n"), ("prec", "tp", "tp + fp"),
                                     ("npv", "n - fp", "n - fp + p - tp")))


@register("perf_at_models", 8, "A17 C20 (measures at every cutoff with limits, several models)",
          compose(_PERF_AT, ("o_models", _MODELS), ("o_reached", _REACHED)))
def perf_at_models(spark, sf_dir):
    r = reports.perf_at(model_scores(Fixtures(spark, sf_dir)))
    return r.select("model", "cutoff", "meas", _r("meas_val_m"), _r("meas_val_lb"), _r("meas_val_ub"))


# Influence of each case by comparing it with every score of its model.
_SUMM = f"""
WITH a AS (SELECT model, max(p) AS p, max(n) AS n, sum(pos * (n - fp + neg / 2) / n) / max(p) AS auc,
                  sum(pos * tp / (tp + fp)) / max(p) AS ap FROM o_reached GROUP BY model),
v AS (SELECT r.model, sum(pos * pow((r.n - fp + neg / 2) / r.n - auc, 2)) / (max(r.p) - 1) / max(r.p)
             + sum(neg * pow((tp - pos / 2) / r.p - auc, 2)) / (max(r.n) - 1) / max(r.n) AS var
      FROM o_reached r JOIN a ON a.model = r.model GROUP BY r.model),
moved AS (SELECT x.model, x.score, max(x.pos) AS pos, max(x.neg) AS neg, max(x.tp / (x.tp + x.fp)) AS prec,
                 sum(s.pos / s.p * s.p * s.fp / pow(s.tp + s.fp, 2) * (if(x.score >= s.score, 1, 0) - s.tp / s.p)) AS by_pos,
                 sum(s.pos / s.p * s.n * s.tp / pow(s.tp + s.fp, 2) * (if(x.score >= s.score, 1, 0) - s.fp / s.n)) AS by_neg
          FROM o_reached x JOIN o_reached s ON s.model = x.model GROUP BY x.model, x.score),
w AS (SELECT m.model, sum(pos * pow(prec - ap + by_pos, 2)) / max(p * p) + sum(neg * pow(by_neg, 2)) / max(n * n) AS var
      FROM moved m JOIN a ON a.model = m.model GROUP BY m.model)
SELECT a.model, 'roauc' AS overall_meas, round(auc, 9) AS meas_val_m, round(greatest(auc - {Z} * sqrt(var), 0), 9) AS meas_val_lb,
       round(least(auc + {Z} * sqrt(var), 1), 9) AS meas_val_ub FROM a JOIN v ON v.model = a.model
UNION ALL
SELECT a.model, 'prauc1', round(ap, 9), round(greatest(ap - {Z} * sqrt(var), 0), 9), round(least(ap + {Z} * sqrt(var), 1), 9)
FROM a JOIN w ON w.model = a.model
UNION ALL SELECT model, 'prev', {_WILSON} FROM (SELECT model, p AS x, p + n AS t FROM a) s"""


@register("perf_summ_models", 8, "A17 A18 C20 (overall measures with intervals, several models)",
          compose("SELECT * FROM (" + _SUMM + ") s", ("o_models", _MODELS), ("o_reached", _REACHED)))
def perf_summ_models(spark, sf_dir):
    r = reports.perf_summ(model_scores(Fixtures(spark, sf_dir)))
    return r.select("model", "overall_meas", _r("meas_val_m"), _r("meas_val_lb"), _r("meas_val_ub"))


@register("roc_points_models", 8, "A18 J23 C20 (curves of several models)", compose(
    "SELECT model, score AS cutoff, round(tp / p, 9) AS sens, round((n - fp) / n, 9) AS spec, round(tp / p, 9) AS recall, "
    "round(tp / (tp + fp), 9) AS prec FROM o_reached", ("o_models", _MODELS), ("o_reached", _REACHED)))
def roc_points_models(spark, sf_dir):
    r = reports.roc_points(model_scores(Fixtures(spark, sf_dir)))
    return r.select("model", "cutoff", *[_r(c) for c in ("sens", "spec", "recall", "prec")])


def _bins(n_bin: int) -> str:
    return f"""
SELECT model, bin, CAST(count(*) AS DOUBLE) AS n, avg(actual) AS y_p, avg(pred) AS pred_p, CAST(sum(actual) AS DOUBLE) AS obs,
       sum(pred) AS expct
FROM (SELECT model, actual, pred, CAST(floor((row_number() OVER (PARTITION BY model ORDER BY pred, id) - 1) * {n_bin}
             / count(*) OVER (PARTITION BY model)) + 1 AS INTEGER) AS bin FROM o_models WHERE pred IS NOT NULL) b
GROUP BY model, bin"""


@register("calibration_models", 8, "A20 C20 (calibration of several models)", compose(
    f"SELECT model, bin, CAST(t AS BIGINT) AS n, round(y_p, 9) AS y_p, round(pred_p, 9) AS pred_p, meas_val_lb AS \"binCI_lower\", "
    f"meas_val_ub AS \"binCI_upper\" FROM (SELECT *, {_WILSON} FROM (SELECT *, obs AS x, n AS t FROM o_bins) o) q",
    ("o_models", _MODELS), ("o_bins", _bins(20))))
def calibration_models(spark, sf_dir):
    b = reports.calibration(model_scores(Fixtures(spark, sf_dir)))
    return b.select("model", "bin", "n", *[_r(c) for c in ("y_p", "pred_p", "binCI_lower", "binCI_upper")])


# 15 bins leave an odd number of degrees of freedom.
_TEST = """
SELECT model, 'hosmer_lemeshow' AS test, round(x, 9) AS statistics, k AS dof,
       CASE WHEN x / 2 > 600 + 2 * k THEN 0 ELSE round(1 - list_sum([exp(-x / 2 + (k / 2 + j) * ln(x / 2) - lgamma(k / 2 + j + 1)) for j in range(0, 3000)]), 9) END AS pval
FROM (SELECT model, sum(pow(obs - expct, 2) / (expct * (1 - expct / n))) AS x, count(*) - 2 AS k FROM o_bins GROUP BY model) t"""


@register("calibration_test_models", 8, "A20 C20 (goodness of fit of several models, odd degrees of freedom)",
          compose(_TEST, ("o_models", _MODELS), ("o_bins", _bins(15))))
def calibration_test_models(spark, sf_dir):
    t = reports.calibration_tests(reports.calibration(model_scores(Fixtures(spark, sf_dir)), n_bin=15))
    return t.select("model", "test", _r("statistics"), F.col("dof").cast("bigint"), _r("pval"))


@register("stratified_band_models", 8, "A19 C20 (stratified bootstrap of several models)")
def stratified_band_models(spark, sf_dir):
    b = reports.stratified_band(model_scores(Fixtures(spark, sf_dir)))
    return b.select("model", "x", _r("sens_lb"), _r("sens_m"), _r("sens_ub"))
