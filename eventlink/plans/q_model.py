"""Steps 7, 8 and 10: splits, encoder, model inputs, score evaluation,
importance/effect summaries, merged-source relinking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, events, features, model
from ..operators.ranks import attach_scalars
from ..sources.tables import Fixtures
from .oracle import compose
from .pipeline import Pipeline
from .q_features import _DICT_ORACLE, _entropy_sql, dictionary
from .registry import register


def _pipe(spark, sf_dir) -> Pipeline:
    return Pipeline(Fixtures(spark, sf_dir))


def _u(seed_and_name: str, key: str) -> str:
    return (f"(CAST(('0x' || substr(md5('{seed_and_name}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) "
            f"/ CAST(4294967296 AS DOUBLE))")


def _split_sql(key: str) -> str:
    cols = [f"CASE WHEN {_u('split:' + n, key)} >= {p} THEN 1 ELSE 0 END AS {n}"
            for n, p in features.HOLDOUTS.items()]
    cols += [f"CAST(floor({_u('split:' + n, key)} * {k}) + 1 AS INTEGER) AS {n}" for n, k in features.FOLDS.items()]
    return f"SELECT rowid, patid, {', '.join(cols)} FROM o_base"


def _r(c, digits: int = 9):
    return F.round(F.col(c), digits).alias(c)


# -- step 7 -------------------------------------------------------------------

@register("split_grouped", 7, "M1 (group-aware hold-outs and folds)", compose(_split_sql("patid")))
def split_grouped(spark, sf_dir):
    return features.hash_split(_pipe(spark, sf_dir).base, "patid", keep=["rowid", "patid"])


@register("split_rows", 7, "M2 (row-level hold-outs and folds)", compose(_split_sql("rowid")))
def split_rows(spark, sf_dir):
    return features.hash_split(_pipe(spark, sf_dir).base, "rowid", keep=["rowid", "patid"])


def _leak_sql() -> str:
    arms = []
    for st, key in (("grouped", "patid"), ("rows", "rowid")):
        for h in features.HOLDOUTS:
            arms.append(
                f"SELECT '{st}' AS split_type, '{h}' AS holdout, COUNT(*) AS groups, "
                f"CAST(SUM(CASE WHEN sides > 1 THEN 1 ELSE 0 END) AS BIGINT) AS groups_both_sides FROM ("
                f"SELECT patid, COUNT(DISTINCT {h}) AS sides FROM o_split_{st} GROUP BY patid) t")
    return "\nUNION ALL\n".join(arms)


@register("leakage_check", 7, "M3", compose(_leak_sql(), ("o_split_grouped", _split_sql("patid")),
                                            ("o_split_rows", _split_sql("rowid"))))
def leakage_check(spark, sf_dir):
    base = _pipe(spark, sf_dir).base
    outs = []
    for st, key in (("grouped", "patid"), ("rows", "rowid")):
        s = features.hash_split(base, key, keep=["rowid", "patid"], folds={})
        long = s.unpivot(["rowid", "patid"], list(features.HOLDOUTS), "holdout", "side")
        per = long.groupBy("holdout", "patid").agg(F.countDistinct("side").alias("_sides"))
        outs.append(per.groupBy("holdout").agg(
            F.count(F.lit(1)).alias("groups"),
            F.sum(F.when(F.col("_sides") > 1, 1).otherwise(0)).cast("bigint").alias("groups_both_sides"))
            .withColumn("split_type", F.lit(st)))
    return outs[0].unionByName(outs[1])


# Every name with its keys in turn; the first key with a label decides.
_ENC_KEYS = """
SELECT var, 1 AS turn, regexp_replace(var, '^(DRG_REGRP_DRG_)+', '') AS key FROM o_names
UNION ALL
SELECT var, 2, if(regexp_matches(var, '^(P_|H_)'), regexp_replace(var, '_[^_]*$', ''), var) FROM o_names"""

_ENC_ORACLE = """
SELECT t.var, t.hit.var_label AS var_label, t.hit.var_domain AS var_domain, coalesce(t.hit.var_label, t.var) AS var_lbl,
       CASE WHEN t.hit.var_domain IS NULL THEN 'base' ELSE coalesce(
         (SELECT arg_min(r.kind, r.n) FROM (VALUES (1, '^PERSON', 'i_sdh'), (2, 'DRG', 'base')) r(n, pattern, kind)
          WHERE regexp_matches(t.hit.var_domain, r.pattern)), 's_sdh') END AS var_domain_type,
       'V' || (SELECT count(*) FROM o_names s WHERE s.var <= t.var) AS var3
FROM (SELECT k.var, arg_min({'var_label': d.var_label, 'var_domain': d.var_domain}, k.turn)
             FILTER (WHERE d.var_label IS NOT NULL) AS hit
      FROM o_enc_keys k LEFT JOIN o_dict d ON d.var = k.key GROUP BY k.var) t"""

_ENC_CTES = (("o_feat_all", "SELECT * FROM o_s_long UNION SELECT * FROM o_i_long"),
             ("o_names", "SELECT DISTINCT var FROM o_feat_all"),
             ("o_dict", _DICT_ORACLE), ("o_enc_keys", _ENC_KEYS), ("o_enc", _ENC_ORACLE))

DOMAIN_RULES = [("^PERSON", "i_sdh"), ("DRG", "base")]


def _feat_all(p: Pipeline):
    return p.features_all


def _encoder(spark, p: Pipeline, feats=None):
    feats = feats if feats is not None else _feat_all(p)
    return features.variable_encoder(feats, dictionary(spark, p.fx), domain_rules=DOMAIN_RULES)


@register("variable_encoder", 7, "M4 J22 W13", compose("SELECT * FROM o_enc", *_ENC_CTES))
def variable_encoder(spark, sf_dir):
    return _encoder(spark, _pipe(spark, sf_dir))


@register("shadow_feature", 7, "M5", compose(
    f"SELECT DISTINCT rowid, 'shadow' AS var, CASE WHEN {_u('shadow', 'rowid')} < 0.5 THEN CAST(0 AS DOUBLE) "
    f"ELSE CAST(1 AS DOUBLE) END AS val FROM o_base"))
def shadow_feature(spark, sf_dir):
    return features.shadow_feature(_pipe(spark, sf_dir).base)


@register("sparse_rows", 7, "R9 M6 J21", compose("""
SELECT f.rowid, COUNT(*) AS nnz,
       string_agg(CAST(CAST(substr(e.var3, 2) AS INTEGER) - 1 AS VARCHAR), ',' ORDER BY CAST(substr(e.var3, 2) AS INTEGER), f.val) AS indices,
       round(SUM(f.val), 6) AS value_sum
FROM o_feat_all f JOIN o_enc e ON f.var = e.var GROUP BY f.rowid""", *_ENC_CTES))
def sparse_rows(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    feats = _feat_all(p)
    sp = features.sparse_rows(feats, _encoder(spark, p, feats))
    return sp.select("rowid", F.size("indices").cast("bigint").alias("nnz"),
                     F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
                     F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("value_sum"))


@register("shared_features", 7, "U6 (features present in both hold-out sides)", compose("""
SELECT DISTINCT a.var FROM o_feat_all a JOIN o_split_g s ON a.rowid = s.rowid AND s.hdout82 = 0
INTERSECT
SELECT DISTINCT a.var FROM o_feat_all a JOIN o_split_g s ON a.rowid = s.rowid AND s.hdout82 = 1""",
    ("o_feat_all", "SELECT * FROM o_s_long UNION SELECT * FROM o_i_long"), ("o_split_g", _split_sql("patid"))))
def shared_features(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    feats = _feat_all(p)
    s = features.hash_split(p.base, "patid", keep=["rowid"], folds={})
    tr = feats.join(s.filter(F.col("hdout82") == 0).select("rowid"), "rowid", "left_semi")
    ts = feats.join(s.filter(F.col("hdout82") == 1).select("rowid"), "rowid", "left_semi")
    return features.shared_features(tr, ts)


# -- step 8 -------------------------------------------------------------------

_SC = """
SELECT pred AS score, CAST(SUM(CASE WHEN actual = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
       CAST(SUM(CASE WHEN actual = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
FROM fx_scores WHERE pred IS NOT NULL GROUP BY pred"""

_CUT = """
SELECT score AS cutoff, tp, fp, P - tp AS fn, N - fp AS tn, round(tp / P, 9) AS rec_sens, round((N - fp) / N, 9) AS spec,
       round(tp / (tp + fp), 9) AS prec,
       round(CASE WHEN (N - fp) + (P - tp) > 0 THEN (N - fp) / ((N - fp) + (P - tp)) END, 9) AS npv
FROM (SELECT score, CAST(SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
             CAST(SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
             CAST(SUM(pos) OVER () AS BIGINT) AS P, CAST(SUM(neg) OVER () AS BIGINT) AS N FROM o_sc) c"""


def _round_all(df, keep=()):
    return df.select(*[F.col(c) if c in keep or dict(df.dtypes)[c] != "double" else _r(c) for c in df.columns])


@register("cutoff_metrics", 8, "A17 C20", compose("SELECT * FROM o_cut", ("o_sc", _SC), ("o_cut", _CUT)))
def cutoff_metrics(spark, sf_dir):
    return _round_all(evaluate.cutoff_metrics(Fixtures(spark, sf_dir).fx_scores), keep=("cutoff",))


@register("pr_curve", 8, "A17 J23 (precision with recall at each cutoff)",
          compose("SELECT cutoff, rec_sens AS recall, prec AS precision FROM o_cut", ("o_sc", _SC), ("o_cut", _CUT)))
def pr_curve(spark, sf_dir):
    return _round_all(evaluate.pr_curve(Fixtures(spark, sf_dir).fx_scores), keep=("cutoff",))


_ROC = """
SELECT n_pos, n_neg, (SELECT COUNT(*) FROM fx_scores WHERE pred IS NULL) AS n_unscored, round(s10 / n_pos, 9) AS auc,
  round(greatest(s10 / n_pos - 1.959963984540054 * sqrt(greatest(
    ((q10 - n_pos * (s10 / n_pos) * (s10 / n_pos)) / (n_pos - 1)) / n_pos
    + ((q01 - n_neg * (s10 / n_pos) * (s10 / n_pos)) / (n_neg - 1)) / n_neg, 0.0)), 0.0), 9) AS auc_lb,
  round(least(s10 / n_pos + 1.959963984540054 * sqrt(greatest(
    ((q10 - n_pos * (s10 / n_pos) * (s10 / n_pos)) / (n_pos - 1)) / n_pos
    + ((q01 - n_neg * (s10 / n_pos) * (s10 / n_pos)) / (n_neg - 1)) / n_neg, 0.0)), 1.0), 9) AS auc_ub,
  round(pr_auc, 9) AS pr_auc
FROM (
  SELECT MAX(P) AS n_pos, MAX(N) AS n_neg, SUM(pos * v10) AS s10, SUM(pos * v10 * v10) AS q10,
         SUM(neg * v01 * v01) AS q01, SUM(pos / P * tp_ge / (tp_ge + fp_ge)) AS pr_auc
  FROM (
    SELECT *, (neg_cum - neg + neg * 0.5) / N AS v10, (P - pos_cum + pos * 0.5) / P AS v01,
           P - pos_cum + pos AS tp_ge, N - neg_cum + neg AS fp_ge
    FROM (SELECT score, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
                 CAST(SUM(pos) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS pos_cum,
                 CAST(SUM(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS neg_cum,
                 CAST(SUM(pos) OVER () AS DOUBLE) AS P, CAST(SUM(neg) OVER () AS DOUBLE) AS N FROM o_sc) c) v) a"""


@register("roc_auc", 8, "A18 C20 (AUC, DeLong interval, average precision)", compose(_ROC, ("o_sc", _SC)))
def roc_auc(spark, sf_dir):
    r = evaluate.roc_auc(Fixtures(spark, sf_dir).fx_scores)
    return r.select(F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint"), "n_unscored", _r("auc"), _r("auc_lb"),
                    _r("auc_ub"), _r("pr_auc"))


_CAL = """
SELECT bin, COUNT(*) AS n, round(AVG(actual), 9) AS y_p, round(AVG(pred), 9) AS pred_p,
  round(greatest(AVG(actual) - 1.959963984540054 * sqrt(AVG(actual) * (1 - AVG(actual)) / COUNT(*)), 0.0), 9) AS binCI_lower,
  round(least(AVG(actual) + 1.959963984540054 * sqrt(AVG(actual) * (1 - AVG(actual)) / COUNT(*)), 1.0), 9) AS binCI_upper
FROM (SELECT CAST(floor((ROW_NUMBER() OVER (ORDER BY pred, id) - 1) * 20 / COUNT(*) OVER ()) + 1 AS INTEGER) AS bin,
             actual, pred FROM fx_scores) b
GROUP BY bin"""


@register("calibration_bins", 8, "A20 (calibration bins)", compose(_CAL))
def calibration_bins(spark, sf_dir):
    b = evaluate.calibration_bins(Fixtures(spark, sf_dir).fx_scores)
    return b.select("bin", "n", _r("y_p"), _r("pred_p"), _r("binCI_lower"), _r("binCI_upper"))


_CAL_TEST = """
SELECT 'hosmer_lemeshow' AS test, round(x, 9) AS statistics, k AS dof,
       round(exp(-x / 2) * list_sum([pow(x / 2, j) / gamma(j + 1) for j in range(0, CAST(k / 2 AS INTEGER))]), 9) AS pval
FROM (SELECT SUM(pow(obs - expct, 2) / (expct * (1 - expct / n))) AS x, COUNT(*) - 2 AS k
      FROM (SELECT bin, COUNT(*) AS n, CAST(SUM(actual) AS DOUBLE) AS obs, SUM(pred) AS expct
            FROM (SELECT CAST(floor((ROW_NUMBER() OVER (ORDER BY pred, id) - 1) * 20 / COUNT(*) OVER ()) + 1 AS INTEGER) AS bin,
                         actual, pred FROM fx_scores WHERE pred IS NOT NULL) b GROUP BY bin) g) t"""


@register("calibration_test", 8, "A20 (Hosmer-Lemeshow test)", compose(_CAL_TEST))
def calibration_test(spark, sf_dir):
    t = evaluate.calibration_test(evaluate.calibration_bins(Fixtures(spark, sf_dir).fx_scores))
    return t.select("test", _r("statistics"), F.col("dof").cast("bigint"), _r("pval"))


# The draws follow from md5, so the band is SQL too: the least k whose Poisson
# distribution function reaches the uniform, for pieces of 64 at most.
_BAND = """
WITH cdf AS (SELECT m, k, sum(exp(-m + k * ln(m) - lgamma(k + 1))) OVER (PARTITION BY m ORDER BY k) AS c
             FROM (SELECT m, unnest(range(0, 200)) AS k FROM range(1, 65) t(m))),
placed AS (SELECT row_number() OVER (ORDER BY score DESC) AS place, pos, neg FROM o_sc),
cell AS (SELECT place, side, c, unnest(range(0, (c - 1) // 64 + 1)) AS piece
         FROM (SELECT place, 'p' AS side, pos AS c FROM placed UNION ALL SELECT place, 'n', neg FROM placed) WHERE c > 0),
draw AS (SELECT rep, place, side, least(64, c - 64 * piece) AS m,
                CAST('0x' || substr(md5('boot:' || side || ':' || rep || ':' || place || ':' || piece), 1, 8) AS BIGINT)
                / CAST(4294967296 AS DOUBLE) AS u
         FROM cell, range(1, 501) r(rep)),
w AS (SELECT rep, place, sum(if(side = 'p', k, 0)) AS pos, sum(if(side = 'n', k, 0)) AS neg
      FROM (SELECT d.rep, d.place, d.side, cdf.k FROM draw d ASOF JOIN cdf ON d.m = cdf.m AND cdf.c >= d.u) GROUP BY ALL),
roc AS (SELECT rep, sum(pos) OVER o / sum(pos) OVER a AS sens, 1 - sum(neg) OVER o / sum(neg) OVER a AS spec
        FROM w WINDOW o AS (PARTITION BY rep ORDER BY place), a AS (PARTITION BY rep)),
best AS (SELECT rep, g, coalesce(max(sens), 0) AS sens
         FROM (SELECT rep, g FROM range(1, 501) r(rep), range(0, 25) t(g))
              LEFT JOIN (SELECT rep AS rp, floor(spec * 24 + 1e-9) AS reach, max(sens) AS sens FROM roc GROUP BY ALL)
              ON rp = rep AND reach >= g GROUP BY ALL)
SELECT g / 24 AS x, round(quantile_cont(sens, 0.025), 9) AS sens_lb, round(quantile_cont(sens, 0.5), 9) AS sens_m,
       round(quantile_cont(sens, 0.975), 9) AS sens_ub
FROM best GROUP BY g"""


@register("bootstrap_band", 8, "A19 (Poisson bootstrap on score-level counts)",
          compose(_BAND.replace("WITH cdf", "SELECT * FROM (WITH cdf", 1) + ") band", ("o_sc", _SC)))
def bootstrap_band(spark, sf_dir):
    b = evaluate.bootstrap_band(Fixtures(spark, sf_dir).fx_scores)
    return b.select("x", _r("sens_lb"), _r("sens_m"), _r("sens_ub"))


def _importance(spark, p: Pipeline):
    feats = _feat_all(p)
    sh = features.shadow_feature(p.base).join(p.base.select("rowid", "label"), "rowid")
    rows = feats.select("rowid", "var", "label").unionByName(sh.select("rowid", "var", "label")).distinct()
    tot = p.base.agg(F.count(F.lit(1)).alias("_tot_n"), F.sum("label").alias("_tot_s"))
    per = rows.groupBy("var").agg(F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_s"))
    g = attach_scalars(per, tot).select(
        "var", F.round(F.pow(F.col("_s") / F.col("_n") - F.col("_tot_s") / F.col("_tot_n"), 2) * F.col("_n"), 9)
        .alias("gain"))
    g = p._stage(g, "gains")  # one row per variable, read by the ranks and by the shadow's own
    enc = _encoder(spark, p, feats).select("var", "var_lbl", "var_domain_type")
    return evaluate.importance_rank(g, enc, k=15)


_IMP_ORACLE = """
SELECT g.var, g.gain, rank, gain_rescale, CASE WHEN s.srank IS NULL OR rank < s.srank THEN 1 ELSE 0 END AS above_shadow,
       e.var_lbl, e.var_domain_type
FROM (SELECT var, gain, RANK() OVER (ORDER BY gain DESC) + (COUNT(*) OVER (PARTITION BY gain) - 1) / 2.0 AS rank,
             round(gain / MAX(gain) OVER () * 100) AS gain_rescale FROM o_gain) g
LEFT JOIN (SELECT MIN(rank) AS srank FROM (SELECT var, RANK() OVER (ORDER BY gain DESC)
           + (COUNT(*) OVER (PARTITION BY gain) - 1) / 2.0 AS rank FROM o_gain) t WHERE var = 'shadow') s ON TRUE
LEFT JOIN o_enc e ON g.var = e.var
WHERE rank <= 15"""

_GAIN = f"""
SELECT var, round(power(sv / nv - t.tot_s / t.tot_n, 2) * nv, 9) AS gain
FROM (SELECT var, COUNT(*) AS nv, SUM(label) AS sv FROM (
        SELECT DISTINCT rowid, var, label FROM (
          SELECT rowid, var, label FROM o_feat_all
          UNION ALL
          SELECT b.rowid, 'shadow', b.label FROM o_base b)) u GROUP BY var) p
CROSS JOIN (SELECT COUNT(*) AS tot_n, SUM(label) AS tot_s FROM o_base) t"""


@register("importance_rank", 8, "M9 W12 O3 O4 J21", compose(_IMP_ORACLE, *_ENC_CTES, ("o_gain", _GAIN)))
def importance_rank(spark, sf_dir):
    r = _importance(spark, _pipe(spark, sf_dir))
    return r.select("var", "gain", F.col("rank").cast("double"), F.col("gain_rescale").cast("double"),
                    "above_shadow", "var_lbl", "var_domain_type")


# Plausibility bounds per variable of the effect summary (lo, hi).
EFFECT_BOUNDS = {"purchase": (None, 8.0), "view": (1.0, None)}


def effects_from_events(fx: Fixtures):
    ev = fx.table("events").select(F.col("event_type").alias("var"), "value")
    mean = ev.groupBy("var").agg(F.avg("value").alias("_mu"))
    return (ev.join(mean, "var")
            .select("var", F.floor(F.col("value") / 10).cast("double").alias("val"),
                    ((F.col("value") - F.col("_mu")) / 100).alias("effect")))


_EFF = """
SELECT var, val, COUNT(*) AS n, round(exp(quantile_cont(effect, 0.5)), 9) AS eff_m,
       round(exp(quantile_cont(effect, 0.025)), 9) AS eff_lb, round(exp(quantile_cont(effect, 0.975)), 9) AS eff_ub
FROM (SELECT e.event_type AS var, CAST(floor(e.value / 10) AS DOUBLE) AS val, (e.value - m.mu) / 100 AS effect
      FROM events e JOIN (SELECT event_type, AVG(value) AS mu FROM events GROUP BY event_type) m
        ON e.event_type = m.event_type) t
WHERE effect IS NOT NULL AND NOT ((var = 'purchase' AND val > 8.0) OR (var = 'view' AND val < 1.0))
GROUP BY var, val"""


@register("effect_summary", 8, "A12 P22 C21", _EFF)
def effect_summary(spark, sf_dir):
    e = evaluate.effect_summary(effects_from_events(Fixtures(spark, sf_dir)), EFFECT_BOUNDS)
    return e.select("var", "val", F.col("n").cast("bigint"), _r("eff_m"), _r("eff_lb"), _r("eff_ub"))


# -- step 10 ------------------------------------------------------------------

_MERGE = """
SELECT patid, encounterid, src, encounterid_lead, src_lead, n_days_total, running_n,
       ROW_NUMBER() OVER (PARTITION BY patid ORDER BY admit_date, encounterid) AS seq, days_to_next, los
FROM (
  SELECT *, date_diff('day', discharge_date, admit_date_lead) AS days_to_next,
         COALESCE(NULLIF(date_diff('day', admit_date, discharge_date), 0), 1) AS los
  FROM (
    SELECT m.*, LEAD(encounterid) OVER w AS encounterid_lead, LEAD(admit_date) OVER w AS admit_date_lead,
           LEAD(src) OVER w AS src_lead
    FROM (SELECT a.*, t.n_days_total,
                 COUNT(*) OVER (PARTITION BY a.patid ORDER BY a.admit_date, a.encounterid
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_n
          FROM (SELECT *, CASE WHEN encounterid % 2 = 0 THEN 'EHR' ELSE 'CMS' END AS src FROM o_admit) a
          JOIN (SELECT patid, COUNT(DISTINCT admit_date) AS n_days_total FROM o_admit GROUP BY patid) t
            ON a.patid = t.patid) m
    WINDOW w AS (PARTITION BY patid ORDER BY admit_date, encounterid)) l) f
WHERE days_to_next > 0 OR days_to_next IS NULL"""


@register("merge_sources_relink", 10, "C22 U4 P19 W7 W8", compose(_MERGE))
def merge_sources_relink(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    a = p.admit
    srcs = {"EHR": a.filter(F.col("encounterid") % 2 == 0), "CMS": a.filter(F.col("encounterid") % 2 == 1)}
    m = events.merge_sources_relink(srcs, skew_safe=p.skew_safe)
    return m.select("patid", "encounterid", "src", "encounterid_lead", "src_lead", "n_days_total", "running_n",
                    "seq", "days_to_next", "los")


# -- step 9 -------------------------------------------------------------------

# Variables that no model may use.
MODEL_EXCLUDED = ("P_PROMINENCE", "DRG_REGRP_DRG_000", "DRG_REGRP_DRG_OT", "DRG_REGRP_DRG_NI", "IP_CUMCNT_12M",
                  "CCI_CLASS_CCI0", "CCI_CLASS_CCI1", "CCI_CLASS_CCI2", "CCI_CLASS_CCI3")


@register("gbt_feature_sets", 9, "M6 M7 M8 M9 S9 P21 O4 (trained models: scores, and ranked gains)")
def gbt_feature_sets(spark, sf_dir):
    """Rows of both outputs of the four models: ``kind`` score (rowid, actual,
    pred) or gain (var, gain, rank, above_shadow)."""
    p = _pipe(spark, sf_dir)
    split = features.hash_split(p.base, "patid", keep=["rowid"])
    sets = {"base": p.base_long, "sdoh_s": p.feature_long("area"), "sdoh_i": p.feature_long("person"),
            "sdoh_si": p.features_all}
    scores, gains = model.gbt_feature_sets(sets, split, p.base, fold="cv5", exclude=MODEL_EXCLUDED)
    ranked = evaluate.importance_rank(gains, by=["model"])
    nothing = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    scored = scores.select("model", F.lit("score").alias("kind"), "rowid", "actual", "pred",
                           *nothing("string", "var"), *nothing("double", "gain", "rank"), *nothing("int", "above_shadow"))
    return scored.unionByName(ranked.select(
        "model", F.lit("gain").alias("kind"), *nothing("bigint", "rowid"), *nothing("int", "actual"),
        *nothing("double", "pred"), "var", "gain", F.col("rank").cast("double"), F.col("above_shadow").cast("int")))


# -- report tables (A11, A14, J24) --------------------------------------------

@register("collapse_labels", 8, "A11 (labels per group joined by newline)", compose(
    "SELECT var_domain, array_to_string(list_sort(list_distinct(list(var))), chr(10)) AS labels "
    "FROM o_dict GROUP BY var_domain", ("o_dict", _DICT_ORACLE)))
def collapse_labels(spark, sf_dir):
    from ..operators.profile import collapse_labels as collapse
    return collapse(dictionary(spark, Fixtures(spark, sf_dir)), ["var_domain"], "var")


@register("label_counts", 5, "A14 (events and persons per label)", compose(
    "SELECT label, COUNT(DISTINCT encounterid) AS events, COUNT(DISTINCT patid) AS persons FROM o_label GROUP BY label"))
def label_counts(spark, sf_dir):
    return (_pipe(spark, sf_dir).eligible.groupBy("label")
            .agg(F.countDistinct("encounterid").alias("events"), F.countDistinct("patid").alias("persons")))


_OVERVIEW = """
SELECT d.var, d.var_label, d.var_domain, p.type, p.rt, p.crt, p.imp_val, e.pe, e.ee1, e.ee2
FROM o_dict d JOIN o_s_prof p ON d.var = p.var JOIN o_ent e ON d.var = e.var"""


@register("variable_overview", 6, "J24 (selection x coverage x entropy)",
          compose(_OVERVIEW, ("o_dict", _DICT_ORACLE),
                  ("o_ent", _entropy_sql("o_area_long", "ctx_id", False))))
def variable_overview(spark, sf_dir):
    from ..operators import profile as prof
    p = _pipe(spark, sf_dir)
    d = dictionary(spark, p.fx)
    ent = prof.entropy_profile(p.area_long, id="ctx_id").select("var", _r("pe"), _r("ee1"), _r("ee2"))
    return (d.join(p.profile("area"), "var").join(ent, "var")
            .select("var", "var_label", "var_domain", "type", "rt", "crt", "imp_val", "pe", "ee1", "ee2"))
