"""Attributes of the eligible cohort, names with several entries, effects of each
model's top variables (C12-C14, J21, C21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attributes, evaluate, features
from ..sources.tables import Fixtures
from .oracle import compose
from .oracle_attrs import encode_sql
from .pipeline import AREA_TABLES, Pipeline
from .registry import register


def _pipe(spark, sf_dir) -> Pipeline:
    return Pipeline(Fixtures(spark, sf_dir))


_GEO = """
SELECT c.patid, g.block_group FROM fx_crosswalk c JOIN fx_person_geo g ON g.ctx_id = c.ctx_id
WHERE c.patid IN (SELECT patid FROM o_label)"""

_WITH_ACCURACY = ("fx_acs", "fx_mua")

# One literal prefix join for each table and variable.
_AREAS = "\nUNION ALL\n".join(
    f"SELECT p.patid, a.geocode, {'a.geo_accuracy' if view in _WITH_ACCURACY else 'CAST(NULL AS VARCHAR)'} AS geo_accuracy, "
    f"'{name}' AS var, CAST(a.{name.lower()} AS VARCHAR) AS val, '{kind}' AS type, '{schema}' AS src "
    f"FROM o_geo p JOIN {view} a ON starts_with(p.block_group, a.geocode) "
    f"WHERE length(a.geocode) > 9 AND a.{name.lower()} IS NOT NULL"
    for (schema, _), (view, chosen) in AREA_TABLES.items() for name, kind in chosen.items())

_CTES = (("o_geo", _GEO), ("o_areas", _AREAS))


@register("eligible_areas", 4, "C12 R5 J12 J20 (seven area tables, eligible persons)", compose("SELECT * FROM o_areas", *_CTES))
def eligible_areas(spark, sf_dir):
    return _pipe(spark, sf_dir).eligible_areas


@register("eligible_areas_num", 4, "C13 R6 (seven area tables, eligible persons)",
          compose("SELECT * FROM o_areas_num",
                  ("o_areas_num", encode_sql("o_areas", "patid, geocode, geo_accuracy")), *_CTES))
def eligible_areas_num(spark, sf_dir):
    return attributes.encode_long(_pipe(spark, sf_dir).eligible_areas, keys=["geocode", "geo_accuracy"])


@register("eligible_person_num", 4, "C12 C13 C14 J4 A16 (eligible persons)", compose("""
SELECT n.* FROM o_person_num n WHERE EXISTS (SELECT 1 FROM o_label e WHERE e.patid = n.patid)"""))
def eligible_person_num(spark, sf_dir):
    return _pipe(spark, sf_dir).eligible_person_num


@register("exclusion_codes", 7, "J21 (names with several entries, all kept)", compose(
    "SELECT e.list, e.code_kind, e.grp, d.code FROM fx_excl e JOIN fx_dict10 d ON d.grp = e.grp"))
def exclusion_codes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lists = fx.fx_excl.select("list", "code_kind", "grp")
    return features.join_names(lists, fx.fx_dict10, "grp", "many-to-many").select("list", "code_kind", "grp", "code")


_EFFECTS = """
SELECT e.model, e.var, e.domain, e.val, (e.value - m.mu) / 100 AS effect
FROM (SELECT 'm' || CAST(event_id % 2 AS VARCHAR) AS model, event_type || '_' || CAST(user_id % 7 AS VARCHAR) AS var,
             event_type AS domain, CAST(floor(value / 10) AS DOUBLE) AS val, value FROM events) e
JOIN (SELECT 'm' || CAST(event_id % 2 AS VARCHAR) AS model, event_type || '_' || CAST(user_id % 7 AS VARCHAR) AS var,
             AVG(value) AS mu FROM events GROUP BY ALL) m ON e.model = m.model AND e.var = m.var"""

# Importance: the mean size of a variable's effects, one place, so that ranks tie.
_TOP = """
SELECT t.model, t.var, t.val, t.n, t.eff_m, t.eff_lb, t.eff_ub, r.domain AS var_domain_type, CAST(r.rank AS DOUBLE) AS rank,
       CASE WHEN r.rank = floor(r.rank) THEN lpad(CAST(CAST(r.rank AS BIGINT) AS VARCHAR), 3, '0')
            ELSE CAST(r.rank AS VARCHAR) END || '.' || upper(r.var) AS feat_rank
FROM (SELECT model, var, val, COUNT(*) AS n, round(exp(quantile_cont(effect, 0.5)), 9) AS eff_m,
             round(exp(quantile_cont(effect, 0.025)), 9) AS eff_lb, round(exp(quantile_cont(effect, 0.975)), 9) AS eff_ub
      FROM o_effects WHERE NOT (var = 'purchase_1' AND val > 8.0) GROUP BY ALL) t
JOIN (SELECT model, var, domain, CAST(RANK() OVER (PARTITION BY model ORDER BY gain DESC)
             + (COUNT(*) OVER (PARTITION BY model, gain) - 1) / 2.0 AS DOUBLE) AS rank
      FROM (SELECT model, var, domain, round(AVG(abs(effect)), 2) AS gain FROM o_effects GROUP BY ALL) g) r
  ON r.model = t.model AND r.var = t.var
WHERE r.rank <= 20"""


@register("top_effects", 8, "C21 A12 P22 O3 W12 (effects of each model's top 20 variables)",
          compose(_TOP, ("o_effects", _EFFECTS)))
def top_effects(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events")
    named = ev.select(F.concat(F.lit("m"), (F.col("event_id") % 2).cast("string")).alias("model"),
                      F.concat_ws("_", "event_type", (F.col("user_id") % 7).cast("string")).alias("var"),
                      F.col("event_type").alias("domain"), "value")
    mean = named.groupBy("model", "var").agg(F.avg("value").alias("mu"))
    effects = named.join(mean, ["model", "var"]).select(
        "model", "var", "domain", F.floor(F.col("value") / 10).cast("double").alias("val"),
        ((F.col("value") - F.col("mu")) / 100).alias("effect"))
    gains = effects.groupBy("model", "var").agg(F.round(F.avg(F.abs("effect")), 2).alias("gain"))
    labels = named.select("var", F.upper("var").alias("var_lbl"), F.col("domain").alias("var_domain_type")).distinct()
    ranked = evaluate.importance_rank(gains, labels, by=["model"])
    top = evaluate.top_effects(effects, ranked, 20, {"purchase_1": (None, 8.0)})
    return top.select("model", "var", "val", F.col("n").cast("bigint"), *[F.round(c, 9).alias(c) for c in ("eff_m", "eff_lb", "eff_ub")],
                      "var_domain_type", "rank", "feat_rank")
