"""Steps 4-6 of the build plan: attributes, analytic base, profiles, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attributes, features, profile
from ..operators.ranks import numbered_keys
from ..sources.tables import Fixtures
from . import oracle_attrs  # noqa: F401  (registers oracle CTEs)
from .oracle import compose
from .oracle_attrs import encode_sql
from .pipeline import AREA_SELECTION, BASE_CATEGORICAL, BASE_COLUMNS, BASE_NUMERIC, PERSON_SELECTION, Pipeline
from .registry import register


def _pipe(spark, sf_dir) -> Pipeline:
    return Pipeline(Fixtures(spark, sf_dir))


def _r(c, digits: int = 9):
    return F.round(F.col(c), digits).alias(c)


# -- step 4 -------------------------------------------------------------------

@register("attach_area_attributes", 4, "C12 R5 J12 J20 P24",
          compose("SELECT ctx_id, geocode, var, val, type, src FROM o_area_long"))
def attach_area_attributes(spark, sf_dir):
    return _pipe(spark, sf_dir).area_long


@register("attach_person_attributes", 4, "C12 R5 J20 P8",
          compose("SELECT patid, var, val, type, src FROM o_person_long"))
def attach_person_attributes(spark, sf_dir):
    return _pipe(spark, sf_dir).person_long


@register("encode_long", 4, "C13 R6", compose("SELECT * FROM o_area_num"))
def encode_long(spark, sf_dir):
    return _pipe(spark, sf_dir).area_num


@register("encode_long_faithful", 4, "C13 R6 H5 (scale-0 cast, zeros dropped)",
          compose("SELECT * FROM o_area_num_f", ("o_area_num_f", encode_sql("o_area_long", "ctx_id, geocode", True))))
def encode_long_faithful(spark, sf_dir):
    return attributes.encode_long(_pipe(spark, sf_dir).area_long, id="ctx_id", keys=["geocode"], faithful=True)


@register("flag_attributes", 4, "C14 J4 A16", compose("SELECT * FROM o_flags"))
def flag_attributes(spark, sf_dir):
    return _pipe(spark, sf_dir).flags


_CLIN_SQL = """
SELECT user_id AS patid, CAST(ts AS DATE) AS start, CAST(NULL AS DATE) AS stop,
  CASE WHEN event_type IN ('view', 'click') THEN 'LC' ELSE 'SM' END AS type, event_type AS code,
  CASE WHEN event_type = 'purchase' THEN value END AS num, CASE WHEN event_type = 'purchase' THEN 'usd' END AS unit,
  CASE WHEN event_type = 'signup' THEN ' Y ' WHEN event_type = 'error' THEN 'NI' END AS qual,
  CASE WHEN event_type = 'click' THEN 'clicked' WHEN event_type = 'error' THEN ' ' END AS text,
  CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE upper(event_type) END AS raw_name
FROM events"""

_TERM_SQL = "SELECT DISTINCT event_type AS loinc_num, 'term ' || event_type AS long_common_name FROM events"


def _clinical(spark, fx: Fixtures):
    ev = fx.table("events")
    return ev.select(
        F.col("user_id").alias("patid"), F.col("ts").cast("date").alias("start"),
        F.lit(None).cast("date").alias("stop"),
        F.when(F.col("event_type").isin("view", "click"), "LC").otherwise("SM").alias("type"),
        F.col("event_type").alias("code"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("num"),
        F.when(F.col("event_type") == "purchase", F.lit("usd")).alias("unit"),
        F.when(F.col("event_type") == "signup", F.lit(" Y ")).when(F.col("event_type") == "error", F.lit("NI"))
        .alias("qual"),
        F.when(F.col("event_type") == "click", F.lit("clicked")).when(F.col("event_type") == "error", F.lit(" "))
        .alias("text"),
        F.when(F.col("event_type").isin("view", "click"), F.lit(None).cast("string"))
        .otherwise(F.upper("event_type")).alias("raw_name"))


_OBS_ORACLE = """
SELECT DISTINCT * FROM (
  SELECT patid, measure_date AS obs_date, 'UD' AS obs_code_type, 'SYSTOLIC' AS obs_code,
         CAST(round(systolic) AS DOUBLE) AS obs_num, 'mm[Hg]' AS obs_unit, 'NI' AS obs_qual, 'SYSTOLIC' AS obs_name
  FROM fx_vital WHERE systolic IS NOT NULL
  UNION ALL
  SELECT patid, measure_date, 'UD', 'DIASTOLIC', CAST(round(diastolic) AS DOUBLE), 'mm[Hg]', 'NI', 'DIASTOLIC'
  FROM fx_vital WHERE diastolic IS NOT NULL
  UNION ALL
  SELECT patid, measure_date, 'UD', 'SMOKING', CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), smoking, 'SMOKING'
  FROM fx_vital WHERE smoking IS NOT NULL AND trim(smoking) <> '' AND trim(smoking) NOT IN ('NI', 'UN', 'OT')
  UNION ALL
  SELECT b.patid, COALESCE(b.start, b.stop), b.type, b.code, CAST(b.num AS DOUBLE), b.unit,
         COALESCE(trim(b.qual), trim(b.text)), COALESCE(b.raw_name, c.long_common_name)
  FROM o_clin b LEFT JOIN o_term c ON b.code = c.loinc_num AND b.type = 'LC'
  WHERE b.num IS NOT NULL OR (COALESCE(trim(b.qual), trim(b.text)) IS NOT NULL
        AND COALESCE(trim(b.qual), trim(b.text)) <> ''
        AND COALESCE(trim(b.qual), trim(b.text)) NOT IN ('UN', 'NI', 'OT'))
) u WHERE EXISTS (SELECT 1 FROM fx_person p WHERE p.patid = u.patid)"""


@register("observations_long", 4, "C11 R3 R4 J19 U3 P10",
          compose(_OBS_ORACLE, ("o_clin", _CLIN_SQL), ("o_term", _TERM_SQL)))
def observations_long(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    term = fx.table("events").select(F.col("event_type").alias("loinc_num"),
                                     F.concat(F.lit("term "), F.col("event_type")).alias("long_common_name")).distinct()
    return attributes.observations_long(
        fx.fx_vital, {"systolic": "mm[Hg]", "diastolic": "mm[Hg]"}, ["smoking"],
        clinical=_clinical(spark, fx), terminology=term, people=fx.fx_person)


_DICT_ORACLE = """
SELECT DISTINCT upper(code_grp) AS var, 'comorbidity group ' || code_grp AS var_label, 'CCI' AS var_domain
FROM fx_prefix_dict
UNION
SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), lower(n_name), 'DRG' FROM nation
UNION
SELECT * FROM (VALUES ('AREA_CLASS', 'AREA_CLASS', 'AREA'), ('AREA_RANK', 'AREA_RANK', 'AREA'),
  ('AREA_SHARE', 'AREA_SHARE', 'AREA'), ('H_SEGMENT', 'H_SEGMENT', 'PERSON'), ('H_OWN_RENT', 'H_OWN_RENT', 'PERSON'),
  ('H_FLAG', 'H_FLAG', 'PERSON'), ('H_LENGTH', 'H_LENGTH', 'PERSON'), ('H_VALUE', 'H_VALUE', 'PERSON')) v(a, b, c)"""


def dictionary(spark, fx: Fixtures):
    cci = fx.fx_prefix_dict.select(F.upper("code_grp").alias("var"),
                                   F.concat(F.lit("comorbidity group "), F.col("code_grp")).alias("var_label"),
                                   F.lit("CCI").alias("var_domain"))
    drg = fx.table("nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("var"),
                                    F.lower("n_name").alias("var_label"), F.lit("DRG").alias("var_domain"))
    area = attributes.catalog_dictionary(spark, {"AREA": fx.fx_area.select(*[c.lower() for c in AREA_SELECTION])},
                                         domain="AREA")
    sel = {k: v for k, v in PERSON_SELECTION.items() if not k.endswith("_PREC")}
    person = attributes.catalog_dictionary(spark, {"PERSON": fx.fx_person_attr.select(*[c.lower() for c in sel])},
                                           domain="PERSON")
    return attributes.data_dictionary([cci, drg, area, person])


@register("data_dictionary", 4, "C18 S4 S5 S6 J20 A10 U1", compose(_DICT_ORACLE))
def data_dictionary(spark, sf_dir):
    return dictionary(spark, Fixtures(spark, sf_dir))


_CATALOG_ORACLE = "\nUNION\n".join(
    [f"SELECT DISTINCT 'AREA' AS var_domain, '{c.upper()}' AS var, '{c.upper()}' AS var_label FROM fx_area "
     f"WHERE {c} IS NOT NULL" for c in ("area_class", "area_rank", "area_share")]
    + [f"SELECT DISTINCT 'PERSON', '{c.upper()}', '{c.upper()}' FROM fx_person_attr WHERE {c} IS NOT NULL"
       for c in ("h_segment", "h_own_rent", "h_flag", "h_length", "h_value", "h_own_prec")])


@register("catalog_dictionary", 4, "C18 S6 J20 A10 (variables present in the attribute tables)",
          compose(_CATALOG_ORACLE))
def catalog_dictionary(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return attributes.catalog_from_data({"AREA": (fx.fx_area, ["geocode"]), "PERSON": (fx.fx_person_attr, ["ctx_id"])})


# -- step 5 -------------------------------------------------------------------

@register("analytic_base", 5, "C15 W9 A4 A5 P14-P18", compose(f"SELECT {', '.join(BASE_COLUMNS)} FROM o_base"))
def analytic_base(spark, sf_dir):
    return _pipe(spark, sf_dir).base


@register("history_score", 5, "C10 J11 J14 A4", compose("SELECT * FROM o_hist"))
def history_score(spark, sf_dir):
    return _pipe(spark, sf_dir).history


@register("freq_regroup", 5, "A5", compose("SELECT drg, freq, drg_regrp FROM o_freq"))
def freq_regroup(spark, sf_dir):
    return _pipe(spark, sf_dir).drg_groups


@register("recode_two_source", 5, "P16 P17", compose("SELECT patid, sex, race, hispanic FROM o_demo"))
def recode_two_source(spark, sf_dir):
    from ..functions.columns import recode_any, recode_first
    fx = Fixtures(spark, sf_dir)
    b = fx.fx_person.alias("b")
    d = fx.fx_person_alt.select("patid", F.col("sex").alias("d_sex"), F.col("race").alias("d_race"),
                                F.col("hispanic").alias("d_hisp"))
    j = b.join(d, "patid", "left")
    return j.select("patid", F.coalesce("sex", "d_sex").alias("sex"),
                    recode_first(["d_race", "race"], features.RACE_MAP).alias("race"),
                    recode_any(["d_hisp", "hispanic"]).alias("hispanic"))


@register("surrogate_id", 5, "W9 W13",
          compose("SELECT DENSE_RANK() OVER (ORDER BY patid, encounterid) AS rowid, patid, encounterid "
                  "FROM (SELECT DISTINCT patid, encounterid FROM o_label) t"))
def surrogate_id(spark, sf_dir):
    return numbered_keys(_pipe(spark, sf_dir).eligible, ["patid", "encounterid"], "rowid")


_SUBGRP_ORACLE = """
SELECT a.patid, a.encounterid, a.rowid, COALESCE(b.ind, 0) AS dual_lis,
  CASE WHEN a.race <> 'WH' THEN 1 ELSE 0 END AS non_white, COALESCE(a.obes, 0) AS obes,
  CASE WHEN a.age_at_enc >= 65 THEN 1 ELSE 0 END AS age_65up
FROM o_base a LEFT JOIN (SELECT DISTINCT patid, 1 AS ind FROM o_person_num WHERE var = 'DUAL_LIS_ELIG') b
  ON a.patid = b.patid"""


@register("subgroup_flags", 5, "M12 J2 P18", compose(_SUBGRP_ORACLE))
def subgroup_flags(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return features.subgroup_flags(p.base, p.person_num)


# -- step 6 -------------------------------------------------------------------

@register("variable_profile", 6, "C16 A6 A7 J15 J17", compose("SELECT * FROM o_s_prof"))
def variable_profile(spark, sf_dir):
    return _pipe(spark, sf_dir).profile("area")


@register("variable_profile_person", 6, "C16 A6 A7 (person attributes)", compose("SELECT * FROM o_i_prof"))
def variable_profile_person(spark, sf_dir):
    return _pipe(spark, sf_dir).profile("person")


@register("feature_long", 6, "C17 M10 M11 R7 R1 R2", compose("SELECT * FROM o_s_long"))
def feature_long(spark, sf_dir):
    return _pipe(spark, sf_dir).feature_long("area")


@register("feature_long_person", 6, "C17 M10 M11 R7 (person attributes)", compose("SELECT * FROM o_i_long"))
def feature_long_person(spark, sf_dir):
    return _pipe(spark, sf_dir).feature_long("person")


@register("feature_long_all", 6, "R7 (union of both feature sets)",
          compose("SELECT * FROM o_s_long UNION SELECT * FROM o_i_long"))
def feature_long_all(spark, sf_dir):
    return _pipe(spark, sf_dir).feature_long("area", "person")


@register("feature_long_imputed", 6, "M11 (imputation value for every row without a kept numeric variable)", compose(f"""
SELECT * FROM o_i_long
UNION
SELECT b.rowid, b.patid, b.encounterid, b.label, p.var, p.imp_val FROM o_base b, o_i_prof p
WHERE p.rt >= 0.01 AND p.imp_val IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM o_i_long f WHERE f.rowid = b.rowid AND f.var = p.var)"""))
def feature_long_imputed(spark, sf_dir):
    return _pipe(spark, sf_dir).feature_long("person", impute=True)


def _entropy_sql(src: str, id: str, sparse: bool) -> str:
    extra = " + 1" if sparse else ""
    ee3 = (", round(CASE WHEN SUM(p2 * ln(1 / p2)) = 0 THEN SUM(p1 * ln(1 / p1)) ELSE SUM(p2 * ln(1 / p2)) END, 9)"
           " AS ee3") if sparse else ""
    return f"""
SELECT var, round(ln(COUNT(*){extra}), 9) AS pe, round(SUM(p1 * ln(1 / p1)), 9) AS ee1,
       round(SUM(p2 * ln(1 / p2)), 9) AS ee2{ee3}
FROM (SELECT v.var, v.vn / n.N AS p1, v.vn / w.varn AS p2
      FROM (SELECT var, val, COUNT(DISTINCT {id}) AS vn FROM {src} GROUP BY var, val) v
      JOIN (SELECT var, COUNT(DISTINCT {id}) AS varn FROM {src} GROUP BY var) w ON v.var = w.var
      CROSS JOIN (SELECT COUNT(DISTINCT {id}) AS N FROM {src}) n) t
GROUP BY var"""


@register("entropy_profile", 6, "C19 A8 W10 A21", compose(_entropy_sql("o_area_long", "ctx_id", False)))
def entropy_profile(spark, sf_dir):
    e = profile.entropy_profile(_pipe(spark, sf_dir).area_long, id="ctx_id")
    return e.select("var", _r("pe"), _r("ee1"), _r("ee2"))


@register("entropy_profile_sparse", 6, "C19 A9", compose(_entropy_sql("o_person_long", "patid", True)))
def entropy_profile_sparse(spark, sf_dir):
    e = profile.entropy_profile(_pipe(spark, sf_dir).person_long, id="patid", absent_is_level=True)
    return e.select("var", _r("pe"), _r("ee1"), _r("ee2"), _r("ee3"))


_TYPED = "\nUNION ALL\n".join(
    [f"SELECT rowid, label, '{c.upper()}' AS var, CAST({c} AS VARCHAR) AS val, 'C' AS type FROM o_base "
     f"WHERE {c} IS NOT NULL" for c in BASE_CATEGORICAL]
    + [f"SELECT rowid, label, '{c.upper()}' AS var, CAST({c} AS VARCHAR) AS val, 'N' AS type FROM o_base "
       f"WHERE {c} IS NOT NULL" for c in BASE_NUMERIC])


def _summary_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    return f"""
SELECT {g}var, CAST(NULL AS VARCHAR) AS level, COUNT(x) AS n, CAST(NULL AS DOUBLE) AS pct,
  round(AVG(x), 9) AS mean, round(stddev_samp(x), 9) AS sd, round(quantile_cont(x, 0.5), 9) AS median,
  round(quantile_cont(x, 0.25), 9) AS q1, round(quantile_cont(x, 0.75), 9) AS q3
FROM (SELECT *, CAST(val AS DOUBLE) AS x FROM o_typed WHERE type = 'N') t GROUP BY {g}var
UNION ALL
SELECT {g}var, level, n, round(n / SUM(n) OVER (PARTITION BY {g}var), 9) AS pct, NULL, NULL, NULL, NULL, NULL
FROM (SELECT {g}var, val AS level, COUNT(*) AS n FROM o_typed WHERE type = 'C' GROUP BY {g}var, val) c"""


def _typed(p: Pipeline):
    return features.typed_long(p.base, ["rowid", "label"], BASE_CATEGORICAL, BASE_NUMERIC)


def _round_summary(df):
    return df.select(*[c for c in df.columns if c not in ("pct", "mean", "sd", "median", "q1", "q3")],
                     *[_r(c) for c in ("pct", "mean", "sd", "median", "q1", "q3")])


@register("univariate_summary", 6, "A15", compose(_summary_sql(None), ("o_typed", _TYPED)))
def univariate_summary(spark, sf_dir):
    return _round_summary(profile.univariate_summary(_typed(_pipe(spark, sf_dir))))


@register("univariate_by_group", 6, "A15 (by label)", compose(_summary_sql("label"), ("o_typed", _TYPED)))
def univariate_by_group(spark, sf_dir):
    return _round_summary(profile.univariate_summary(_typed(_pipe(spark, sf_dir)), by="label"))


_PIVOT_VARS = [c for c in PERSON_SELECTION if not c.endswith("_PREC")]


@register("pivot_fill", 6, "R8 W11", compose(
    "SELECT patid, " + ", ".join(f"COALESCE(MIN(CASE WHEN var = '{v}' THEN val END), 'NI') AS {v}" for v in _PIVOT_VARS)
    + f" FROM o_person_long WHERE var IN ({', '.join(repr(v) for v in _PIVOT_VARS)}) GROUP BY patid"))
def pivot_fill(spark, sf_dir):
    return profile.pivot_fill(_pipe(spark, sf_dir).person_long, "patid", "var", "val", _PIVOT_VARS)
