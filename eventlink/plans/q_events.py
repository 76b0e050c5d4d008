"""Steps 1-3 of the build plan: linkage, cohort, joins, code mapping, labels."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import codes, events
from ..sources.tables import Fixtures
from .oracle import compose
from .pipeline import LABEL_COLUMNS, Pipeline
from .registry import register


def _pipe(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(Fixtures(spark, sf_dir))


_LABEL_SEL = ", ".join(LABEL_COLUMNS)


@register("readmission_label", 1, "C3 C4 C5 C6 C7 C8 W4 W6 P11 P12 J5 J7",
          compose(f"SELECT {_LABEL_SEL} FROM o_label"))
def readmission_label(spark, sf_dir):
    return _pipe(spark, sf_dir).labelled("downgrade").select(*LABEL_COLUMNS)


@register("readmission_label_drop", 1, "C8 J6 (planned follow-up dropped)",
          compose(f"SELECT {_LABEL_SEL} FROM o_label_drop"))
def readmission_label_drop(spark, sf_dir):
    return _pipe(spark, sf_dir).labelled("drop").select(*LABEL_COLUMNS)


_LINK_COLS = ["patid", "encounterid", "admit_date", "discharge_date", "encounterid_lead", "admit_date_lead",
              "enc_type_lead", "drg_lead", "provider_id_lead", "los", "days_to_next", "days_to_censor",
              "days_to_death"]


@register("link_next_event", 1, "C3 W4 P11",
          compose(f"SELECT {', '.join(_LINK_COLS)} FROM o_linked"))
def link_next_event(spark, sf_dir):
    return _pipe(spark, sf_dir).linked_carrying.select(*_LINK_COLS)


@register("lookback_12m", 1, "C4 J13 W6",
          compose("SELECT a.patid, a.encounterid, a.admit_date, lb.n_prior_12m FROM o_admit a "
                  "LEFT JOIN o_lookback lb ON a.patid = lb.patid AND a.encounterid = lb.encounterid"))
def lookback_12m(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return events.lookback_count(p.admit).select("patid", "encounterid", "admit_date", "n_prior_12m")


@register("running_event_stats", 1, "W5 W7 W8",
          compose("""
SELECT patid, encounterid, n_days_total, running_n,
       ROW_NUMBER() OVER (PARTITION BY patid ORDER BY admit_date, encounterid) AS seq
FROM (
  SELECT a.patid, a.encounterid, a.admit_date, t.n_days_total,
         COUNT(*) OVER (PARTITION BY a.patid ORDER BY a.admit_date, a.encounterid
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_n
  FROM o_admit a JOIN (SELECT patid, COUNT(DISTINCT admit_date) AS n_days_total FROM o_admit GROUP BY patid) t
    ON a.patid = t.patid
) s
WHERE EXISTS (SELECT 1 FROM o_linked l WHERE l.patid = s.patid AND l.encounterid = s.encounterid)"""))
def running_event_stats(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    rows = events.merge_sources_relink({"all": p.admit}, skew_safe=p.skew_safe)
    return rows.select("patid", "encounterid", "n_days_total", "running_n", "seq")


# -- step 2 -------------------------------------------------------------------

@register("coverage_span", 2, "C1 A1 A2 P3", compose("SELECT patid, enr_start, enr_end FROM o_span"))
def coverage_span(spark, sf_dir):
    return _pipe(spark, sf_dir).span


_COHORT_COLS = ["patid", "birth_date", "sex", "race", "hispanic", "enr_start", "enr_end", "ctx_id", "first_value",
                "first_date", "age_at_enr_start", "enr_dur"]


def cohort(p: Pipeline):
    return p.cohort_once


@register("build_cohort", 2, "C2 W1 W2 J1 J3",
          compose("SELECT * FROM o_cohort"))
def build_cohort(spark, sf_dir):
    return cohort(_pipe(spark, sf_dir))


@register("first_qualifying", 2, "W1 J3", compose("SELECT * FROM o_firstm"))
def first_qualifying(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    m = fx.fx_measure.filter((F.col("measure_type") == "BMI") & F.col("measure_num").between(30, 200))
    return (events.first_per(m, ["patid"], ["measure_date"], ["measure_num"])
            .select("patid", F.col("measure_num").alias("first_value"), F.col("measure_date").alias("first_date")))


@register("semi_eligible", 2, "J4 (cohort persons with an eligible event)",
          compose("SELECT * FROM o_cohort c WHERE EXISTS (SELECT 1 FROM o_label l WHERE l.patid = c.patid)"))
def semi_eligible(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return cohort(p).join(p.labelled(), "patid", "left_semi")


@register("anti_excluded", 2, "J5",
          compose("SELECT patid, encounterid FROM o_linked l WHERE NOT EXISTS "
                  "(SELECT 1 FROM o_index_keys i WHERE i.patid = l.patid AND i.encounterid = l.encounterid)"))
def anti_excluded(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return p.linked.join(p.index_keys.select("patid", "encounterid"), ["patid", "encounterid"],
                         "left_anti").select("patid", "encounterid")


@register("anti_next_planned", 2, "J6",
          compose("SELECT patid, encounterid, encounterid_lead FROM o_linked l WHERE NOT EXISTS "
                  "(SELECT 1 FROM o_planned_keys c WHERE c.patid = l.patid AND c.encounterid = l.encounterid_lead)"))
def anti_next_planned(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    pk = p.planned_keys.select("patid", F.col("encounterid").alias("encounterid_lead"))
    return (p.linked.join(pk, ["patid", "encounterid_lead"], "left_anti")
            .select("patid", "encounterid", "encounterid_lead"))


# -- step 3 -------------------------------------------------------------------

@register("map_exact_transformed", 3, "C5 J8 J9 U1", compose("""
SELECT d.patid, d.encounterid, d.dx_type, d.dx, k.grp FROM fx_dx d JOIN fx_dict10 k
  ON replace(d.dx, '.', '') = k.code AND d.dx_type = '10'
UNION
SELECT d.patid, d.encounterid, d.dx_type, d.dx, k.grp FROM fx_dx d JOIN fx_dict9 k
  ON rpad(replace(d.dx, '.', ''), 5, '0') = k.code AND d.dx_type = '09'"""))
def map_exact_transformed(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return (codes.group_dx(fx.fx_dx, fx.fx_dict10, fx.fx_dict9)
            .select("patid", "encounterid", "dx_type", "dx", "grp").distinct())


@register("map_prefix", 3, "J11 (LIKE prefix + padded type)", compose("""
SELECT d.patid, d.encounterid, d.dx, d.dx_type, c.code, c.code_grp, c.score
FROM fx_dx d JOIN fx_prefix_dict c ON d.dx LIKE c.code || '%' AND d.dx_type = lpad(c.code_type, 2, '0')"""))
def map_prefix(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    d = fx.fx_prefix_dict.withColumn("_t", F.lpad("code_type", 2, "0"))
    return (codes.map_prefix(fx.fx_dx, d, "dx", "code", fact_type="dx_type", dict_type=F.col("_t"),
                             carry=["code", "code_grp", "score"])
            .select("patid", "encounterid", "dx", "dx_type", "code", "code_grp", "score"))


@register("map_range", 3, "J10 (numeric range, digit-guarded)", compose("""
SELECT p.patid, p.encounterid, p.px, r.grp FROM fx_px p JOIN fx_ranges r
  ON TRY_CAST(p.px AS DOUBLE) BETWEEN TRY_CAST(r.lb AS DOUBLE) AND TRY_CAST(r.ub AS DOUBLE)
 AND p.px_type = 'CH' AND regexp_full_match(p.px, '[0-9]+') AND regexp_full_match(r.lb, '[0-9]+')"""))
def map_range(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return (codes.map_range(fx.fx_px, fx.fx_ranges, "px", fact_filter=F.col("px_type") == "CH")
            .select("patid", "encounterid", "px", "grp"))


@register("group_px_4way", 3, "C6 U2 J8 J10", compose("""
SELECT p.patid, p.encounterid, p.px_type, p.px, r.grp FROM fx_px p JOIN fx_ranges r
  ON TRY_CAST(p.px AS DOUBLE) BETWEEN TRY_CAST(r.lb AS DOUBLE) AND TRY_CAST(r.ub AS DOUBLE)
 AND p.px_type = 'CH' AND regexp_full_match(p.px, '[0-9]+') AND regexp_full_match(r.lb, '[0-9]+')
UNION
SELECT p.patid, p.encounterid, p.px_type, p.px, r.grp FROM fx_px p JOIN fx_ranges r
  ON p.px = r.lb AND p.px_type = 'CH' AND NOT regexp_full_match(r.lb, '[0-9]+')
UNION
SELECT p.patid, p.encounterid, p.px_type, p.px, k.grp FROM fx_px p JOIN fx_pxdict9 k
  ON replace(p.px, '.', '') = k.code AND p.px_type = '09'
UNION
SELECT p.patid, p.encounterid, p.px_type, p.px, k.grp FROM fx_px p JOIN fx_pxdict10 k
  ON p.px = k.code AND p.px_type = '10'"""))
def group_px_4way(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return (codes.group_px(fx.fx_px, fx.fx_ranges, fx.fx_pxdict9, fx.fx_pxdict10)
            .select("patid", "encounterid", "px_type", "px", "grp").distinct())


@register("exclude_by_group", 3, "C7 J18", compose("SELECT patid, encounterid, grp, excl_type FROM o_index_keys"))
def exclude_by_group(spark, sf_dir):
    return _pipe(spark, sf_dir).index_keys.select("patid", "encounterid", "grp", "excl_type")


_ATTRITION_RULES = [
    ("follow_up_30", "days_to_censor <= 30"),
    ("died", "discharge_disposition = 'E' OR discharge_status = 'EX'"),
    ("against_advice", "discharge_status = 'AM'"),
    ("transfer", "discharge_status IN ('SH', 'IP')"),
]


def _attrition_sql() -> str:
    arms = [f"SELECT '{n}' AS rule, COUNT(DISTINCT patid) AS persons, COUNT(DISTINCT encounterid) AS events "
            f"FROM o_linked WHERE {c}" for n, c in _ATTRITION_RULES]
    arms.append("SELECT 'excl_' || excl_type AS rule, COUNT(DISTINCT patid) AS persons, "
                "COUNT(DISTINCT encounterid) AS events FROM o_index_keys GROUP BY excl_type")
    return compose("\nUNION ALL\n".join(arms))


@register("attrition", 3, "C9 A13 A14", _attrition_sql())
def attrition(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    rules = {n: F.coalesce(F.expr(c), F.lit(False)) for n, c in _ATTRITION_RULES}
    per_rule = events.attrition(p.linked, rules)
    names = spark.createDataFrame([(n,) for n, _ in _ATTRITION_RULES], "rule string")
    per_rule = (names.join(per_rule, "rule", "left")
                .select("rule", F.coalesce("persons", F.lit(0)).cast("bigint").alias("persons"),
                        F.coalesce("events", F.lit(0)).cast("bigint").alias("events")))
    groups = (events.group_attrition(p.index_keys, "excl_type")
              .withColumn("rule", F.concat(F.lit("excl_"), F.col("rule"))))
    return per_rule.unionByName(groups)
