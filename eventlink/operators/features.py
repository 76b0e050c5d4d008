"""Encounter-level analytic set, long features, variable profiles, splits and
model inputs (§2.10, §2.11 C15-C17, M1-M6, M10-M12, A5-A7)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import age_years, clip_bucket, is_digits, recode_any, recode_first
from .events import union_all
from .ranks import attach_scalars, by_key, exact_quantiles, numbered_keys, surrogate_id

# Race code map of the analytic base (source code -> label).
RACE_MAP = {"05": "WH", "03": "AA", "02": "AS", "01": "AI"}
# Comorbidity classes (inclusive bounds, label).
CCI_CLASSES = [(1, 2, "CCI1"), (3, 4, "CCI2"), (5, None, "CCI3")]
# Diagnosis code prefixes that mark obesity.
OBESITY_PREFIXES = ("278", "E66", "Z68.3", "Z68.4")


def freq_regroup(df: DataFrame, col: str, min_share: float | None = 0.01, min_count: int | None = None,
                 prefix: str = "DRG_", other: str = "DRG_OT") -> DataFrame:
    """Levels with at least ``min_count`` rows (or ``min_share`` of all rows)
    keep ``prefix||level``; rarer ones become ``other`` (A5).  Output
    ``(col, freq, <col>_regrp)``: one row per level.  The share threshold uses
    the number of rows as a scalar subquery."""
    lv = df.groupBy(col).agg(F.count(F.lit(1)).alias("freq"))
    if min_count is not None:
        thr = F.lit(min_count)
    else:
        lv = attach_scalars(lv, df.agg(F.count(F.lit(1)).alias("_all")))
        thr = F.col("_all") * F.lit(min_share)
    return lv.select(col, "freq", F.when(F.col("freq") >= thr, F.concat(F.lit(prefix), F.col(col)))
                     .otherwise(F.lit(other)).alias(f"{col}_regrp"))


def analytic_base(labelled: DataFrame, people: DataFrame, alt_people: DataFrame, history: DataFrame | None,
                  obesity: DataFrame | None, drg_groups: DataFrame, id: str = "patid",
                  event: str = "encounterid", link_key: str = "ctx_id", label: str = "label",
                  with_id: bool = True) -> DataFrame:
    """One row per eligible event with recoded demographics, clipped counts,
    comorbidity score and class, regrouped DRG and a dense surrogate id (C15:
    W9 A4 A5 P14-P18).  ``people`` (registry) and ``alt_people`` (second
    source) disagree; precedence follows the reference: sex registry first,
    race second source first, hispanic any-source-says-yes."""
    b = people.select(id, link_key, "birth_date", F.col("sex").alias("_sex_b"), F.col("race").alias("_race_b"),
                      F.col("hispanic").alias("_hisp_b"))
    d = alt_people.select(id, F.col("sex").alias("_sex_d"), F.col("race").alias("_race_d"),
                          F.col("hispanic").alias("_hisp_d"))
    a = labelled.select(id, event, label, "n_prior_12m", "los", "discharge_status", "enc_type", "admit_date", "drg")
    x = a.join(by_key(b), id).join(by_key(d), id, "left")
    if obesity is not None:
        x = x.join(by_key(obesity.select(id, "obes_date")), id, "left")
    else:
        x = x.withColumn("obes_date", F.lit(None).cast("date"))
    if history is not None:
        x = x.join(by_key(history.select(id, event, F.col("score_total").alias("_cci"))), [id, event], "left")
    else:
        x = x.withColumn("_cci", F.lit(None).cast("bigint"))
    x = x.join(drg_groups.select("drg", "drg_regrp"), "drg", "left")
    base = x.select(
        id, F.col(link_key), event, F.col(label),
        clip_bucket(F.col("n_prior_12m"), cap=6).alias("ip_cumcnt_12m"),
        "los", "discharge_status",
        F.when(F.col("enc_type") == "EI", 1).otherwise(0).alias("ed_ind"),
        age_years("birth_date", "admit_date").alias("age_at_enc"),
        F.coalesce("_sex_b", "_sex_d").alias("sex"),
        recode_first(["_race_d", "_race_b"], RACE_MAP).alias("race"),
        recode_any(["_hisp_d", "_hisp_b"]).alias("hispanic"),
        F.when(F.col("obes_date") <= F.col("admit_date"), F.lit(1)).alias("obes"),
        F.when(F.col("_cci") >= 16, F.lit(16).cast("bigint")).otherwise(F.coalesce("_cci", F.lit(0).cast("bigint")))
        .alias("cci"),
        clip_bucket(F.col("_cci"), edges=CCI_CLASSES, default="CCI0").alias("cci_class"),
        F.coalesce("drg_regrp", F.lit("DRG_NI")).alias("drg_regrp"),
    )
    return surrogate_id(base, [id, event], "rowid") if with_id else base


def obesity_onset(first_measure: DataFrame, dx: DataFrame, id: str = "patid",
                  prefixes: Sequence[str] = OBESITY_PREFIXES) -> DataFrame:
    """Earliest of the first qualifying measurement and any diagnosis whose
    code starts with one of ``prefixes`` (P7)."""
    cond = None
    for p in prefixes:
        c = F.col("dx").startswith(p)
        cond = c if cond is None else cond | c
    arms = [first_measure.select(id, F.col("first_date").alias("obes_date")),
            dx.filter(cond).select(id, F.col("dx_date").alias("obes_date"))]
    return union_all(arms).groupBy(id).agg(F.min("obes_date").alias("obes_date"))


def wide_to_long(df: DataFrame, ids: Sequence[str], categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Categoricals -> one-hot ``(VAR_val, 1)``; numerics -> ``(VAR, value)``,
    NULLs dropped (R1 R2).  Variable names are upper-cased column names.  One row
    per (row, variable) as long as ``ids`` name a row."""
    cat = (df.select(*ids, *[F.col(c).cast("string").alias(c.upper()) for c in categorical])
           .unpivot(list(ids), [c.upper() for c in categorical], "var", "_v")
           .filter(F.col("_v").isNotNull())
           .select(*ids, F.concat(F.col("var"), F.lit("_"), F.col("_v")).alias("var"), F.lit(1.0).alias("val")))
    num = (df.select(*ids, *[F.col(c).cast("bigint").cast("double").alias(c.upper()) for c in numeric])
           .unpivot(list(ids), [c.upper() for c in numeric], "var", "val")
           .filter(F.col("val").isNotNull()))
    return cat.unionByName(num)


def typed_long(df: DataFrame, ids: Sequence[str], categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Wide -> ``(ids, var, val text, type C/N)`` without encoding (input of summaries)."""
    cat = (df.select(*ids, *[F.col(c).cast("string").alias(c.upper()) for c in categorical])
           .unpivot(list(ids), [c.upper() for c in categorical], "var", "val").withColumn("type", F.lit("C")))
    num = (df.select(*ids, *[F.col(c).cast("string").alias(c.upper()) for c in numeric])
           .unpivot(list(ids), [c.upper() for c in numeric], "var", "val").withColumn("type", F.lit("N")))
    return cat.unionByName(num).filter(F.col("val").isNotNull())


def variable_profile(attrs: DataFrame, rows: DataFrame, key: str, row: str = "rowid", var: str = "var",
                     val: str = "val", type_: str = "type", label: str = "label", faithful: bool = False,
                     keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Per variable: coverage ``rt = rows that have it / rows that have any``,
    label-weighted rate ``crt = sum(label) / rows that have any`` and an
    imputation value (exact median of the all-digit values of numeric
    variables; NULL for categoricals) (C16: A6 A7 J15 J17).

    ``attrs``: (``key``, var, val, type), attribute rows of persons; ``rows``:
    (``row``, ``key``, label), unique event rows.  The events are counted per
    person first and the persons' attributes weighted with them, so rows x
    variables are never formed.  The imputation table is left-joined (H19);
    ``faithful=True`` keeps the inner join, which drops numeric variables with
    no all-digit value.  ``keep`` writes the weighted attributes, which the rates
    and the medians all read."""
    per = rows.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_rows"), F.sum(label).alias("_lab"))
    a = attrs.select(F.col(key).alias("_k"), var, val, type_).distinct().join(by_key(per), "_k")
    if keep is not None:
        a = keep(a, f"weighted-{key}")
    n = a.select("_k", "_rows").distinct().agg(F.sum("_rows").alias("_N"))
    held = a.groupBy("_k", type_, var).agg(F.first("_rows").alias("_rows"), F.sum("_lab").alias("_lab"))
    rt = held.groupBy(type_, var).agg(F.sum("_rows").alias("_rows"), F.sum("_lab").alias("_lab"))
    rt = attach_scalars(rt, n).select(
        type_, var, (F.col("_rows") / F.col("_N")).alias("rt"), (F.col("_lab") / F.col("_N")).alias("crt"))
    imp_n = exact_quantiles(a.filter((F.col(type_) == "N") & is_digits(val)), [var], val,
                            {"imp_val": 0.5}, weight="_rows").select(var, "imp_val")
    if not faithful:
        return rt.join(imp_n, var, "left").select(type_, var, "rt", "crt", "imp_val")
    known = imp_n.join(rt.select(var), var, "left_semi")
    return rt.join(known, var, "left").filter((F.col(type_) == "C") | F.col("imp_val").isNotNull()).select(
        type_, var, "rt", "crt", "imp_val")


def attribute_features(attrs_num: DataFrame, base_rows: DataFrame, profile: DataFrame, keep: Column, person_key: str,
                       attr_person: str = "patid", row_cols: Sequence[str] = ("rowid", "patid", "encounterid", "label"),
                       impute: bool = False) -> DataFrame:
    """The attribute features of the variables that the profile keeps, for every
    event row of their person (C17: M10 M11 R7).

    The kept variables (one row per variable) filter the persons' attribute
    rows, which are made distinct per person and then joined to the event rows:
    no cross product, and no distinct over the result.  An attribute value is
    never NULL, so by default no value is imputed (H8); ``impute=True`` gives
    every event row without a kept numeric variable its imputation value, one
    row per event and variable as that form asks for."""
    kept = profile.filter(keep).select(F.col("var").alias("var_orig"), "imp_val").distinct()
    # broadcast: one row per variable; left to itself, Spark may broadcast the attribute rows
    a = attrs_num.join(F.broadcast(kept), "var_orig").select(F.col(attr_person).alias("_pk"), "var",
                                                F.coalesce("val", "imp_val").alias("val"))
    rows = base_rows.select(*row_cols, F.col(person_key).alias("_pk"))
    found = rows.join(by_key(a.filter(F.col("val").isNotNull()).distinct()), "_pk").select(*row_cols, "var", "val")
    if not impute:
        return found
    wanted = kept.filter(F.col("imp_val").isNotNull()).agg(
        F.collect_set(F.struct(F.col("var_orig").alias("var"), F.col("imp_val").alias("val"))).alias("_all"))
    every = attach_scalars(rows.drop("_pk"), wanted).select(*row_cols, F.explode("_all").alias("_x"))
    every = every.select(*row_cols, "_x.var", "_x.val")
    # only features of a variable with an imputation value can meet these rows
    imputed = kept.filter(F.col("imp_val").isNotNull()).select(F.col("var_orig").alias("var")).distinct()
    held = found.select(row_cols[0], "var").join(F.broadcast(imputed), "var", "left_semi")
    return found.unionByName(every.join(held, [row_cols[0], "var"], "left_anti"))


def feature_long(base_long: DataFrame, *features: DataFrame,
                 row_cols: Sequence[str] = ("rowid", "patid", "encounterid", "label")) -> DataFrame:
    """Base long features plus any :func:`attribute_features` (R7): each part has
    a variable of a row once and no two parts share one, so they are put
    together as they are."""
    return union_all([x.select(*row_cols, "var", "val") for x in (base_long, *features)])


def subgroup_flags(base: DataFrame, flags: DataFrame, flag_var: str = "DUAL_LIS_ELIG", id: str = "patid") -> DataFrame:
    """Per event: dual/low-income flag, non-white, obese, age 65+ (M12: J2 P18)."""
    f = flags.filter(F.col("var") == flag_var).select(id).distinct().withColumn("_ind", F.lit(1))
    return (base.join(by_key(f), id, "left")
            .select(id, "encounterid", "rowid", F.coalesce("_ind", F.lit(0)).alias("dual_lis"),
                    F.when(F.col("race") != "WH", 1).otherwise(0).alias("non_white"),
                    F.coalesce("obes", F.lit(0)).alias("obes"),
                    F.when(F.col("age_at_enc") >= 65, 1).otherwise(0).alias("age_65up")))


# -- splits (M1-M3) ---------------------------------------------------------

def unit_hash(seed: str, *parts: str | Column) -> Column:
    """Deterministic uniform in [0, 1) from md5 of ``seed:part:...``.
    The same expression is written in the DuckDB oracle."""
    cols = [F.lit(seed)]
    for p in parts:
        cols += [F.lit(":"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    h = F.md5(F.concat(*cols))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


# Hold-out shares and fold counts of the reference's splits.
HOLDOUTS = {"hdout55": 0.5, "hdout64": 0.6, "hdout73": 0.7, "hdout82": 0.8, "hdout91": 0.9}
FOLDS = {"cv5": 5, "cv10": 10}


def hash_split(df: DataFrame, key: str, seed: str = "split", holdouts: Mapping[str, float] = HOLDOUTS,
               folds: Mapping[str, int] = FOLDS, keep: Sequence[str] = ()) -> DataFrame:
    """Hold-out flags (1 = test, share ``1 - p``) and fold numbers from a hash
    of ``key`` (M1 with the group key, M2 with the row id).  Row-wise: no
    shuffle, no driver state, reproducible after any re-run."""
    cols = [F.col(c) for c in keep]
    for name, p in holdouts.items():
        cols.append(F.when(unit_hash(seed, F.lit(name), key) >= F.lit(p), 1).otherwise(0).alias(name))
    for name, k in folds.items():
        cols.append((F.floor(unit_hash(seed, F.lit(name), key) * k) + 1).cast("int").alias(name))
    return df.select(*cols)


def leakage_check(split: DataFrame, group: str, side: str) -> DataFrame:
    """Groups whose rows fall on both sides of a hold-out split (M3)."""
    per = split.groupBy(group).agg(F.countDistinct(side).alias("_sides"))
    return per.agg(F.count(F.lit(1)).alias("groups"),
                   F.sum(F.when(F.col("_sides") > 1, 1).otherwise(0)).cast("bigint").alias("groups_both_sides"))


# -- encoder, shadow, sparse rows (M4-M6, R9, U6) ----------------------------

RELATIONSHIPS = ("many-to-one", "many-to-many")


def join_names(rows: DataFrame, names: DataFrame, on: str, relationship: str = "many-to-one",
               how: str = "inner") -> DataFrame:
    """Rows with the entries of their name (J21), ``how`` inner or left.

    ``many-to-one``: a row that meets several entries ends the query with the
    name in the error; the check is part of the plan, runs in the tasks that
    join, and leaves entries alone that no row asks for.  ``many-to-many`` opts
    out: every match is a row.  A null name meets nothing.  Columns of ``names``
    must not be columns of ``rows``, but for ``on``."""
    if relationship not in RELATIONSHIPS or how not in ("inner", "left"):
        raise ValueError(f"relationship {relationship!r}, how {how!r}")
    if relationship == "many-to-many":
        return rows.join(names, on, how)
    others = [c for c in names.columns if c != on]
    found = names.groupBy(F.col(on).alias("_on")).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_one"))
    met = rows.join(found, F.col(on) == F.col("_on"), how)
    # never true; not deterministic, so the optimizer does not copy the check to names that no row asks for
    here = F.spark_partition_id() < 0
    once = F.assert_true((F.coalesce("_n", F.lit(1)) == 1) | here,
                         F.concat(F.lit("several entries for "), F.col(on).cast("string")))
    return met.filter(once.isNull()).select(*[F.col(c) for c in rows.columns], *[F.col("_one")[c].alias(c) for c in others])


def variable_encoder(names: DataFrame, dictionary: DataFrame, strip_prefix: str = r"^(DRG_REGRP_DRG_)+",
                     retry_prefix: str = r"^(P_|H_)", domain_rules: Sequence[tuple[str, str]] = (),
                     default_type: str = "s_sdh", var: str = "var", relationship: str = "many-to-one") -> DataFrame:
    """Distinct variable names -> ``V1..Vn`` ids, dictionary label and domain
    (M4: W13 J21 J22).

    A name has two dictionary keys: itself without ``strip_prefix``, then
    itself, without its last ``_suffix`` if it matches ``retry_prefix``.  Both
    keys are looked up in one join, and the first key with
    a label gives label and domain.  Different entries of one key end the query;
    with ``relationship="many-to-many"`` each is a row, with the same id (see
    :func:`join_names`).  ``domain_rules`` = [(regex on domain,
    type)], first match wins; no domain -> ``base``."""
    coded = numbered_keys(names.select(F.col(var).alias("name")), ["name"], "number")
    retry = F.when(F.col("name").rlike(retry_prefix), F.regexp_replace("name", r"_[^_]*$", ""))
    wanted = F.array(F.regexp_replace("name", strip_prefix, ""), F.coalesce(retry, "name"))
    keyed = coded.select("name", F.posexplode(wanted).alias("turn", "key"))
    entries = (dictionary.filter(F.col("var_label").isNotNull())
               .select(F.col("var").alias("key"), "var_label", "var_domain").distinct())
    found = join_names(keyed, entries, "key", relationship)
    first = found.groupBy(F.col("name").alias("_of")).agg(F.min("turn").alias("_turn"))
    hits = (found.join(first, (F.col("name") == F.col("_of")) & (F.col("turn") == F.col("_turn")), "left_semi")
            .select("name", F.struct("var_label", "var_domain").alias("entry")))
    best = coded.join(hits, "name", "left")
    domain, label = F.col("entry.var_domain"), F.col("entry.var_label")
    kind = F.when(domain.isNull(), F.lit("base"))
    for pattern, type_ in domain_rules:
        kind = kind.when(domain.rlike(pattern), F.lit(type_))
    return best.select(F.col("name").alias(var), label.alias("var_label"), domain.alias("var_domain"),
                       F.coalesce(label, "name").alias("var_lbl"), kind.otherwise(F.lit(default_type)).alias("var_domain_type"),
                       F.concat(F.lit("V"), F.col("number").cast("string")).alias("var3"))


def shadow_feature(rows: DataFrame, seed: str = "shadow", row: str = "rowid") -> DataFrame:
    """A random 0/1 'shadow' feature per row, the noise floor for importance (M5)."""
    return rows.select(row).distinct().select(
        row, F.lit("shadow").alias("var"),
        F.when(unit_hash(seed, row) < 0.5, 0.0).otherwise(1.0).alias("val"))


def sparse_rows(long: DataFrame, encoder: DataFrame, row: str = "rowid", var: str = "var",
                val: str = "val") -> DataFrame:
    """Long features -> one sparse row per id: sorted 0-based indices and
    values (R9).  Each row's list is bounded by the number of variables, not
    by the data size.  ``to_vectors`` turns it into ``pyspark.ml`` vectors."""
    # a name with several entries has one id
    idx = encoder.select(var, (F.regexp_replace("var3", "^V", "").cast("int") - 1).alias("_i")).distinct()
    j = long.join(F.broadcast(idx), var)  # one row per variable; the long rows need not move for it
    g = j.groupBy(row).agg(F.array_sort(F.collect_list(F.struct(F.col("_i").alias("i"), F.col(val).alias("v"))))
                           .alias("_e"))
    return g.select(row, F.col("_e.i").alias("indices"), F.col("_e.v").alias("values"))


def shared_features(a: DataFrame, b: DataFrame, var: str = "var") -> DataFrame:
    """Variable names present in both splits."""
    return a.select(var).distinct().join(b.select(var).distinct(), var)
