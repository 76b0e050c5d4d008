"""Contextual attributes in long form: metadata-driven unpivot over many wide
tables attached by geographic prefix or by person key, numeric/one-hot
encoding, eligibility flags, observations, dictionaries (§2.8 R1-R7,
§2.11 C11-C14, C18).

The reference generates one SQL string per (table, type) inside a stored
procedure and runs them serially, swallowing errors.  Here the column plan is
computed on the driver from schemas (metadata only), each table gets exactly
one ``unpivot``, and all arms are unioned into one plan; failures raise.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import not_sentinel, strip_zeros
from .events import union_all
from .ranks import by_key

Selection = Mapping[str, str]  # column name -> type ('C' categorical / 'N' numeric)


def _like_to_glob(pattern: str) -> str:
    """A LIKE pattern as a glob; ``[`` and other glob signs stand for themselves."""
    return "".join({"%": "*", "_": "?", "*": "[*]", "?": "[?]", "[": "[[]"}.get(c, c) for c in pattern)


def column_plan(tables: Mapping[str, DataFrame], selection: Selection, key_cols: Sequence[str] = (),
                skip_like: Sequence[str] = ()) -> list[tuple[str, str, list[str]]]:
    """Catalog x selection (J20, S6, A10): for each table and type, the
    selected columns it has, in schema order.  ``skip_like`` are SQL LIKE
    patterns (``_`` = any char) matched case-insensitively on names (P8)."""
    sel = {k.upper(): v for k, v in selection.items()}
    globs = [_like_to_glob(p).upper() for p in skip_like]
    plan = []
    for tname, df in tables.items():
        by_type: dict[str, list[str]] = {}
        for c in df.columns:
            u = c.upper()
            if c in key_cols or u not in sel or any(fnmatch.fnmatchcase(u, g) for g in globs):
                continue
            by_type.setdefault(sel[u], []).append(c)
        plan.extend((tname, t, cols) for t, cols in sorted(by_type.items()))
    return plan


def _unpivot(df: DataFrame, ids: Sequence[str], types: Mapping[str, str], src: str) -> DataFrame:
    """One unpivot of the columns of ``types`` (cast to text, NULLs dropped, names
    upper-cased: H13), each with its type."""
    w = df.select(*ids, *[F.col(c).cast("string").alias(c.upper()) for c in types])
    long = w.unpivot(list(ids), [c.upper() for c in types], "var", "val").filter(F.col("val").isNotNull())
    numeric = [c.upper() for c, t in types.items() if t == "N"]
    return (long.withColumn("type", F.when(F.col("var").isin(numeric), F.lit("N")).otherwise(F.lit("C")))
            .withColumn("src", F.lit(src)))


def _by_table(plan: Sequence[tuple[str, str, list[str]]]) -> dict[str, dict[str, str]]:
    """Column plan as table -> column -> type."""
    tables: dict[str, dict[str, str]] = {}
    for name, type_, cols in plan:
        tables.setdefault(name, {}).update({c: type_ for c in cols})
    return tables


def _dry_run_frame(spark: SparkSession, plan: list[tuple[str, str, list[str]]]) -> DataFrame:
    return spark.createDataFrame([(t, ty, ",".join(cs)) for t, ty, cs in plan],
                                 "table string, type string, columns string")


def attach_area(people: DataFrame, tables: Mapping[str, DataFrame], selection: Selection,
                id: str = "ctx_id", geo_key: str = "block_group", geocode: str = "geocode",
                min_len: int = 10, extra_keys: Sequence[str] = (), skip_like: Sequence[str] = (),
                dry_run: bool = False) -> DataFrame:
    """Area attributes by geographic prefix (C12 area variant: R5 J12 J20 P24).

    ``startswith(person.geo_key, area.geocode) AND length(geocode) >= min_len``
    becomes an equi-join: every person key is exploded into its prefixes of
    length ``min_len .. length(key)`` (a block group has 12 characters, so at
    most 3 rows per person) and joined on the area code -- no nested loop.
    Output: ``(id, geocode, var, val, type, src)``.
    """
    key_cols = [geocode, *extra_keys]
    plan = column_plan(tables, selection, key_cols, skip_like)
    if dry_run:
        return _dry_run_frame(people.sparkSession, plan)
    p = (people.select(id, geo_key).filter(F.length(geo_key) >= min_len)
         .withColumn(geocode, F.explode(F.expr(
             f"transform(sequence({int(min_len)}, length(`{geo_key}`)), n -> substring(`{geo_key}`, 1, n))")))
         .drop(geo_key))
    arms = []
    for tname, types in _by_table(plan).items():
        t = tables[tname].filter(F.length(geocode) >= min_len).select(geocode, *types)
        arms.append(_unpivot(by_key(p).join(t, geocode), [id, geocode], types, tname))
    return union_all(arms)


def attach_areas(people: DataFrame, tables: Mapping[tuple[str, str], DataFrame],
                 selection: Mapping[tuple[str, str], Selection], id: str = "patid", geo_key: str = "block_group",
                 geocode: str = "geocode", min_len: int = 10, extra_keys: Sequence[str] = ("geo_accuracy",),
                 skip_like: Sequence[str] = (), dry_run: bool = False) -> DataFrame:
    """Area attributes of many tables at their own code levels (C12, R5: several
    tables, each with its own selection, and keys that are carried along).

    ``tables`` and ``selection`` are keyed by (schema, table), as the catalog and
    the selection list are; ``src`` is the schema.  A table without one of
    ``extra_keys`` gives null there.  The selected values of an area row stay in
    one array until the end, so that all tables meet the codes in one join of a
    row per area, and persons meet a row per area of their block group rather
    than one per variable.  The codes are the prefixes of *distinct* block
    groups, ``min_len`` to 12 characters, at most three each.  Persons without a
    block group, nulls and tables without a selected column give no rows.
    Output: ``(id, geocode, *extra_keys, var, val, type, src)``.
    """
    key_cols = [geocode, *extra_keys]
    plan = [(name, type_, cols) for name, df in tables.items()
            for _, type_, cols in column_plan({name[1]: df}, selection.get(name, {}), key_cols, skip_like)]
    if dry_run:
        return _dry_run_frame(people.sparkSession, [(".".join(n), t, c) for n, t, c in plan])
    arms = []
    for name, types in _by_table(plan).items():
        t = tables[name]
        held = [F.when(F.col(c).isNotNull(), F.struct(F.lit(c.upper()).alias("var"), F.col(c).cast("string").alias("val"),
                                                      F.lit(kind).alias("type"))) for c, kind in types.items()]
        extra = [(F.col(k).cast("string") if k in t.columns else F.lit(None).cast("string")).alias(k) for k in extra_keys]
        arms.append(t.filter(F.length(geocode) >= min_len)
                    .select(geocode, *extra, F.lit(name[0]).alias("src"), F.array_compact(F.array(*held)).alias("held")))
    if not arms:
        raise ValueError("no table has a selected column")
    p = people.select(id, geo_key).filter(F.length(geo_key) >= min_len)
    prefixes = F.expr(f"transform(sequence({int(min_len)}, length(`{geo_key}`)), n -> substring(`{geo_key}`, 1, n))")
    codes = p.select(geo_key).distinct().select(geo_key, F.explode(prefixes).alias(geocode))
    return (by_key(p).join(codes.join(union_all(arms), geocode), geo_key)
            .select(id, *key_cols, "src", F.explode("held").alias("one"))
            .select(id, *key_cols, "one.var", "one.val", "one.type", "src"))


def attach_person(people: DataFrame, tables: Mapping[str, DataFrame], selection: Selection,
                  key: str = "ctx_id", id: str = "patid", skip_like: Sequence[str] = ("%_PREC",),
                  src: str | None = None, dry_run: bool = False) -> DataFrame:
    """Person-keyed attributes (C12 person variant: R5 J20 P8).  Columns whose
    names match ``skip_like`` are left out.  Output ``(id, var, val, type, src)``."""
    plan = column_plan(tables, selection, [key], skip_like)
    if dry_run:
        return _dry_run_frame(people.sparkSession, plan)
    arms = []
    for tname, types in _by_table(plan).items():
        j = people.select(id, key).join(by_key(tables[tname].select(key, *types)), key)
        arms.append(_unpivot(j, [id], types, src or tname))
    return union_all(arms)


def encode_long(long: DataFrame, id: str = "patid", faithful: bool = False,
                keys: Sequence[str] = ()) -> DataFrame:
    """Typed long -> numeric long (C13: R6).

    ``C`` rows become one-hot ``(var_orig=var, var=var||'_'||val, val=1)``;
    ``N`` rows keep their name and take a number.  Default: ``try_cast`` to
    double (zeros and fractions kept).  ``faithful=True`` reproduces the
    reference's scale-0 numeric cast of the zero-stripped text: values are
    rounded to integers and zeros are dropped (H5).
    """
    base = [id, *keys]
    cat = (long.filter(F.col("type") == "C")
           .select(*base, F.col("var").alias("var_orig"), F.concat(F.col("var"), F.lit("_"), F.col("val")).alias("var"),
                   F.lit(1.0).alias("val"), "src"))
    if faithful:
        stripped = strip_zeros(F.col("val"))
        num_val = F.when(stripped == "", F.lit(0.0)).otherwise(stripped.try_cast("decimal(38,0)").cast("double"))
        keep = stripped.try_cast("decimal(38,0)").isNotNull()
    else:
        num_val = F.col("val").try_cast("double")
        keep = num_val.isNotNull()
    num = (long.filter((F.col("type") == "N") & keep)
           .select(*base, F.col("var").alias("var_orig"), "var", num_val.alias("val"), "src"))
    return cat.unionByName(num).distinct()


def flag_attributes(people: DataFrame, records: DataFrame, flags: Mapping[str, Column], id: str = "patid",
                    src: str = "CMS") -> DataFrame:
    """One constant row per person with any record meeting each flag's
    condition (C14: J4 A16).  One pass over the records whatever the number of
    flags; the result is semi-joined to the cohort."""
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in flags.items()])
    hits = (records.select(id, F.explode(tags).alias("var")).filter(F.col("var").isNotNull()).distinct())
    return (hits.join(by_key(people.select(id).distinct()), id, "left_semi")
            .select(id, F.col("var").alias("var_orig"), "var", F.lit(1.0).alias("val"), F.lit(src).alias("src")))


def observations_long(vitals: DataFrame, numeric: Mapping[str, str | None], qualitative: Sequence[str],
                      clinical: DataFrame | None = None, terminology: DataFrame | None = None,
                      people: DataFrame | None = None, id: str = "patid", date: str = "measure_date") -> DataFrame:
    """Vitals and clinical observations in one long table (C11: R3 R4 J19 U3 P10).

    ``numeric`` maps vital columns to their unit; they are rounded, unpivoted,
    NULLs dropped.  ``qualitative`` columns are unpivoted with blank and
    sentinel values dropped.  ``clinical`` rows (patid, start, stop, type, code,
    num, unit, qual, text, raw_name) get a date fallback, a trimmed
    qualifier/text fallback and a terminology name when the code system is
    ``LC``.  Output: ``(patid, obs_date, obs_code_type, obs_code, obs_num,
    obs_unit, obs_qual, obs_name)``, distinct.
    """
    names = list(numeric)
    num = (vitals.select(id, date, *[F.round(F.col(c)).cast("double").alias(c.upper()) for c in names])
           .unpivot([id, date], [c.upper() for c in names], "obs_name", "obs_num")
           .filter(F.col("obs_num").isNotNull()))
    unit = None
    for c, u in numeric.items():
        cond = F.col("obs_name") == F.lit(c.upper())
        unit = F.when(cond, F.lit(u)) if unit is None else unit.when(cond, F.lit(u))
    num = num.select(id, F.col(date).alias("obs_date"), F.lit("UD").alias("obs_code_type"),
                     F.col("obs_name").alias("obs_code"), "obs_num", unit.cast("string").alias("obs_unit"),
                     F.lit("NI").alias("obs_qual"), "obs_name")
    qual = (vitals.select(id, date, *[F.col(c).cast("string").alias(c.upper()) for c in qualitative])
            .unpivot([id, date], [c.upper() for c in qualitative], "obs_name", "obs_qual")
            .filter(not_sentinel("obs_qual"))
            .select(id, F.col(date).alias("obs_date"), F.lit("UD").alias("obs_code_type"),
                    F.col("obs_name").alias("obs_code"), F.lit(None).cast("double").alias("obs_num"),
                    F.lit(None).cast("string").alias("obs_unit"), "obs_qual", "obs_name"))
    arms = [num, qual]
    if clinical is not None:
        q = F.coalesce(F.trim("qual"), F.trim("text"))
        c = clinical
        if terminology is not None:
            t = terminology.select(F.col("loinc_num").alias("code"), F.lit("LC").alias("type"),
                                   F.col("long_common_name"))
            c = c.join(t, ["code", "type"], "left")
        else:
            c = c.withColumn("long_common_name", F.lit(None).cast("string"))
        arms.append(c.filter(F.col("num").isNotNull() | not_sentinel(q))
                    .select(F.col(id), F.coalesce("start", "stop").alias("obs_date"),
                            F.col("type").alias("obs_code_type"), F.col("code").alias("obs_code"),
                            F.col("num").cast("double").alias("obs_num"), F.col("unit").alias("obs_unit"),
                            q.alias("obs_qual"), F.coalesce("raw_name", "long_common_name").alias("obs_name")))
    out = union_all(arms)
    if people is not None:
        out = out.join(people.select(id).distinct(), id, "left_semi")
    return out.distinct()


def data_dictionary(arms: Sequence[DataFrame]) -> DataFrame:
    """``(var, var_label, var_domain)`` from several sources, distinct (C18: S4 S5 U1)."""
    return union_all([a.select("var", "var_label", "var_domain") for a in arms]).distinct()


def catalog_dictionary(spark: SparkSession, tables: Mapping[str, DataFrame], labels: DataFrame | None = None,
                       domain: str = "AREA", exclude_like: Sequence[str] = ("Z_REF%",),
                       key_cols: Sequence[str] = ()) -> DataFrame:
    """Variables available in a set of tables (schema metadata, A10/S6/J20),
    labelled from a label table when one has the name (coalesce to the name)."""
    globs = [_like_to_glob(p).upper() for p in exclude_like]
    rows = [(domain, t, c.upper()) for t, df in tables.items()
            if not any(fnmatch.fnmatchcase(t.upper(), g) for g in globs)
            for c in df.columns if c not in key_cols]
    cat = spark.createDataFrame(rows, "var_domain string, var_subdomain string, var string")
    if labels is None:
        return cat.withColumn("var_label", F.col("var"))
    lab = labels.select(F.upper("var").alias("var"), "var_label").distinct()
    return (cat.join(lab, "var", "left")
            .withColumn("var_label", F.coalesce("var_label", "var")))


def catalog_from_data(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], labels: DataFrame | None = None,
                      exclude_like: Sequence[str] = ("Z_REF%",)) -> DataFrame:
    """Variables present in a set of wide tables, found in the data: every
    non-key column is unpivoted (one ``unpivot`` per table) and a variable is
    listed when it holds at least one value (S6 J20).  ``tables`` maps a name
    to ``(frame, key columns)``; output ``(var_domain, var, var_label)`` with
    the label from ``labels`` ``(var, var_label)`` or the name itself."""
    globs = [_like_to_glob(p).upper() for p in exclude_like]
    arms = []
    for name, (df, keys) in tables.items():
        if any(fnmatch.fnmatchcase(name.upper(), g) for g in globs):
            continue
        cols = [c for c in df.columns if c not in keys]
        arms.append(_unpivot(df, list(keys), dict.fromkeys(cols, "C"), name).select(F.col("src").alias("var_domain"), "var")
                    .distinct())
    cat = union_all(arms)
    if labels is None:
        return cat.withColumn("var_label", F.col("var"))
    lab = labels.groupBy(F.upper("var").alias("var")).agg(F.min("var_label").alias("var_label"))
    return cat.join(lab, "var", "left").withColumn("var_label", F.coalesce("var_label", "var"))
