"""Code-to-group mapping by exact, transformed, prefix and range match, and
the exclusion and comorbidity products built on it (§2.3 J8-J12, §2.11 C5-C7, C10).

Shared technique (§4.3): *map the distinct codes, then join back*.  Facts are
large, the set of distinct ``(type, code)`` pairs and the dictionaries are
small.  Every theta condition (prefix, range) is evaluated on the distinct
codes only and turned into an equi-join key, so the big side meets exactly one
hash/sort-merge join; AQE turns it into a broadcast join at run time when the
mapping turns out small, and keeps the shuffle join when it does not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_digits, pad_right, strip_dots
from .events import union_all
from .ranks import attach_scalars, by_key


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_exact(facts: DataFrame, dictionary: DataFrame, fact_key: str | Column, dict_key: str = "code",
              grp: str = "grp", out: str = "grp", fact_filter: Column | None = None,
              dict_filter: Column | None = None) -> DataFrame:
    """Equi-join on a computed key (J8, J9): e.g. dots stripped, right-padded.

    The constant predicate on the code type (J9) is applied to the facts before
    the join so it reaches the scan.
    """
    f = facts if fact_filter is None else facts.filter(fact_filter)
    d = dictionary if dict_filter is None else dictionary.filter(dict_filter)
    d = d.select(F.col(dict_key).alias("_k"), F.col(grp).alias(out)).distinct()
    return f.withColumn("_k", _col(fact_key)).join(d, "_k").drop("_k")


def _literal_prefix(c: Column) -> Column:
    """What a LIKE pattern starts with before its first wildcard or escape."""
    return F.regexp_extract(c, r"^([^%_\\\\]*)", 1)


def prefix_mapping(codes: DataFrame, dictionary: DataFrame, code: str, dict_code: str = "code",
                   type_pairs: tuple[Column, Column] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Map distinct codes to dictionary rows whose code is a prefix of them
    (``code LIKE dict_code || '%'``).

    Every prefix of each distinct code, the empty one included, is exploded
    (``length(code) + 1`` rows per distinct code) and equi-joined to the literal
    start of the dictionary entry; the LIKE itself is the residual, so entries
    with wildcards take the same way.  No nested loop, and no join on the type
    alone.  ``type_pairs`` = (code-side type column, dictionary-side type column)
    adds an equality on the type.
    """
    typed = type_pairs is not None
    d = dictionary.select(F.col(dict_code).alias("_w"), _literal_prefix(F.col(dict_code)).alias("_p"),
                          *([type_pairs[1].alias("_dt")] if typed else []), *carry)
    c = codes.select(F.col(code).alias("_c"), *([type_pairs[0].alias("_dt")] if typed else []))
    c = c.filter(F.col("_c").isNotNull()).distinct()
    c = c.withColumn("_p", F.explode(F.expr("transform(sequence(0, length(_c)), n -> substring(_c, 1, n))")))
    j = c.join(d, ["_p", "_dt"] if typed else ["_p"]).filter(F.expr("_c LIKE concat(_w, '%')"))
    return j.select("_c", *(["_dt"] if typed else []), *carry)


def map_prefix(facts: DataFrame, dictionary: DataFrame, code: str, dict_code: str = "code",
               fact_type: str | None = None, dict_type: Column | None = None,
               carry: Sequence[str] = ("grp",), keep: Callable[[DataFrame, str], DataFrame] | None = None,
               codes: DataFrame | None = None) -> DataFrame:
    """Facts joined to every dictionary row whose code prefixes theirs.
    ``keep`` writes the mapping of the distinct codes, so that Spark knows its size
    when it plans the join and need not shuffle the facts for it.  ``codes``: the
    facts' codes (and types) if they are at hand, else the facts are read for them."""
    tp = (F.col(fact_type), dict_type) if fact_type is not None else None
    m = prefix_mapping(facts if codes is None else codes, dictionary, code, dict_code, tp, carry)
    if keep is not None:
        m = keep(m, "prefix-mapping")
    m = m.withColumnRenamed("_c", code)
    keys = [code]
    if fact_type is not None:
        m = m.withColumnRenamed("_dt", fact_type)
        keys.append(fact_type)
    return facts.join(m, keys)


def map_range(facts: DataFrame, ranges: DataFrame, code: str, lb: str = "lb", ub: str = "ub",
              carry: Sequence[str] = ("grp",), fact_filter: Column | None = None) -> DataFrame:
    """Numeric range join ``num(code) BETWEEN num(lb) AND num(ub)``, with the
    code and the lower bound guarded to be all digits (J10).

    A range gets buckets as wide as the power of two above its span, so it lies
    in two of them at most however wide it is.  Distinct numeric codes look up
    their bucket once for every width that the dictionary has (some tens), and
    the exact BETWEEN is the residual.  Exact for any bounds.
    """
    f = facts if fact_filter is None else facts.filter(fact_filter)
    f = f.filter(is_digits(code))
    r = (ranges.filter(is_digits(lb))
         .select(F.col(lb).try_cast("double").alias("_lo"), F.col(ub).try_cast("double").alias("_hi"), *carry)
         .filter(F.col("_hi").isNotNull() & (F.col("_hi") >= F.col("_lo"))))
    r = r.withColumn("_w", F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_hi") - F.col("_lo") + 1))))
    widths = r.agg(F.collect_set("_w").alias("_ws"))
    codes = attach_scalars(f.select(F.col(code).alias("_c")).distinct().withColumn("_v", F.col("_c").cast("double")), widths)
    codes = codes.withColumn("_w", F.explode("_ws")).withColumn("_b", F.floor(F.col("_v") / F.col("_w"))).drop("_ws")
    r = r.withColumn("_b", F.explode(F.array_distinct(F.array(F.floor(F.col("_lo") / F.col("_w")),
                                                              F.floor(F.col("_hi") / F.col("_w"))))))
    m = (codes.join(r, ["_w", "_b"]).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
         .select(F.col("_c").alias(code), *carry))
    return f.join(m, code)


def map_keyed(facts: DataFrame, arms: Sequence[tuple[str, Column, DataFrame]], type_col: str,
              out: str = "grp", dict_key: str = "code", grp: str = "grp") -> DataFrame:
    """Several exact mappings, one per code type, in a single join.

    ``arms`` = [(type value, key expression on the facts, dictionary)].  The
    key is one ``CASE`` on the type and the dictionaries are unioned with their
    type as a second join key, so the facts are read once and meet one
    equi-join whatever the number of arms (instead of one scan per UNION arm).
    """
    key = None
    dicts = []
    for tv, expr, d in arms:
        cond = F.col(type_col) == F.lit(tv)
        key = F.when(cond, expr) if key is None else key.when(cond, expr)
        dicts.append(d.select(F.lit(tv).alias(type_col), F.col(dict_key).alias("_k"), F.col(grp).alias(out)))
    dict_all = union_all(dicts).distinct()
    return facts.withColumn("_k", key).join(dict_all, [type_col, "_k"]).drop("_k")


def map_codes(facts: DataFrame, dictionary: DataFrame, how: str, fact_key: str, dict_key: str = "code",
              carry: Sequence[str] = ("grp",), fact_type: str | None = None, dict_type: Column | None = None,
              transform=None, ub: str = "ub") -> DataFrame:
    """One entry point for the three mapping kinds (J8-J12):
    ``how='exact'`` (optionally on ``transform(fact_key)``), ``'prefix'``
    (dictionary code is a prefix of the fact code) or ``'range'``
    (``dict_key`` / ``ub`` are the numeric bounds)."""
    if how == "exact":
        key = transform(F.col(fact_key)) if transform else F.col(fact_key)
        d = dictionary.select(F.col(dict_key).alias("_k"), *carry).distinct()
        f = facts.withColumn("_k", key)
        if fact_type is not None and dict_type is not None:
            d = dictionary.select(F.col(dict_key).alias("_k"), dict_type.alias(fact_type), *carry).distinct()
            return f.join(d, ["_k", fact_type]).drop("_k")
        return f.join(d, "_k").drop("_k")
    if how == "prefix":
        return map_prefix(facts, dictionary, fact_key, dict_key, fact_type, dict_type, carry)
    if how == "range":
        return map_range(facts, dictionary, fact_key, dict_key, ub, carry)
    raise ValueError(f"how must be exact, prefix or range; got {how!r}")


def group_dx(dx: DataFrame, dict10: DataFrame, dict9: DataFrame, code: str = "dx", type_col: str = "dx_type",
             out: str = "grp") -> DataFrame:
    """Diagnosis codes -> groups (C5): ICD-10 by dot-stripped code, ICD-9 by
    dot-stripped code right-padded to 5; one keyed join for both arms."""
    return map_keyed(dx, [("10", strip_dots(code), dict10), ("09", pad_right(strip_dots(code), 5), dict9)],
                     type_col, out)


def px_mapping(codes: DataFrame, ranges: DataFrame, dict9: DataFrame, dict10: DataFrame, code: str = "px",
               type_col: str = "px_type", out: str = "grp") -> DataFrame:
    """Distinct ``(type, code)`` -> group through the four alternative
    procedure mappings (C6, U2): numeric CPT range, single alphanumeric CPT
    code, ICD-9 (dots stripped), ICD-10 (exact)."""
    singles = ranges.filter(~is_digits("lb")).select(F.col("lb").alias("code"), "grp")
    exact = map_keyed(codes, [("CH", F.col(code), singles), ("09", strip_dots(code), dict9),
                              ("10", F.col(code), dict10)], type_col, out)
    rng = map_range(codes, ranges.withColumnRenamed("grp", out), code, carry=[out],
                    fact_filter=F.col(type_col) == "CH")
    return exact.select(type_col, code, out).unionByName(rng.select(type_col, code, out)).distinct()


def group_px(px: DataFrame, ranges: DataFrame, dict9: DataFrame, dict10: DataFrame, code: str = "px",
             type_col: str = "px_type", out: str = "grp",
             keep: Callable[[DataFrame, str], DataFrame] | None = None, codes: DataFrame | None = None,
             only: DataFrame | None = None) -> DataFrame:
    """Procedure facts -> groups: map the distinct codes (§4.3), join back once.
    ``keep`` writes the mapping first and ``codes`` are the facts' codes, as in
    :func:`map_prefix`.  ``only``: a list of groups (column ``out``, compared as
    strings); no other group is mapped, so that only facts on the list pass."""
    codes = (px if codes is None else codes).select(type_col, code).filter(F.col(code).isNotNull()).distinct()
    m = px_mapping(codes, ranges, dict9, dict10, code, type_col, out)
    if only is not None:
        wanted = only.select(F.col(out).cast("string").alias("_g")).distinct()
        m = m.join(wanted, F.col(out).cast("string") == F.col("_g"), "left_semi")
    if keep is not None:
        m = keep(m, "px-mapping")
    return px.join(m, [type_col, code])


def exclude_by_group(events: DataFrame, mapped: DataFrame, exclusions: DataFrame, id: str = "patid",
                     event: str = "encounterid", grp: str = "grp", excl_grp: str = "grp",
                     carry: Sequence[str] = ()) -> DataFrame:
    """Keys of events whose mapped group is on an exclusion list.
    Groups are compared as strings (H11).  The list cuts the mapped rows before
    they are made distinct and meet the events."""
    ex = exclusions.select(F.col(excl_grp).cast("string").alias("_g"), *carry).distinct()
    m = mapped.select(id, event, F.col(grp).cast("string").alias("_g"))
    # always true; not deterministic, so the optimizer does not move the join with the
    # events below the mapping and the list, where it shuffles and sorts every fact
    cut = m.join(ex, "_g").filter(F.spark_partition_id() >= 0)
    return (cut.distinct().join(by_key(events.select(id, event)), [id, event], "left_semi")
            .withColumnRenamed("_g", grp).select(id, event, grp, *carry))


def history_score(dx: DataFrame, prefix_dict: DataFrame, events: DataFrame, id: str = "patid",
                  event: str = "encounterid", code: str = "dx", code_type: str = "dx_type",
                  code_date: str = "dx_date", event_end: str = "discharge_date",
                  dict_code: str = "code", dict_type: str = "code_type", dict_grp: str = "code_grp",
                  score: str = "score", keep: Callable[[DataFrame, str], DataFrame] | None = None,
                  codes: DataFrame | None = None) -> DataFrame:
    """Comorbidity index per event (C10: J11 J14 A4).

    1. prefix-map diagnoses to comorbidity groups (type padded to 2 chars);
    2. per (person, group) the first history date and its score -- the first
       qualifying date for an event is this date whenever it is on or before
       the event end, so no event x history pairs are formed;
    3. join to events on the person (at most one row per event and group), and
       per event: sum of the group scores and the smallest days-to-end.
    Ties on the first date take the lowest score (the reference leaves it open).
    ``keep``, ``codes``: as in :func:`map_prefix`.
    """
    d = prefix_dict.select(F.col(dict_code).alias("code"), F.lpad(F.col(dict_type), 2, "0").alias("_t"),
                           F.col(dict_grp).alias("code_grp"), F.col(score).alias("score"))
    hist = map_prefix(dx.select(id, code, code_type, code_date), d, code, "code", fact_type=code_type,
                      dict_type=F.col("_t"), carry=["code_grp", "score"], keep=keep, codes=codes)
    first = (hist.groupBy(id, "code_grp")
             .agg(F.min(F.struct(F.col(code_date).alias("d"), F.col("score").alias("s"))).alias("_f")))
    ev = events.select(id, event, event_end)
    j = ev.join(by_key(first), id).filter(F.col("_f.d") <= F.col(event_end))
    return (j.groupBy(id, event)
            .agg(F.sum(F.col("_f.s")).cast("bigint").alias("score_total"),
                 F.min(F.datediff(F.col(event_end), F.col("_f.d"))).cast("bigint").alias("days_since_first")))
