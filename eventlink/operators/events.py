"""Event-sequence operators: coverage spans, cohorts, next-event linkage,
trailing-window counts, running statistics, eligibility/labels, attrition and
merged-source relinking (§2.11 C1-C4, C8, C9, C22).

Partitioning: every window here is keyed by the person id.  Windows that share
``partitionBy``/``orderBy`` are evaluated in one shuffle and one sort; the
trailing-window count runs on distinct (person, day) pairs, so a person with a
huge number of events contributes at most one row per calendar day to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import age_years, days_between, least_strict, stay_length
from .ranks import by_key, numbered_rows, positioned, segmented_cumsum


# Admission encounter types, and discharge statuses / dispositions
# that exclude an index event (died, against advice, transfers).
ADMISSION_TYPES = ("IP", "EI")
EXCLUDED_STATUS = ("AM", "EX", "IP", "SH")
EXCLUDED_DISPOSITION = ("E",)


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def coverage_span(sources: Sequence[DataFrame], id: str = "patid", start: str = "start",
                  end: str = "end", lo: str | None = None, hi: str | None = None,
                  out_start: str = "enr_start", out_end: str = "enr_end") -> DataFrame:
    """Per-person coverage span over several sources (C1: A1 A2 P3).

    Each source has ``(id, start, end)``.  Rows whose ``end`` falls outside the
    administrative window ``[lo, hi]`` (either bound may be left out) are
    dropped first (pushed into each scan), then one ``groupBy`` takes min(start)/max(end): Spark computes the
    per-source partial aggregates map-side before the single shuffle.
    """
    parts = []
    for s in sources:
        d = s.select(F.col(id), F.col(start).cast("date").alias("_s"), F.col(end).cast("date").alias("_e"))
        if lo is not None:
            d = d.filter(F.col("_e") >= F.lit(lo).cast("date"))
        if hi is not None:
            d = d.filter(F.col("_e") <= F.lit(hi).cast("date"))
        parts.append(d)
    return (union_all(parts).groupBy(id)
            .agg(F.min("_s").alias(out_start), F.max("_e").alias(out_end)))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              tie: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order`` then ``tie``.

    ``row_number() == 1`` is planned by Spark as a window group limit, which is
    applied map-side before the shuffle, so a hot key ships one row per task.
    """
    ob = [F.col(o) if isinstance(o, str) else o for o in list(order) + list(tie)]
    w = Window.partitionBy(*keys).orderBy(*ob)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def build_cohort(people: DataFrame, span: DataFrame, crosswalk: DataFrame, measure: DataFrame | None = None,
                 id: str = "patid", link_key: str = "ctx_id", birth: str = "birth_date",
                 measure_type: str = "measure_type", measure_value: str = "measure_num",
                 measure_date: str = "measure_date", qualifying: tuple[str, float, float] = ("BMI", 30, 200),
                 min_age: int | None = 18, person_cols: Sequence[str] = ("sex", "race", "hispanic"),
                 enr_start: str = "enr_start", enr_end: str = "enr_end") -> DataFrame:
    """One row per person with span, age at span start and first qualifying
    measurement (C2: W1 J1 J3 W2 C1).

    Inner joins through the crosswalk keep only persons with a context id; the
    first qualifying measurement is a left join to first-row-per-person.
    """
    cols = [id, birth, *person_cols]
    base = (people.select(*cols)
            .join(by_key(span.select(id, enr_start, enr_end)), id)
            .join(by_key(crosswalk.select(id, link_key)), id))
    if measure is not None:
        kind, lo, hi = qualifying
        firsts = first_per(
            measure.filter((F.col(measure_type) == F.lit(kind)) & F.col(measure_value).between(lo, hi))
            .select(id, F.col(measure_value).alias("first_value"), F.col(measure_date).alias("first_date")),
            [id], ["first_date"], ["first_value"])
        base = base.join(by_key(firsts), id, "left")
    base = (base.withColumn("age_at_enr_start", age_years(birth, enr_start))
            .withColumn("enr_dur", days_between(enr_start, enr_end)))
    if min_age is not None:
        base = base.filter(F.col("age_at_enr_start") >= F.lit(min_age))
    return first_per(base, [id], ["enr_dur"], [link_key])


def admissions(span: DataFrame, encounters: DataFrame, death: DataFrame | None = None,
               id: str = "patid", admit: str = "admit_date", types: Iterable[str] = ADMISSION_TYPES,
               type_col: str = "enc_type", enr_start: str = "enr_start", enr_end: str = "enr_end",
               death_date: str = "death_date") -> DataFrame:
    """Hospital admissions inside each person's coverage span, with censor and
    death dates attached (EHR admissions step: J1 J2 P4 P5)."""
    enc = encounters.filter(F.col(type_col).isin(list(types)))
    a = (by_key(span.select(id, enr_start, enr_end)).join(enc, id)
         .filter(F.col(admit).between(F.col(enr_start), F.col(enr_end)))
         .withColumn("censor_date", F.col(enr_end)))
    if death is not None:
        a = a.join(by_key(death.select(id, death_date)), id, "left")
    return a


def link_next_event(events: DataFrame, id: str = "patid", event: str = "encounterid",
                    start: str = "admit_date", end: str = "discharge_date",
                    carry: Sequence[str] = (), censor: str | None = "censor_date",
                    death: str | None = "death_date", drop_nonpositive_gap: bool = True,
                    skew_safe: bool = False) -> DataFrame:
    """Link each event to the next one of the same person (C3: W4 P11).

    One ``lead(struct(...))`` over one window replaces a lead per column.  Ties
    on ``start`` are broken by ``event`` (H3).  Adds ``<c>_lead`` for the event
    id, start and every carried column, ``los``, ``days_to_next``,
    ``days_to_censor`` and ``days_to_death``.  Rows whose next event starts on
    or before their end are removed *after* linking, as the reference does
    (H4): the successor keeps its link and no gap is recomputed.

    ``skew_safe=True`` avoids the person-keyed window, whose hash partitioning
    puts all events of one person into one task: rows are range partitioned in
    (person, start, event) order, so a hot person spans many partitions, and
    linked inside them (:func:`ranks.positioned`).  ``(person, start, event)``
    must be unique.
    """
    lead_cols = [event, start, *carry]
    if skew_safe:
        out = positioned(events, [id, start, event], [id, *lead_cols])
        out = out.withColumn("_nxt", F.when(F.col("_next")[id] == F.col(id), F.col("_next"))).drop("_next", "_pos", "_p")
    else:
        w = Window.partitionBy(id).orderBy(F.col(start), F.col(event))
        out = events.withColumn("_nxt", F.lead(F.struct(*lead_cols)).over(w))
    out = _gaps(out, lead_cols, start, end, censor, death)
    return out.filter(_has_gap()) if drop_nonpositive_gap else out


def _gaps(linked: DataFrame, lead_cols: Sequence[str], start: str, end: str, censor: str | None,
          death: str | None) -> DataFrame:
    """The struct ``_nxt`` of the next event as columns, and the day differences."""
    out = linked.select("*", *[F.col("_nxt")[c].alias(f"{c}_lead") for c in lead_cols]).drop("_nxt")
    out = (out.withColumn("los", stay_length(start, end))
           .withColumn("days_to_next", days_between(end, f"{start}_lead")))
    if censor:
        out = out.withColumn("days_to_censor", days_between(end, censor))
    if death:
        out = out.withColumn("days_to_death", days_between(end, death))
    return out


def _has_gap() -> Column:
    return (F.col("days_to_next") > 0) | F.col("days_to_next").isNull()


def lookback_count(events: DataFrame, id: str = "patid", day: str = "admit_date", months: int = 12,
                   out: str = "n_prior_12m", history: DataFrame | None = None) -> DataFrame:
    """Number of distinct earlier days of the same person within the trailing
    ``months`` (``[day - months, day)``), NULL when there is none (C4: J13 W6).

    Instead of the quadratic self-join, a RANGE window runs over distinct
    (person, day) pairs -- at most one row per person-day -- and is joined back.
    ``history`` (default: ``events``) supplies the earlier days counted.
    """
    src = events if history is None else history
    days = src.select(id, F.col(day).cast("date").alias("_day")).distinct()
    cnt = F.expr(
        f"count(1) OVER (PARTITION BY `{id}` ORDER BY _day "
        f"RANGE BETWEEN INTERVAL '{int(months)}' MONTH PRECEDING AND CURRENT ROW)") - F.lit(1)
    days = days.withColumn(out, F.when(cnt > 0, cnt.cast("bigint")))
    return (events.withColumn("_day", F.col(day).cast("date"))
            .join(by_key(days), [id, "_day"], "left").drop("_day"))


def running_stats(events: DataFrame, id: str = "patid", event: str = "encounterid",
                  start: str = "admit_date", counter: str | None = None, skew_safe: bool = False) -> DataFrame:
    """Per-person total of distinct event days (W7), running count in event
    order (W8).  ``count(distinct) over`` is not a Spark window, so the total is
    an aggregate joined back on the person key (partial aggregation first).
    ``counter``: a column summed up in place of 1, null counting nothing.
    ``skew_safe=True`` takes the running number from global positions minus the
    person's first one, or for a counter from sums over all persons that start
    anew at each (:func:`ranks.segmented_cumsum`): no window per person."""
    totals = events.groupBy(id).agg(F.countDistinct(start).alias("n_days_total"))
    if skew_safe and counter is None:
        out = sequence_index(events, id, event, start, "running_n", skew_safe=True)
    elif skew_safe:
        weighed = events.withColumn("_w", F.coalesce(F.col(counter), F.lit(0)).cast("bigint"))
        out = segmented_cumsum(weighed, [id], [start, event], ["_w"]).withColumnRenamed("_w_cum", "running_n")
    else:
        w = Window.partitionBy(id).orderBy(F.col(start), F.col(event))
        c = F.coalesce(F.col(counter), F.lit(0)) if counter else F.lit(1)
        out = events.withColumn("running_n", F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
                                .cast("bigint"))
    return out.join(totals, id, "left").select(*events.columns, "running_n", "n_days_total")


def sequence_index(events: DataFrame, id: str = "patid", event: str = "encounterid",
                   start: str = "admit_date", out: str = "seq", skew_safe: bool = False) -> DataFrame:
    """1-based position of each event within its person (W5).  ``skew_safe``:
    global position minus the person's first position (a per-person ``min``,
    aggregated map-side) instead of a person-keyed window."""
    if skew_safe:
        e = numbered_rows(events, [id, start, event])
        first = e.groupBy(id).agg(F.min("_pos").alias("_first"))
        return (e.join(first, id).withColumn(out, (F.col("_pos") - F.col("_first") + 1).cast("bigint"))
                .select(*events.columns, out))
    w = Window.partitionBy(id).orderBy(F.col(start), F.col(event))
    return events.withColumn(out, F.row_number().over(w).cast("bigint"))


def eligible_readmissions(linked: DataFrame, index_keys: DataFrame | None, planned_keys: DataFrame | None,
                          id: str = "patid", event: str = "encounterid", horizon: int = 30,
                          planned: str = "downgrade",
                          bad_status: Iterable[str] = EXCLUDED_STATUS,
                          bad_disposition: Iterable[str] = EXCLUDED_DISPOSITION,
                          status: str = "discharge_status", disposition: str = "discharge_disposition",
                          count_death: bool = False, label: str = "label") -> DataFrame:
    """Apply the exclusion rules and label a readmission within ``horizon``
    days (C8: P6 P12 J5 J6 J7).

    * follow-up: ``least_strict(coalesce(to_death, to_censor), to_censor) > horizon``
      (``count_death=True`` drops the death term, H9);
    * bad discharge disposition / status (NOT IN: a NULL value drops the row);
    * index events with an excluded group: anti join on (person, event);
    * planned follow-up: ``planned='drop'`` anti-joins on the *next* event's key
      (a NULL next key is kept, as NOT EXISTS does); ``'downgrade'`` keeps the
      row and labels it 0 via a left join to the *distinct* planned keys (H7).
    """
    h = F.lit(horizon)
    follow = (F.col("days_to_censor") if count_death
              else least_strict(F.coalesce(F.col("days_to_death"), F.col("days_to_censor")), F.col("days_to_censor")))
    keep = ((follow > h)
            & ~F.col(disposition).isin(list(bad_disposition))
            & ~F.col(status).isin(list(bad_status)))
    df = linked.filter(keep)
    if index_keys is not None:
        df = df.join(index_keys.select(id, event), [id, event], "left_anti")
    lead = f"{event}_lead"
    terminal = F.col(lead).isNull() & (F.col("days_to_death") <= h)
    if planned_keys is None:
        lab = (F.col("days_to_next") <= h) | terminal
    elif planned == "drop":
        pk = planned_keys.select(id, F.col(event).alias(lead))
        df = df.join(pk, [id, lead], "left_anti")
        lab = (F.col("days_to_next") <= h) | terminal
    elif planned == "downgrade":
        pk = planned_keys.select(id, F.col(event).alias(lead)).distinct().withColumn("_planned", F.lit(True))
        df = df.join(pk, [id, lead], "left")
        lab = ((F.col("days_to_next") <= h) & F.col("_planned").isNull()) | terminal
    else:
        raise ValueError(f"planned must be 'drop' or 'downgrade', got {planned!r}")
    return (df.withColumn(label, F.when(F.coalesce(lab, F.lit(False)), 1).otherwise(0))
            .drop("_planned"))


def attrition(events: DataFrame, rules: Mapping[str, Column], person: str = "patid",
              event: str = "encounterid") -> DataFrame:
    """Distinct persons and events meeting each rule, each counted separately
    (C9: A13).  One pass: rows are tagged with every rule they meet, then one
    ``groupBy(rule)`` counts distinct ids (partial aggregation on (rule, id))."""
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    tagged = (events.select(person, event, F.explode(tags).alias("rule"))
              .filter(F.col("rule").isNotNull()))
    return tagged.groupBy("rule").agg(F.countDistinct(person).alias("persons"),
                                      F.countDistinct(event).alias("events"))


def group_attrition(keys: DataFrame, group: str, person: str = "patid", event: str = "encounterid") -> DataFrame:
    """Distinct persons and events per exclusion group."""
    return (keys.groupBy(F.col(group).alias("rule"))
            .agg(F.countDistinct(person).alias("persons"), F.countDistinct(event).alias("events")))


def merge_sources_relink(sources: Mapping[str, DataFrame], id: str = "patid", event: str = "encounterid",
                         start: str = "admit_date", end: str = "discharge_date", carry: Sequence[str] = (),
                         censor: str | None = "censor_date", death: str | None = "death_date",
                         src: str = "src", skew_safe: bool = False) -> DataFrame:
    """Union several event sources (tagged, aligned by name; H6) and link them
    as one sequence: next event, per-person distinct-day total, running count
    and position (C22: U4 C3 W7 W8)."""
    tagged = [df.withColumn(src, F.lit(name)) for name, df in sources.items()]
    merged = union_all(tagged, allow_missing=True)
    if not skew_safe:
        stats = running_stats(merged, id, event, start)
        linked = link_next_event(stats, id, event, start, end, carry=[*carry, src], censor=censor, death=death)
        return sequence_index(linked, id, event, start)
    # One numbering gives the link, the running count and, by the running number
    # of the rows that are kept, the position among them.
    lead_cols = [event, start, *carry, src]
    rows = positioned(merged, [id, start, event], [id, *lead_cols])
    rows = rows.withColumn("_nxt", F.when(F.col("_next")[id] == F.col(id), F.col("_next"))).drop("_next")
    rows = _gaps(rows, lead_cols, start, end, censor, death).withColumn("_kept", _has_gap().cast("bigint"))
    inside = Window.partitionBy("_p").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = rows.groupBy("_p").agg(F.sum("_kept").alias("_k")).select(
        "_p", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_koff"))
    rows = rows.withColumn("_kcum", F.sum("_kept").over(inside)).join(F.broadcast(parts), "_p")
    rows = rows.withColumn("_kcum", F.col("_kcum") + F.col("_koff"))
    per = rows.groupBy(id).agg(F.min("_pos").alias("_first"), F.min(F.col("_kcum") - F.col("_kept")).alias("_kfirst"),
                               F.countDistinct(start).alias("n_days_total"))
    out = rows.filter("_kept = 1").join(per, id)
    return (out.withColumn("running_n", F.col("_pos") - F.col("_first") + 1)
            .withColumn("seq", (F.col("_kcum") - F.col("_kfirst")).cast("bigint"))
            .drop("_p", "_pos", "_kept", "_kcum", "_koff", "_first", "_kfirst"))
