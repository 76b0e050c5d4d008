import datetime as dt

from pyspark.sql import functions as F

from eventlink.operators import events
from tests.conftest import rows

D = dt.date


def _events(spark, data):
    return spark.createDataFrame(data, "patid long, encounterid long, admit_date date, discharge_date date, "
                                       "censor_date date, death_date date")


def test_link_next_event_gaps(spark):
    c = D(2021, 12, 31)
    data = [
        (1, 1, D(2020, 1, 1), D(2020, 1, 5), c, None),    # next on day -1 (overlap) -> dropped
        (1, 2, D(2020, 1, 4), D(2020, 1, 4), c, None),    # stay 0 -> los 1; next same day as discharge (gap 0)
        (1, 3, D(2020, 1, 4), D(2020, 1, 10), c, None),   # gap 1
        (1, 4, D(2020, 1, 11), D(2020, 1, 11), c, None),  # gap 30
        (1, 5, D(2020, 2, 10), D(2020, 2, 12), c, None),  # gap 31
        (1, 6, D(2020, 3, 14), None, c, None),            # NULL end
        (2, 7, D(2020, 5, 1), D(2020, 5, 3), c, D(2020, 5, 20)),  # single event
    ]
    out = events.link_next_event(_events(spark, data))
    got = {r.encounterid: (r.encounterid_lead, r.days_to_next, r.los) for r in out.collect()}
    assert 1 not in got                      # gap -1 removed after linking (H4)
    assert 2 not in got                      # gap 0 removed
    assert got[3] == (4, 1, 6)
    assert got[4] == (5, 30, 1)
    assert got[5] == (6, 31, 2)
    assert got[6] == (None, None, 1)
    assert got[7] == (None, None, 2)
    d7 = out.filter("encounterid = 7").first()
    assert d7.days_to_death == 17 and d7.days_to_censor == (c - D(2020, 5, 3)).days


def test_link_ties_broken_by_event_id(spark):
    c = D(2021, 12, 31)
    data = [(1, 20, D(2020, 1, 1), D(2020, 1, 2), c, None), (1, 10, D(2020, 1, 1), D(2020, 1, 2), c, None),
            (1, 30, D(2020, 3, 1), D(2020, 3, 2), c, None)]
    out = events.link_next_event(_events(spark, data), drop_nonpositive_gap=False)
    got = {r.encounterid: r.encounterid_lead for r in out.collect()}
    assert got == {10: 20, 20: 30, 30: None}


def _brute_lookback(days):
    out = {}
    for p, d in days:
        lo = _minus_months(d, 12)
        n = len({e for q, e in days if q == p and lo <= e < d})
        out[(p, d)] = n or None
    return out


def _minus_months(d, m):
    y, mo = divmod(d.year * 12 + d.month - 1 - m, 12)
    mo += 1
    import calendar
    return D(y, mo, min(d.day, calendar.monthrange(y, mo)[1]))


def test_lookback_count_matches_self_join(spark):
    days = [(1, D(2020, 2, 29)), (1, D(2019, 2, 28)), (1, D(2019, 2, 27)), (1, D(2019, 6, 1)), (1, D(2019, 6, 1)),
            (1, D(2021, 2, 28)), (1, D(2020, 2, 29)), (2, D(2020, 1, 1)), (2, D(2019, 1, 1)), (2, D(2018, 12, 31)),
            (3, D(2020, 5, 5))]
    df = spark.createDataFrame([(p, i, d) for i, (p, d) in enumerate(days)], "patid long, encounterid long, admit_date date")
    out = events.lookback_count(df)
    want = _brute_lookback(days)
    for r in out.collect():
        assert r.n_prior_12m == want[(r.patid, r.admit_date)], r


def _linked(spark, data):
    return spark.createDataFrame(data, "patid long, encounterid long, encounterid_lead long, days_to_next long, "
                                       "days_to_censor long, days_to_death long, discharge_status string, "
                                       "discharge_disposition string")


def test_eligible_readmissions_modes(spark):
    data = [
        (1, 1, 2, 10, 400, None, "HO", "A"),     # next (2) is planned
        (1, 2, 3, 40, 390, None, "HO", "A"),
        (1, 3, None, None, 300, 10, "HO", "A"),  # terminal, death in 10 days -> excluded by follow-up rule
        (2, 4, 5, 5, 100, None, "HO", None),     # NULL disposition -> dropped (NOT IN)
        (2, 5, None, None, 20, None, "HO", "A"),  # follow-up 20 <= 30 -> dropped
        (3, 6, 7, 3, 200, None, "AM", "A"),      # against advice
        (3, 7, None, None, 180, None, "HO", "A"),
        (4, 8, 9, 15, 300, None, "HO", "A"),     # readmitted in 15 days, next not planned -> 1
        (4, 9, None, None, 285, None, "HO", "A"),
    ]
    linked = _linked(spark, data)
    planned = spark.createDataFrame([(1, 2), (1, 2)], "patid long, encounterid long")  # duplicate key
    index = spark.createDataFrame([(3, 7)], "patid long, encounterid long")
    down = {r.encounterid: r.label for r in events.eligible_readmissions(linked, index, planned).collect()}
    assert down == {1: 0, 2: 0, 8: 1, 9: 0}
    drop = {r.encounterid: r.label for r in events.eligible_readmissions(linked, index, planned, planned="drop").collect()}
    assert drop == {2: 0, 8: 1, 9: 0}


def test_attrition_counts_each_rule(spark):
    df = spark.createDataFrame([(1, 1, "AM"), (1, 2, "AM"), (2, 3, "EX"), (3, 4, "HO")],
                               "patid long, encounterid long, s string")
    out = events.attrition(df, {"am": F.col("s") == "AM", "bad": F.col("s").isin("AM", "EX")})
    assert rows(out, ["rule", "persons", "events"]) == [("am", 1, 2), ("bad", 2, 3)]


def test_coverage_span_bounds(spark):
    a = spark.createDataFrame([(1, D(2009, 1, 1), D(2011, 1, 1)), (1, D(2012, 1, 1), D(2021, 1, 1))],
                              "patid long, start date, end date")
    b = spark.createDataFrame([(1, D(2015, 5, 5), D(2015, 5, 5)), (2, D(2008, 1, 1), D(2008, 1, 1))],
                              "patid long, start date, end date")
    out = events.coverage_span([a, b], lo="2010-01-01", hi="2019-12-31")
    assert rows(out) == [(1, D(2009, 1, 1), D(2015, 5, 5))]


def test_coverage_span_with_one_bound(spark):
    a = spark.createDataFrame([(1, D(2009, 1, 1), D(2011, 1, 1)), (1, D(2012, 1, 1), D(2021, 1, 1))],
                              "patid long, start date, end date")
    assert rows(events.coverage_span([a], lo="2012-01-01")) == [(1, D(2012, 1, 1), D(2021, 1, 1))]
    assert rows(events.coverage_span([a], hi="2012-01-01")) == [(1, D(2009, 1, 1), D(2011, 1, 1))]
    assert rows(events.coverage_span([a])) == [(1, D(2009, 1, 1), D(2021, 1, 1))]


def test_skew_safe_linkage_equals_window_form_with_hot_person(spark):
    import random
    rnd = random.Random(11)
    c = D(2022, 12, 31)
    data = []
    eid = 0
    for p in range(60):
        n = 300 if p == 0 else rnd.randint(1, 8)   # person 0 holds about a third of all rows
        for _ in range(n):
            eid += 1
            a = D(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 900))
            data.append((p, eid, a, a + dt.timedelta(days=rnd.randint(0, 9)), c, None))
    df = _events(spark, data).repartition(7)
    for fn in (lambda s: events.link_next_event(df, skew_safe=s),
               lambda s: events.running_stats(df, skew_safe=s),
               lambda s: events.running_stats(df.withColumn("w", F.expr("if(encounterid % 4 = 0, null, encounterid % 7)")),
                                              counter="w", skew_safe=s),
               lambda s: events.sequence_index(df, skew_safe=s),
               lambda s: events.merge_sources_relink({"a": df.filter("encounterid % 3 = 0"),
                                                      "b": df.filter("encounterid % 3 > 0")}, skew_safe=s)):
        one, other = fn(False), fn(True)
        key = lambda df: sorted(str([r[c] for c in sorted(df.columns)]) for r in df.collect())
        assert sorted(one.columns) == sorted(other.columns) and key(one) == key(other)
