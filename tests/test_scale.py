"""Plans of the steps whose tables grow with persons and events."""

import pytest

from eventlink.operators import codes, features
from eventlink.plans import pipeline, q_model
from eventlink.plans.pipeline import Pipeline
from eventlink.session import drop_materialized, materialize
from eventlink.sources.tables import Fixtures

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def staged(monkeypatch):
    """Name and plan of every stage that a pipeline writes."""
    plans = []

    def kept(df, name):
        plans.append((name, _plan(df)))
        return materialize(df, name)

    monkeypatch.setattr(pipeline, "materialize", kept)
    return plans


def test_line_facts_are_joined_once_each(spark, staged):
    """Dictionaries, exclusions, history and obesity read the written facts."""
    base = Pipeline(Fixtures(spark, SF)).base
    assert base.count() > 0
    drop_materialized(spark)
    names = [name for name, _ in staged]
    assert len(names) == len(set(names)) and {"fx_dx", "fx_px", "cohort", "admit", "linked", "eligible"} <= set(names)
    assert sum(plan.count("l_orderkey#") > 0 for _, plan in staged) == 2


@pytest.mark.parametrize("name", ["cohort_once", "admit", "person_long", "area_long", "flags"])
def test_person_tables_are_not_broadcast(spark, name):
    """The person side of these joins went to the driver while its files were small."""
    plan = _plan(getattr(Pipeline(Fixtures(spark, SF), materialize_stages=False), name))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_staged_events_are_not_broadcast(spark, staged):
    p = Pipeline(Fixtures(spark, SF))
    p.base
    plans = dict(staged)
    assert "BroadcastHashJoin [patid" not in plans["linked"] + plans["eligible"]
    keys = _plan(p.index_keys)
    drop_materialized(spark)
    assert "LeftSemi" in keys and "BroadcastHashJoin [patid" not in keys


def test_exclusions_of_repeated_facts_are_distinct(spark):
    events = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (None, 30)], "patid long, encounterid long")
    mapped = spark.createDataFrame([(1, 10, "7"), (1, 10, "7"), (2, 20, "8"), (3, 30, "7"), (None, 30, "7")],
                                   "patid long, encounterid long, grp string")
    lists = spark.createDataFrame([("7", "a"), ("7", "a"), ("7", "b")], "grp string, excl_type string")
    out = codes.exclude_by_group(events, mapped, lists, carry=["excl_type"])
    assert sorted(map(tuple, out.collect())) == [(1, 10, "7", "a"), (1, 10, "7", "b")]


def test_kept_mappings_give_the_same_rows(spark):
    fx = Fixtures(spark, SF)
    keep = lambda df, name: materialize(df, name)
    for args in ([fx.fx_px, fx.fx_ranges, fx.fx_pxdict9, fx.fx_pxdict10],):
        plain, kept = codes.group_px(*args), codes.group_px(*args, keep=keep)
        assert plain.exceptAll(kept).isEmpty() and kept.exceptAll(plain).isEmpty() and not kept.isEmpty()
    drop_materialized(spark)


def test_events_meet_the_facts_that_the_lists_leave(spark, staged):
    """The optimizer moved this join below the mapping, where every fact was shuffled for it."""
    p = Pipeline(Fixtures(spark, SF))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (p.index_keys, p.planned_keys)]
    drop_materialized(spark)
    for plan in plans:
        first, *arms = plan.split("Join LeftSemi")
        assert arms and "Join Inner" not in first and all("Join Inner" in arm for arm in arms)


@pytest.mark.parametrize("kind, key", [("area", "ctx_id"), ("person", "patid")])
def test_profiles_are_written_once(spark, staged, kind, key):
    p = Pipeline(Fixtures(spark, SF))
    p.feature_long(kind, impute=True)
    names = [name for name, _ in staged]
    assert names.count(f"weighted-{key}") == names.count(f"profile-{kind}") == 1
    plain = features.variable_profile(getattr(p, f"{kind}_long"), p.base, key)
    assert sorted(map(tuple, p.profiles[kind].collect())) == sorted(map(tuple, plain.collect()))
    drop_materialized(spark)


def test_gains_are_written_once(spark, staged):
    """Ranks and shadow each made the distinct rows of all features anew."""
    ranked = q_model.importance_rank(spark, SF)
    assert [name for name, _ in staged].count("gains") == 1 and "rowid" not in _plan(ranked)
    drop_materialized(spark)


def test_imputed_rows_leave_out_what_is_held(spark):
    """Of the features, those of variables without an imputation value go nowhere near the imputed rows."""
    rows = spark.createDataFrame([(1, 10, 100, 1), (2, 20, 200, 0), (3, None, 300, 0)],
                                 "rowid long, patid long, encounterid long, label int")
    attrs = spark.createDataFrame([(10, "n1", "n1", 5.0), (10, "c", "c_x", 1.0), (20, "c", "n1", 1.0), (None, "n2", "n2", 7.0)],
                                  "patid long, var_orig string, var string, val double")
    profile = spark.createDataFrame([("n1", 1.0, 3.0), ("n2", 1.0, 4.0), ("c", 1.0, None)], "var string, rt double, imp_val double")
    out = features.attribute_features(attrs, rows, profile, profile["rt"] > 0, "patid", impute=True)
    assert sorted(tuple(r)[0:1] + tuple(r)[4:] for r in out.collect()) == [
        (1, "c_x", 1.0), (1, "n1", 5.0), (1, "n2", 4.0), (2, "n1", 1.0), (2, "n2", 4.0), (3, "n1", 3.0), (3, "n2", 4.0)]


def test_sparse_rows_do_not_shuffle_for_the_index(spark):
    p = Pipeline(Fixtures(spark, SF))
    long = p.features_all
    encoder = materialize(features.numbered_keys(long, ["var"], "n").selectExpr("var", "concat('V', n) AS var3"), "encoder")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(features.sparse_rows(long, encoder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_materialized(spark)
    assert "BroadcastHashJoin [var" in plan and "SortMergeJoin" not in plan


def test_both_facts_read_one_join(spark, staged):
    """Diagnoses and procedures each joined lineitem and orders for themselves."""
    p = Pipeline(Fixtures(spark, SF))
    p.labelled()
    plans = dict(staged)
    assert "Join" not in plans["fx_dx"] + plans["fx_px"]
    plain = Fixtures(spark, SF)
    for name in ("fx_dx", "fx_px"):
        rows = lambda fx: sorted(map(str, fx.get(name).collect()))
        assert rows(p.fx) == rows(plain) != []
    drop_materialized(spark)


def test_mappings_read_the_distinct_codes(spark, monkeypatch):
    """Four dictionaries and both mappings each read the facts again, nine times in all."""
    read = {}

    def kept(df, name):
        read[name] = {f.rsplit("/", 2)[-2].rsplit("-", 1)[0] for f in df.inputFiles()}
        return materialize(df, name)

    monkeypatch.setattr(pipeline, "materialize", kept)
    p = Pipeline(Fixtures(spark, SF))
    p.labelled(), p.history
    assert {"fx_dict9", "fx_dict10", "fx_pxdict9", "fx_pxdict10", "px-mapping", "prefix-mapping"} <= set(read)
    assert sorted(name for name, of in read.items() if {"fx_dx", "fx_px"} & of and name != "eligible") == [
        "fx_dx-codes", "fx_px-codes"]
    plain = Fixtures(spark, SF)
    for name in ("fx_dict9", "fx_dict10", "fx_pxdict9", "fx_pxdict10"):
        rows = lambda fx: sorted(map(str, fx.get(name).collect()))
        assert rows(p.fx) == rows(plain) != []
    drop_materialized(spark)


def test_mapping_of_listed_groups(spark):
    px = spark.createDataFrame([(1, 10, "09", "1.1"), (1, 10, "09", "1.1"), (2, 20, "09", "2.2"), (None, 30, "09", "1.1"),
                                (3, 30, "CH", "105"), (3, 31, None, "105"), (4, 40, "CH", None)],
                               "patid long, encounterid long, px_type string, px string")
    ranges = spark.createDataFrame([("100", "110", "7"), ("100", "110", "5")], "lb string, ub string, grp string")
    nine = spark.createDataFrame([("11", "7"), ("22", "5"), ("11", None)], "code string, grp string")
    only = spark.createDataFrame([(7,), (7,), (None,)], "grp int")
    out = codes.group_px(px, ranges, nine, nine.limit(0), codes=px.select("px", "px_type"), only=only)
    whole = codes.group_px(px, ranges, nine, nine.limit(0)).filter("grp = '7'")
    rows = lambda df: sorted(map(str, df.select("patid", "encounterid", "px", "grp").collect()))
    assert rows(out) == rows(whole) and len(rows(out)) == 4


def test_linked_rows_hold_what_is_read(spark, staged):
    """Span, provider, censor and death dates and the next event's columns went through every shuffle."""
    p = Pipeline(Fixtures(spark, SF))
    assert sorted(p.linked.columns) == sorted(set(pipeline.LABEL_COLUMNS) - {"label"})
    whole = p.linked_carrying
    assert {"admit_date_lead", "enc_type_lead", "drg_lead", "provider_id_lead"} <= set(whole.columns)
    same = whole.select(*p.linked.columns)
    assert same.exceptAll(p.linked).isEmpty() and p.linked.exceptAll(same).isEmpty() and not same.isEmpty()
    drop_materialized(spark)
