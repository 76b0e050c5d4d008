"""Many area tables, names with several entries, effects of the top variables."""

import math

import pytest
from pyspark.sql import functions as F

from eventlink.operators import attributes, evaluate, features
from tests.conftest import rows

TABLES = {
    ("S1", "BLOCKS"): ([("290010000011", "BG", 5, "a"), ("290010000012", "BG", None, "b"), (None, "BG", 9, "z")],
                       "geocode string, geo_accuracy string, x int, y string"),
    ("S1", "TRACTS"): ([("29001000001", 7, "t"), ("29001", 1, "county")], "geocode string, x int, y string"),
    ("S2", "EMPTY"): ([], "geocode string, x int"),
    ("S2", "UNASKED"): ([("29001000001", 1)], "geocode string, q int"),
}
CHOSEN = {("S1", "BLOCKS"): {"X": "N", "Y": "C"}, ("S1", "TRACTS"): {"X": "N"}, ("S2", "EMPTY"): {"X": "N"}}


def _tables(spark):
    return {k: spark.createDataFrame(*v) for k, v in TABLES.items()}


def _people(spark):
    return spark.createDataFrame([(1, "290010000011"), (2, "290010000012"), (3, "29001000001"), (4, None), (5, "29"),
                                  (6, "290010000011")], "patid long, block_group string")


def _brute(people):
    out = []
    for who, group in people:
        for (schema, name), (data, ddl) in TABLES.items():
            cols = [c.split()[0] for c in ddl.split(", ")]
            for r in (dict(zip(cols, d)) for d in data):
                code = r["geocode"]
                if group is None or len(group) < 10 or code is None or len(code) < 10 or not group.startswith(code):
                    continue
                out += [(who, code, r.get("geo_accuracy"), var, str(r[var.lower()]), kind, schema)
                        for var, kind in CHOSEN.get((schema, name), {}).items() if r[var.lower()] is not None]
    return sorted(out, key=repr)


def test_attach_areas_against_every_pair(spark):
    people = _people(spark)
    got = attributes.attach_areas(people, _tables(spark), CHOSEN)
    assert got.columns == ["patid", "geocode", "geo_accuracy", "var", "val", "type", "src"]
    assert sorted(map(tuple, got.collect()), key=repr) == _brute([tuple(r) for r in people.collect()])


def test_attach_areas_joins_once_whatever_the_number_of_tables(spark):
    made = attributes.attach_areas(_people(spark), _tables(spark), CHOSEN)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join " in line for line in plan.splitlines()) == 2  # areas to codes, persons to their block group


def test_attach_areas_column_plan_and_nothing_selected(spark):
    plan = attributes.attach_areas(_people(spark), _tables(spark), CHOSEN, dry_run=True)
    assert rows(plan) == [("S1.BLOCKS", "C", "y"), ("S1.BLOCKS", "N", "x"), ("S1.TRACTS", "N", "x"), ("S2.EMPTY", "N", "x")]
    with pytest.raises(ValueError):
        attributes.attach_areas(_people(spark), _tables(spark), {})


def _names(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "none"), (5, "a")], "id long, var string")
    once = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), ("c", "C2"), (None, "N")], "var string, lbl string")
    return left, once


def test_join_names_many_to_one_leaves_unasked_names_alone(spark):
    left, names = _names(spark)  # "c" has two entries that no row asks for
    assert rows(features.join_names(left, names, "var")) == [(1, "a", "A"), (2, "b", "B"), (5, "a", "A")]
    kept = features.join_names(left, names, "var", how="left")
    assert sorted(kept.collect()) == [(1, "a", "A"), (2, "b", "B"), (3, None, None), (4, "none", None), (5, "a", "A")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_names_many_to_one_names_the_offender(spark, how):
    left, names = _names(spark)
    asked = left.unionByName(spark.createDataFrame([(9, "c")], left.schema))
    # the check stays although the labels themselves are not read
    with pytest.raises(Exception, match="several entries for c"):
        features.join_names(asked, names, "var", how=how).select("id").collect()


def test_join_names_many_to_many_keeps_every_match(spark):
    left, names = _names(spark)
    asked = left.unionByName(spark.createDataFrame([(9, "c"), (8, "c")], left.schema))
    got = features.join_names(asked, names, "var", "many-to-many").select("id", "lbl")
    assert rows(got) == [(1, "A"), (2, "B"), (5, "A"), (8, "C"), (8, "C2"), (9, "C"), (9, "C2")]
    with pytest.raises(ValueError):
        features.join_names(left, names, "var", "one-to-one")


def test_variable_encoder_both_relationships(spark):
    names = spark.createDataFrame([("P_X_1",), ("AGE",), ("AGE",)], "var string")
    words = spark.createDataFrame([("P_X", "first", "PERSON"), ("P_X", "second", "PERSON"), ("AGE", None, "BASE")],
                                  "var string, var_label string, var_domain string")
    with pytest.raises(Exception, match="several entries for P_X"):
        features.variable_encoder(names, words).collect()
    got = features.variable_encoder(names, words, relationship="many-to-many")
    assert rows(got, ["var", "var_lbl", "var3"]) == [("AGE", "AGE", "V1"), ("P_X_1", "first", "V2"), ("P_X_1", "second", "V2")]
    long = spark.createDataFrame([(1, "P_X_1", 3.0), (1, "AGE", 2.0)], "rowid long, var string, val double")
    assert [tuple(r) for r in features.sparse_rows(long, got).collect()] == [(1, [0, 1], [2.0, 3.0])]


def test_top_effects_cuts_each_model_and_keeps_ties(spark):
    effects = spark.createDataFrame(
        [(m, v, 1.0, e) for m in ("a", "b") for v in ("x", "y", "z") for e in (0.0, 1.0, 2.0, None)],
        "model string, var string, val double, effect double")
    gains = spark.createDataFrame([("a", "x", 9.0), ("a", "y", 5.0), ("a", "z", 1.0), ("b", "x", 1.0), ("b", "y", 4.0),
                                   ("b", "z", 4.0)], "model string, var string, gain double")
    labels = spark.createDataFrame([("x", "EX", "D1"), ("y", None, "D2"), ("z", "ZED", None)],
                                   "var string, var_lbl string, var_domain_type string")
    ranked = evaluate.importance_rank(gains, labels, by=["model"])
    got = evaluate.top_effects(effects, ranked, k=2)
    assert rows(got, ["model", "var", "n", "feat_rank", "rank"]) == [
        ("a", "x", 3, "001.EX", 1.0), ("a", "y", 3, "002.y", 2.0), ("b", "y", 3, "1.5.y", 1.5), ("b", "z", 3, "1.5.ZED", 1.5)]
    assert all(math.isclose(r.eff_m, math.e) for r in got.collect())
    inside = evaluate.top_effects(effects, ranked, k=2, bounds={"y": (None, 0.5)})
    assert rows(inside, ["model", "var"]) == [("a", "x"), ("b", "z")]
    assert evaluate.top_effects(effects.filter(F.lit(False)), ranked, k=2).count() == 0
