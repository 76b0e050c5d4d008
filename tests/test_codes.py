from pyspark.sql import functions as F

from eventlink.operators import codes
from tests.conftest import rows


def test_prefix_join_equals_like(spark):
    facts = spark.createDataFrame(
        [(1, "E11.9", "10"), (2, "E1", "10"), (3, "E", "10"), (4, "E119", "09"), (5, "X_1", "10"), (6, "XA1", "10"),
         (7, None, "10"), (8, "A%B", "10"), (9, "AZB", "10")], "id long, dx string, t string")
    d = spark.createDataFrame(
        [("E1", "10", "g1"), ("E11", "10", "g2"), ("E119", "9", "g3"), ("E11.9", "10", "g4"), ("X_", "10", "w1"),
         ("A%", "10", "w2"), ("E1", "9", "g5")], "code string, code_type string, grp string")
    d = d.withColumn("_t", F.lpad("code_type", 2, "0"))
    fast = codes.map_prefix(facts, d, "dx", "code", fact_type="t", dict_type=F.col("_t"), carry=["code", "grp"])
    facts.createOrReplaceTempView("f_t")
    d.createOrReplaceTempView("d_t")
    literal = spark.sql("SELECT f.id, f.dx, f.t, d.code, d.grp FROM f_t f JOIN d_t d "
                        "ON f.dx LIKE d.code || '%' AND f.t = d._t")
    cols = ["id", "dx", "t", "code", "grp"]
    assert rows(fast, cols) == rows(literal, cols)
    assert len(rows(literal, cols)) == 10


def test_range_join_bounds_inclusive(spark):
    facts = spark.createDataFrame([(1, "100"), (2, "149"), (3, "150"), (4, "99"), (5, "0123"), (6, "12a"),
                                   (7, "5000")], "id long, px string")
    ranges = spark.createDataFrame([("100", "149", "a"), ("120", "130", "b"), ("4000", "60000", "c"),
                                    ("x10", "x20", "z"), ("150", "1T", "bad")], "lb string, ub string, grp string")
    out = codes.map_range(facts, ranges, "px")
    assert rows(out, ["id", "grp"]) == [(1, "a"), (2, "a"), (5, "a"), (5, "b"), (7, "c")]


def test_range_join_of_a_wide_range(spark):
    """A range is in two buckets at most, however wide it is."""
    facts = spark.createDataFrame([(1, "0"), (2, "999999999999"), (3, "1000000000001")], "id long, px string")
    ranges = spark.createDataFrame([("0", "1000000000000", "wide"), ("0", "0", "one")], "lb string, ub string, grp string")
    assert rows(codes.map_range(facts, ranges, "px"), ["id", "grp"]) == [(1, "one"), (1, "wide"), (2, "wide")]


def test_prefix_of_empty_codes_is_like(spark):
    words = ["", "a", "ab", "a%", "b_c", "bxc1"]
    facts = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, code string")
    d = spark.createDataFrame([(w, f"g{w}") for w in ["", "a", "a%", "%c", "b_c", "_"]], "code string, grp string")
    fast = codes.map_prefix(facts, d, "code")
    literal = facts.alias("f").join(d.alias("d"), F.expr("f.code LIKE concat(d.code, '%')")).select("f.id", "f.code", "d.grp")
    assert rows(fast, ["id", "code", "grp"]) == rows(literal)


def test_group_px_arms(spark):
    px = spark.createDataFrame([(1, 1, "CH", "10010"), (1, 1, "CH", "G0011"), (1, 2, "09", "45.1"),
                                (1, 3, "10", "0123ZZ1"), (1, 4, "10", "nomatch")],
                               "patid long, encounterid long, px_type string, px string")
    ranges = spark.createDataFrame([("10000", "10149", "r0"), ("G0011", "G0011", "s1")], "lb string, ub string, grp string")
    d9 = spark.createDataFrame([("451", "p9")], "code string, grp string")
    d10 = spark.createDataFrame([("0123ZZ1", "p10")], "code string, grp string")
    out = codes.group_px(px, ranges, d9, d10)
    assert rows(out, ["encounterid", "px", "grp"]) == [(1, "10010", "r0"), (1, "G0011", "s1"), (2, "45.1", "p9"),
                                                        (3, "0123ZZ1", "p10")]


def test_group_dx_transformed_keys(spark):
    dx = spark.createDataFrame([(1, "10", "A01.1"), (2, "09", "123.4"), (3, "09", "12.3"), (4, "10", "A011")],
                               "id long, dx_type string, dx string")
    d10 = spark.createDataFrame([("A011", "x")], "code string, grp string")
    d9 = spark.createDataFrame([("12340", "y"), ("12300", "z")], "code string, grp string")
    out = codes.group_dx(dx, d10, d9)
    assert rows(out, ["id", "grp"]) == [(1, "x"), (2, "y"), (3, "z"), (4, "x")]


def test_history_score_first_per_group(spark):
    import datetime as dt
    D = dt.date
    dx = spark.createDataFrame([(1, "A10.1", "10", D(2020, 1, 1)), (1, "A10.2", "10", D(2019, 1, 1)),
                                (1, "B20", "10", D(2020, 6, 1)), (1, "A10", "10", D(2021, 1, 1))],
                               "patid long, dx string, dx_type string, dx_date date")
    d = spark.createDataFrame([("A10", "10", "ga", 2), ("B2", "10", "gb", 3)],
                              "code string, code_type string, code_grp string, score int")
    ev = spark.createDataFrame([(1, 100, D(2020, 3, 1)), (1, 101, D(2020, 7, 1)), (1, 102, D(2018, 1, 1))],
                               "patid long, encounterid long, discharge_date date")
    out = codes.history_score(dx, d, ev)
    got = {r.encounterid: (r.score_total, r.days_since_first) for r in out.collect()}
    assert got == {100: (2, (D(2020, 3, 1) - D(2019, 1, 1)).days), 101: (5, 30)}
