from pyspark.sql import functions as F

from eventlink.operators import attributes
from tests.conftest import rows


def _long(spark):
    vals = ["0", "00", "007", "0.5", "-999", "12.6", "", "text", None, "2.5"]
    return spark.createDataFrame([(1, "V", v, "N", "S") for v in vals] + [(1, "C1", "a", "C", "S")],
                                 "patid long, var string, val string, type string, src string")


def test_encode_long_default_keeps_zeros_and_fractions(spark):
    out = attributes.encode_long(_long(spark))
    got = sorted(r.val for r in out.filter("var_orig = 'V'").collect())
    assert got == sorted([0.0, 7.0, 0.5, -999.0, 12.6, 2.5])  # "0" and "00" collapse (distinct)
    assert rows(out.filter("var_orig = 'C1'"), ["var", "val"]) == [("C1_a", 1.0)]


def test_encode_long_faithful_rounds_and_drops_zeros(spark):
    out = attributes.encode_long(_long(spark), faithful=True)
    got = sorted(r.val for r in out.filter("var_orig = 'V'").collect())
    assert got == sorted([7.0, 1.0, -999.0, 13.0, 3.0])


def test_attach_area_prefix_join_and_dry_run(spark):
    people = spark.createDataFrame([(1, "290010000011"), (2, "2900100000"), (3, "29")], "ctx_id long, block_group string")
    area = spark.createDataFrame([("29001000001", "x", "5"), ("290010000011", None, "7"), ("29001", "county", "1"),
                                  ("2900100000", "y", None)], "geocode string, area_class string, area_rank string")
    sel = {"AREA_CLASS": "C", "AREA_RANK": "N"}
    out = attributes.attach_area(people, {"A": area}, sel)
    assert rows(out, ["ctx_id", "geocode", "var", "val", "type"]) == sorted([
        (1, "29001000001", "AREA_CLASS", "x", "C"), (1, "29001000001", "AREA_RANK", "5", "N"),
        (1, "290010000011", "AREA_RANK", "7", "N"), (1, "2900100000", "AREA_CLASS", "y", "C"),
        (2, "2900100000", "AREA_CLASS", "y", "C")])
    plan = attributes.attach_area(people, {"A": area}, sel, dry_run=True)
    assert rows(plan) == [("A", "C", "area_class"), ("A", "N", "area_rank")]


def test_attach_person_skips_prec_columns(spark):
    people = spark.createDataFrame([(10, 1)], "patid long, ctx_id long")
    t = spark.createDataFrame([(1, "R", "X", None)], "ctx_id long, h_own string, h_own_prec string, h_len string")
    out = attributes.attach_person(people, {"P": t}, {"H_OWN": "C", "H_OWN_PREC": "C", "H_LEN": "N"})
    assert rows(out, ["patid", "var", "val"]) == [(10, "H_OWN", "R")]


def test_flag_attributes_one_pass(spark):
    people = spark.createDataFrame([(1,), (2,)], "patid long")
    rec = spark.createDataFrame([(1, "DUAL"), (1, "DUAL_X"), (2, "LIS"), (3, "DUAL")], "patid long, b string")
    out = attributes.flag_attributes(people, rec, {"D": F.col("b") == "DUAL", "DL": F.col("b").like("DUAL%")})
    assert rows(out, ["patid", "var"]) == [(1, "D"), (1, "DL")]
