from pyspark.sql import functions as F

from eventlink.functions import columns as C


def test_least_strict_null_if_any_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None), (5, 3)], "a int, b int")
    got = [r[0] for r in df.select(C.least_strict("a", "b")).collect()]
    assert got == [1, None, None, None, 3]
    # Spark's own least skips NULLs: that is exactly the difference (H1).
    assert [r[0] for r in df.select(F.least("a", "b")).collect()] == [1, 2, 1, None, 3]


def test_group_code_normaliser(spark):
    df = spark.createDataFrame([("0100",), ("7",), ("100 ",), ("011",), (None,), ("00012",)], "c string")
    got = [r[0] for r in df.select(C.group_code("c")).collect()]
    assert got == ["100", "007", "100", "011", None, "12"]


def test_recode_first_and_any(spark):
    df = spark.createDataFrame(
        [(None, None), ("05", None), (None, "03"), ("UN", "05"), ("09", None), ("NI", None)], "d string, b string")
    got = [r[0] for r in df.select(C.recode_first(["d", "b"], {"05": "WH", "03": "AA"})).collect()]
    assert got == ["NI", "WH", "AA", "NI", "OT", "NI"]
    h = spark.createDataFrame([(None, None), ("N", "Y"), ("N", None), (None, "X")], "d string, b string")
    assert [r[0] for r in h.select(C.recode_any(["d", "b"])).collect()] == ["NI", "Y", "N", "NI"]


def test_not_sentinel_and_digits(spark):
    df = spark.createDataFrame([("UN",), (" ",), (None,), ("Y",), (" NI ",)], "c string")
    assert [r[0] for r in df.select(C.not_sentinel("c")).collect()] == [False, False, False, True, False]
    d = spark.createDataFrame([("123",), ("12a",), ("dig",), ("",)], "c string")
    assert [r[0] for r in d.select(C.is_digits("c")).collect()] == [True, False, False, False]


def test_clip_bucket(spark):
    df = spark.createDataFrame([(None,), (0,), (2,), (4,), (9,)], "c int")
    got = [r[0] for r in df.select(C.clip_bucket("c", edges=[(1, 2, "A"), (3, 4, "B"), (5, None, "C")],
                                                 default="Z")).collect()]
    assert got == ["Z", "Z", "A", "B", "C"]
    assert [r[0] for r in df.select(C.clip_bucket("c", cap=6)).collect()] == [None, 0, 2, 4, 6]


def test_stay_and_days(spark):
    df = spark.createDataFrame([("2020-01-01", "2020-01-01"), ("2020-01-01", "2020-01-04"), ("2020-01-01", None)],
                               "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert [r[0] for r in df.select(C.stay_length("a", "b")).collect()] == [1, 3, 1]
    assert [r[0] for r in df.select(C.days_between("a", "b")).collect()] == [0, 3, None]
