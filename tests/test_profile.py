import math

from eventlink.operators import profile


def test_entropy_single_value_and_two_values(spark):
    data = [(1, "A", "x"), (2, "A", "x"), (3, "A", "x"),              # one value only -> ee2 = 0
            (1, "B", "p"), (2, "B", "q"), (3, "B", "q"), (3, "B", "p")]  # id 3 has two values
    df = spark.createDataFrame(data, "id long, var string, val string")
    out = {r.var: r for r in profile.entropy_profile(df, id="id").collect()}
    assert out["A"].ee2 == 0 and abs(out["A"].pe) < 1e-12
    # B: N=3, var_n=3, p(p)=2/3, p(q)=2/3
    p = 2 / 3
    assert abs(out["B"].ee2 - 2 * p * math.log(1 / p)) < 1e-12
    assert abs(math.exp(out["B"].pe) - 2) < 1e-12
    sparse = {r.var: r for r in profile.entropy_profile(df, id="id", absent_is_level=True).collect()}
    assert sparse["A"].ee3 == sparse["A"].ee1 and abs(math.exp(sparse["A"].pe) - 2) < 1e-12
    assert sparse["B"].ee3 == sparse["B"].ee2


def test_univariate_summary(spark):
    df = spark.createDataFrame([(1, "AGE", "10", "N"), (2, "AGE", "20", "N"), (3, "AGE", "40", "N"),
                                (1, "SEX", "F", "C"), (2, "SEX", "F", "C"), (3, "SEX", "M", "C")],
                               "rowid long, var string, val string, type string")
    out = {(r.var, r.level): r for r in profile.univariate_summary(df).collect()}
    a = out[("AGE", None)]
    assert a.n == 3 and abs(a.mean - 70 / 3) < 1e-12 and a.median == 20 and a.q1 == 15 and a.q3 == 30
    assert out[("SEX", "F")].n == 2 and abs(out[("SEX", "F")].pct - 2 / 3) < 1e-12


def test_pivot_fill(spark):
    df = spark.createDataFrame([(1, "A", "x"), (1, "B", "y"), (2, "A", "z")], "id long, var string, val string")
    out = {r.id: (r.A, r.B) for r in profile.pivot_fill(df, "id", "var", "val", ["A", "B"]).collect()}
    assert out == {1: ("x", "y"), 2: ("z", "NI")}


def test_univariate_summary_labels(spark):
    df = spark.createDataFrame([(1, "AGE", "10", "N"), (2, "SEX", "F", "C")], "rowid long, var string, val string, type string")
    lab = spark.createDataFrame([("AGE", "Age in years")], "var string, var_label string")
    out = {r.var: r.var_label for r in profile.univariate_summary(df, labels=lab).collect()}
    assert out == {"AGE": "Age in years", "SEX": "SEX"}


def test_univariate_summary_passes_over_text_in_a_number(spark):
    df = spark.createDataFrame([("V", "1", "N"), ("V", "x", "N"), ("V", "3", "N")], "var string, val string, type string")
    r = profile.univariate_summary(df).first()
    assert (r.n, r.mean, r.median) == (2, 2.0, 2.0)


def test_labels_are_the_first_of_several(spark):
    df = spark.createDataFrame([("V", "1", "N")], "var string, val string, type string")
    lab = spark.createDataFrame([("V", "zeta"), ("V", "alpha")], "var string, var_label string")
    assert profile.univariate_summary(df, labels=lab.repartition(3)).first().var_label == "alpha"
