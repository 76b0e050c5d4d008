import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlink.operators import evaluate, reports
from eventlink.operators.ranks import segmented_cumsum


def _scores(spark, n=300, seed=7):
    """Three models of their own sizes, with ties, a model of one class and rows without a score."""
    rng = np.random.default_rng(seed)
    rows = [("a", i, int(rng.random() < 0.4), float(np.round(rng.random(), 2))) for i in range(n)]
    rows += [("b", i, int(rng.random() < i / n), i / n) for i in range(n // 2)]
    rows += [(None, i, i % 2, float(i % 5)) for i in range(20)]
    rows += [("one", i, 1, 0.5) for i in range(4)] + [("a", 1000, 1, None)]
    return rows, spark.createDataFrame(rows, "model string, id long, actual int, pred double")


def _of(rows, m):
    return [(y, s) for k, _, y, s in rows if k == m and s is not None]


def test_segmented_cumsum(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 4 == 0 else f"g{i % 3}", i, int(rng.integers(0, 9)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k long, v long, pos long")
    got = {r.k: (r.v_cum, r.v_total) for r in segmented_cumsum(df.repartition(5), ["g"], ["k"], ["v"]).collect()}
    assert got == {k: (sum(v for g2, k2, v, _ in rows if g2 == g and k2 <= k), sum(v for g2, _, v, _ in rows if g2 == g))
                   for g, k, _, _ in rows}
    down = {r.k: r.v_cum for r in segmented_cumsum(df, ["g"], ["k"], ["v"], descending=True).collect()}
    assert down == {k: sum(v for g2, k2, v, _ in rows if g2 == g and k2 >= k) for g, k, _, _ in rows}
    assert segmented_cumsum(df.limit(0), ["g"], ["k"], ["v"]).count() == 0


def test_measures_of_each_model(spark):
    rows, df = _scores(spark)
    got = {(r.model, r.cutoff, r.meas): (r.meas_val_m, r.meas_val_lb, r.meas_val_ub) for r in reports.perf_at(df).collect()}
    want = {}
    for m in ("a", "b", None, "one"):
        of = _of(rows, m)
        for c in {s for _, s in of}:
            tp, fp = sum(y for y, s in of if s >= c), sum(1 - y for y, s in of if s >= c)
            p, n = sum(y for y, _ in of), sum(1 - y for y, _ in of)
            for name, x, t in (("rec_sens", tp, p), ("spec", n - fp, n), ("prec", tp, tp + fp), ("npv", n - fp, n - fp + p - tp)):
                if t:
                    want[m, c, name] = x / t
    assert {k: v[0] for k, v in got.items()} == pytest.approx(want)
    assert all(-1e-12 <= lb <= v + 1e-12 and v - 1e-12 <= ub <= 1 for v, lb, ub in got.values())


def test_one_pass_equals_one_model_at_a_time(spark):
    rows, df = _scores(spark)
    summ = {(r.model, r.overall_meas): r for r in reports.perf_summ(df).collect()}
    for m in ("a", "b"):
        one = evaluate.roc_auc(df.filter(F.col("model") == m)).first()
        r = summ[m, "roauc"]
        assert (r.meas_val_m, r.meas_val_lb, r.meas_val_ub) == pytest.approx((one.auc, one.auc_lb, one.auc_ub))
        assert summ[m, "prauc1"].meas_val_m == pytest.approx(one.pr_auc)
    assert summ["one", "roauc"].meas_val_m is None and summ["one", "roauc"].meas_val_lb is None
    assert summ["one", "prauc1"].meas_val_m == 1 and summ["one", "prev"].meas_val_m == 1
    alone = reports.perf_summ(df.filter("model = 'a'").drop("model"), by=[])
    assert {r.overall_meas: r.meas_val_lb for r in alone.collect()}["prauc1"] == pytest.approx(summ["a", "prauc1"].meas_val_lb)


def test_interval_of_the_pr_area_is_that_of_resampling(spark):
    """The influence values give the spread that resampling within the classes gives."""
    rng = np.random.default_rng(3)
    y = (rng.random(600) < 0.3).astype(int)
    s = np.round(y * 0.4 + rng.random(600), 3)
    df = spark.createDataFrame([("m", i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))],
                               "model string, id long, actual int, pred double")
    r = next(x for x in reports.perf_summ(df).collect() if x.overall_meas == "prauc1")

    def area(pos, neg):
        at = np.sort(pos)
        tp, fp = (len(x) - np.searchsorted(np.sort(x), at, "left") for x in (pos, neg))
        return np.mean(tp / (tp + fp))

    pos, neg = s[y == 1], s[y == 0]
    drawn = [area(rng.choice(pos, len(pos)), rng.choice(neg, len(neg))) for _ in range(2000)]
    assert r.meas_val_m == pytest.approx(area(pos, neg))
    assert (r.meas_val_ub - r.meas_val_m) / evaluate.Z95 == pytest.approx(np.std(drawn), rel=0.1)


def test_calibration_of_each_model(spark):
    rows, df = _scores(spark)
    for n_bin in (10, 7):
        bins = reports.calibration(df.filter("model = 'a'"), n_bin)
        one = evaluate.calibration_bins(df.filter("model = 'a'"), n_bin)
        key = lambda r: (r.bin, r.n, round(r.y_p, 9), round(r.pred_p, 9))
        assert sorted(map(key, bins.collect())) == sorted(map(key, one.collect()))
        got, want = reports.calibration_tests(bins).first(), evaluate.calibration_test(one).first()
        assert (got.statistics, got.dof, got.pval) == pytest.approx((want.statistics, n_bin - 2, want.pval))


def test_odd_degrees_of_freedom(spark):
    """Known quantiles of the chi-square distribution."""
    known = [(3.841458820694124, 1, 0.05), (7.814727903251179, 3, 0.05), (24.995790139728616, 15, 0.05), (0.0, 3, 1.0),
             (14.067140449340169, 7, 0.05), (3000.0, 5, 0.0), (0.454936423119572, 1, 0.5)]
    df = spark.createDataFrame(known, "x double, k long, want double")
    for r in df.select(evaluate.chi2_upper_tail(F.col("x"), F.col("k")).alias("got"), "want").collect():
        assert r.got == pytest.approx(r.want, abs=1e-9)


def test_stratified_draws(spark, monkeypatch):
    """Every replicate has P positives and N negatives, however the blocks are cut;
    the counts follow the multinomial; the same seed gives the same band."""
    rows, df = _scores(spark)
    a = df.filter("model in ('a', 'b')")
    seen = []
    real = reports._seeded

    class Spy:
        def __init__(self, rng):
            self.rng = rng

        def multinomial(self, n, p):
            x = self.rng.multinomial(n, p)
            seen.append((n, int(x.sum()), len(x)))
            return x

    monkeypatch.setattr(reports, "_seeded", lambda *k: Spy(real(*k)))
    one = reports.stratified_band(a, reps=40, points=9, block=16).collect()
    monkeypatch.undo()
    again = reports.stratified_band(a.repartition(3), reps=40, points=9, block=16).collect()
    assert sorted(one) == sorted(again) and len(one) == 18
    for m in ("a", "b"):
        band = sorted((r.x, r.sens_lb, r.sens_m, r.sens_ub) for r in one if r.model == m)
        assert [x for x, *_ in band] == pytest.approx(np.linspace(0, 1, 9))
        assert all(lo <= mid <= hi for _, lo, mid, hi in band)
        assert [mid for _, _, mid, _ in band] == sorted([mid for _, _, mid, _ in band], reverse=True)
        assert band[0][2] == 1.0  # at specificity 0 all positives are found, since the class totals are fixed


def test_stratified_band_against_direct_resampling(spark):
    rows, df = _scores(spark, 400)
    of = _of(rows, "a")
    got = sorted((r.x, r.sens_lb, r.sens_m, r.sens_ub) for r in
                 reports.stratified_band(df.filter("model = 'a'"), reps=400, points=5, block=8).collect())
    rng = np.random.default_rng(9)
    pos, neg = (np.array([s for y, s in of if y == k]) for k in (1, 0))
    curves = []
    for _ in range(400):
        p, n = rng.choice(pos, len(pos)), rng.choice(neg, len(neg))
        cut = np.unique(np.append(np.concatenate([p, n]), 9))
        spec, sens = np.array([(n < c).mean() for c in cut]), np.array([(p >= c).mean() for c in cut])
        curves.append([sens[spec >= x - 1e-9].max() for x in np.linspace(0, 1, 5)])
    want = np.quantile(curves, [0.025, 0.5, 0.975], axis=0).T
    assert np.abs(np.array([g[1:] for g in got]) - want).max() < 0.06


def test_empty(spark):
    df = spark.createDataFrame([], "model string, id long, actual int, pred double")
    for f in (reports.perf_at, reports.perf_summ, reports.roc_points, reports.calibration, reports.stratified_band):
        assert f(df).count() == 0
