import random

import numpy as np

from eventlink.operators import ranks


def test_surrogate_id_dense_and_partition_independent(spark):
    data = [(p, e) for p in range(40) for e in range(p % 5)] * 2  # duplicates share an id
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "patid long, encounterid long")
    want = {k: i + 1 for i, k in enumerate(sorted(set(data)))}
    for parts in (1, 3, 8):
        got = ranks.numbered_keys(df.repartition(parts), ["patid", "encounterid"], partitions=parts).collect()
        assert {(r.patid, r.encounterid): r.rowid for r in got} == want


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = {"a": rng.normal(size=301), "b": np.array([1.0, 30.0]), "c": np.array([5.0]), "d": np.repeat(2.0, 50)}
    data = [(g, float(v)) for g, arr in vals.items() for v in arr]
    df = spark.createDataFrame(data, "g string, v double")
    q = ranks.exact_quantiles(df, ["g"], "v", {"q025": 0.025, "q5": 0.5, "q975": 0.975})
    for r in q.collect():
        arr = vals[r.g]
        assert r.n == len(arr)
        for name, p in (("q025", 0.025), ("q5", 0.5), ("q975", 0.975)):
            assert abs(r[name] - np.quantile(arr, p)) < 1e-9


def test_global_cumsum(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(50)], "score double, x long")
    out = ranks.global_cumsum(df, ["score"], ["x"], descending=True).collect()
    by = {r.score: r.x_cum for r in out}
    acc = 0
    for i in reversed(range(50)):
        acc += i % 3
        assert by[float(i)] == acc


def test_exact_quantiles_hot_group_spans_partitions(spark):
    rng = np.random.default_rng(9)
    hot = rng.integers(0, 50, 900).astype(float)          # many ties in the hot group
    data = [("hot", float(v)) for v in hot]
    cold = {f"g{i}": rng.random(30) for i in range(60)}
    data += [(g, float(v)) for g, arr in cold.items() for v in arr]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    q = {r.g: r for r in ranks.exact_quantiles(df, ["g"], "v", {"m": 0.5, "q9": 0.9}).collect()}
    assert abs(q["hot"].m - np.quantile(hot, 0.5)) < 1e-12 and abs(q["hot"].q9 - np.quantile(hot, 0.9)) < 1e-12
    for g, arr in cold.items():
        assert abs(q[g].m - np.quantile(arr, 0.5)) < 1e-12


def test_surrogate_id_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (2, 5), (None, 1)], "patid long, encounterid long")
    got = sorted((r.rowid, r.patid, r.encounterid) for r in ranks.surrogate_id(df, ["patid", "encounterid"]).collect())
    assert got == [(1, None, 1), (1, None, 1), (2, 2, None), (3, 2, 5)]


def test_weighted_quantiles_are_those_of_repeated_values(spark):
    data = [("a", "3", 2), ("a", "1", 5), ("a", "10", 1), ("a", "x", 9), (None, "4", 3), (None, "8", 3)]
    df = spark.createDataFrame(data, "g string, v string, w long")
    got = {r.g: (r.n, r.m, r.q9) for r in ranks.exact_quantiles(df, ["g"], "v", {"m": 0.5, "q9": 0.9}, weight="w").collect()}
    for g in ("a", None):
        arr = np.repeat([float(v) for k, v, _ in data if k == g and v != "x"], [w for k, v, w in data if k == g and v != "x"])
        assert got[g] == (len(arr), np.quantile(arr, 0.5), np.quantile(arr, 0.9))
