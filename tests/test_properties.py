"""Property tests: fast join forms equal brute force on random inputs;
entropy invariants (exp(pe) is an integer, ee2 <= pe, ee3 rule)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlink.operators import codes, profile

ALPHA = st.text(alphabet="AB1._%", min_size=0, max_size=5)


@settings(max_examples=8, deadline=None)
@given(facts=st.lists(st.tuples(ALPHA, st.sampled_from(["09", "10"])), min_size=1, max_size=12),
       dict_=st.lists(st.tuples(st.text(alphabet="AB1._%", min_size=1, max_size=3), st.sampled_from(["9", "10"])),
                      min_size=1, max_size=6))
def test_prefix_mapping_equals_like(spark, facts, dict_):
    f = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(facts)], "id long, c string, t string")
    d = spark.createDataFrame([(c, t, f"g{j}") for j, (c, t) in enumerate(dict_)], "code string, ct string, grp string")
    d = d.withColumn("_t", F.lpad("ct", 2, "0"))
    fast = codes.map_prefix(f, d, "c", "code", fact_type="t", dict_type=F.col("_t"), carry=["grp"])
    got = sorted((r.id, r.grp) for r in fast.collect())
    import re
    want = []
    for i, (c, t) in enumerate(facts):
        for j, (code, ct) in enumerate(dict_):
            pat = "^" + "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in code) + ".*$"
            if t == ct.rjust(2, "0") and re.match(pat, c, re.S):
                want.append((i, f"g{j}"))
    assert got == sorted(want)


@settings(max_examples=8, deadline=None)
@given(vals=st.lists(st.integers(0, 400), min_size=1, max_size=15),
       ranges=st.lists(st.tuples(st.integers(0, 400), st.integers(0, 120)), min_size=1, max_size=5))
def test_range_mapping_equals_between(spark, vals, ranges):
    f = spark.createDataFrame([(i, str(v)) for i, v in enumerate(vals)], "id long, px string")
    r = spark.createDataFrame([(str(lo), str(lo + w), f"r{j}") for j, (lo, w) in enumerate(ranges)],
                              "lb string, ub string, grp string")
    got = sorted((x.id, x.grp) for x in codes.map_range(f, r, "px").collect())
    want = sorted((i, f"r{j}") for i, v in enumerate(vals) for j, (lo, w) in enumerate(ranges) if lo <= v <= lo + w)
    assert got == want


def test_entropy_invariants(spark):
    rows = [(i, f"V{i % 4}", str((i * 7) % (1 + i % 5))) for i in range(200)]
    rows += [(i, "ONE", "x") for i in range(0, 200, 3)]
    df = spark.createDataFrame(rows, "id long, var string, val string")
    for sparse in (False, True):
        for r in profile.entropy_profile(df, id="id", absent_is_level=sparse).collect():
            assert abs(math.exp(r.pe) - round(math.exp(r.pe))) < 1e-9
            assert r.ee2 <= r.pe + 1e-12
            if sparse:
                assert r.ee3 == (r.ee1 if r.ee2 == 0 else r.ee2)
