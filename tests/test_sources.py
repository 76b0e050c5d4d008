import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from eventlink.operators import codes
from eventlink.sources import DeclaredTable, append_conform, build_once, read_lookup, read_sorted, write_sorted
from tests.conftest import rows


def test_read_lookup_multiline_quoted(spark):
    d = tempfile.mkdtemp(prefix="lookup-", dir="/tmp")
    p = os.path.join(d, "sel.csv")
    with open(p, "w") as f:
        f.write('VAR,VAR_LABEL,VAR_TYPE\nH_A,"label, with comma",C\nH_B,"two\nlines ""quoted""",N\n')
    schema = StructType([StructField("VAR", StringType()), StructField("VAR_LABEL", StringType()),
                         StructField("VAR_TYPE", StringType())])
    got = rows(read_lookup(spark, p, schema))
    assert got == [("H_A", "label, with comma", "C"), ("H_B", 'two\nlines "quoted"', "N")]


def test_append_conform_fills_and_casts(spark):
    a = spark.createDataFrame([("1", "x")], "ID string, v string")
    b = spark.createDataFrame([(2,)], "id int")
    schema = StructType([StructField("id", IntegerType()), StructField("v", StringType())])
    out = append_conform([a, b], schema)
    assert out.schema == schema and rows(out) == [(1, "x"), (2, None)]


def test_build_once_reuses(spark):
    path = tempfile.mkdtemp(prefix="once-", dir="/tmp") + "/t"
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert build_once(spark, path, build).count() == 3
    assert build_once(spark, path, build).count() == 3
    assert len(calls) == 1


def test_map_codes_dispatch(spark):
    facts = spark.createDataFrame([(1, "A1.2"), (2, "150")], "id long, c string")
    d = spark.createDataFrame([("A12", "e"), ("A1", "p")], "code string, grp string")
    ex = codes.map_codes(facts, d, "exact", "c", transform=lambda c: F.regexp_replace(c, r"\.", ""))
    assert rows(ex, ["id", "grp"]) == [(1, "e")]
    pr = codes.map_codes(facts, d, "prefix", "c")
    assert rows(pr, ["id", "grp"]) == [(1, "p")]
    r = spark.createDataFrame([("100", "199", "r")], "code string, ub string, grp string")
    assert rows(codes.map_codes(facts, r, "range", "c"), ["id", "grp"]) == [(2, "r")]


def test_catalog_from_data_lists_filled_columns(spark):
    from eventlink.operators import attributes
    a = spark.createDataFrame([("g1", "x", None), ("g2", None, None)], "geocode string, c1 string, c2 string")
    z = spark.createDataFrame([("k", "lbl")], "code string, description string")
    out = attributes.catalog_from_data({"A": (a, ["geocode"]), "Z_REF_X": (z, ["code"])},
                                       labels=spark.createDataFrame([("c1", "Column one")], "var string, var_label string"))
    assert rows(out, ["var_domain", "var", "var_label"]) == [("A", "C1", "Column one")]


def test_write_tables(spark):
    from eventlink.plans.run import write_tables
    out = tempfile.mkdtemp(prefix="tables-", dir="/tmp")
    done = write_tables(spark, "/root/testdata/sf0.001", out, ["coverage_span", "map_range"])
    assert done == ["coverage_span", "map_range"]
    assert spark.read.parquet(f"{out}/coverage_span").count() > 0


def test_drop_materialized(spark):
    from eventlink.session import _WRITTEN, drop_materialized, materialize
    before = len(_WRITTEN)
    m = materialize(spark.range(5), "tmp")
    assert m.count() == 5 and len(_WRITTEN) == before + 1
    path = _WRITTEN[-1]
    assert drop_materialized(spark) >= 1 and not _WRITTEN
    assert not os.path.exists(path.replace("file:", ""))


def test_declared_table_replaces_one_source(spark, tmp_path):
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    table = DeclaredTable(spark, f"file://{tmp_path}/t", schema)
    first = spark.createDataFrame([(1, "x"), (2, None)], "A int, b string")
    table.append("one", [first, first.select("A")])
    table.append("two", [spark.createDataFrame([("5",)], "a string")])
    both = lambda: sorted(map(str, [tuple(r) for r in table.read().collect()]))
    want = sorted(map(str, [(1, "x", "one"), (2, None, "one"), (1, None, "one"), (2, None, "one"), (5, None, "two")]))
    assert both() == want
    table.append("one", [first, first.select("A")])
    assert both() == want
    table.append("one", [first.limit(1)])
    assert both() == sorted(map(str, [(1, "x", "one"), (5, None, "two")]))
    assert table.read().dtypes == [("a", "bigint"), ("b", "string"), ("source", "string")]
    with pytest.raises(ValueError, match="partition"):
        DeclaredTable(spark, f"file://{tmp_path}/u", StructType([StructField("source", StringType())]))


def test_sorted_files(spark, tmp_path):
    """A hot key is cut over parts; the manifest's bounds do not overlap."""
    rows = [(7 if i % 3 else i, (i * 37) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, v long, id long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_sorted(df, f"file://{tmp_path}/s", ["k", F.desc("v"), "id"], ["k", "v"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted((r.pos, r.k, r.v, r.id) for r in read_sorted(spark, f"file://{tmp_path}/s").collect())
    assert [g[1:] for g in got] == sorted(rows, key=lambda r: (r[0], -r[1], r[2])) and [g[0] for g in got] == list(range(1, 1001))
    parts = sorted((r["_part"], r["n"], r["before"], tuple(r["first"]), tuple(r["last"]))
                   for r in spark.read.parquet(f"file://{tmp_path}/s/manifest").collect())
    assert sum(p[1] for p in parts) == 1000 and len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        assert a[2] + a[1] == b[2] and (a[4][0], -a[4][1]) <= (b[3][0], -b[3][1])
    write_sorted(df.limit(0), f"file://{tmp_path}/e", ["k"], ["k"])
    assert read_sorted(spark, f"file://{tmp_path}/e").count() == 0
