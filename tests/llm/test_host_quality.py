import re
from collections import Counter

import duckdb
from frames import SF, docs, table

from eventlink.llm import oracles
from eventlink.llm.host_quality import host_quality, keep_quality


def slow_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


CASES = [None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a a", "x\nx\n\nx \n y", "é ü#*$ <b>&|%", "same line\nsame line\r\nsame line",
         "   x", "a\x1cb", " ".join(f"w{i}" for i in range(60)), "spam " * 80, " ".join(f"w{i % 40}" for i in range(120)),
         "word " * 20_000]


def test_measures_equal_brute_force(spark):
    rows = [(i, t, "h") for i, t in enumerate(CASES)] + [(None, "a b a b a b", None), (1, "dup", "h"), (1, "dup", "h")]
    df = docs(spark, rows, extra=("n_words", "failed", "kept", "host", "_m", "row"))
    got = sorted((tuple(r)[:6] for r in host_quality(df).collect()), key=str)
    assert got == sorted(((i, *slow_measures(t)) for i, t, _ in rows), key=str)
    for r in host_quality(df).collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert host_quality(df.limit(0)).count() == 0
    kept = keep_quality(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in host_quality(df).collect() if r["kept"])


def test_verdicts_of_hosts(spark):
    good = [" ".join(f"g{i}w{j}" for j in range(60)) for i in range(40)]
    rows = [(i, t, "good") for i, t in enumerate(good)]
    rows += [(100 + i, "short text", "bad") for i in range(60)] + [(200, good[0], "bad")]
    rows += [(300, "short text", "small"), (301, good[1], "small"), (302, good[2], None), (303, "short", None)]
    got = {r["doc_id"]: r["kept"] for r in host_quality(docs(spark, rows)).collect()}
    assert all(got[i] for i in range(40)), "clean documents of a clean host stay"
    assert not got[200], "a clean document of a host that fails goes"
    assert got[301] and not got[300], "one failure does not make a host"
    assert got[302] and not got[303]


def test_oracle_on_the_smallest_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(oracles.HOST_QUALITY).fetchall()
    assert sorted(tuple(r) for r in host_quality(table(spark, "documents")).collect()) == sorted(want)
