import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from frames import SF, docs

from eventlink.llm import oracles
from eventlink.llm.winnow import contamination, drop_contaminated, sliding_min

BIG = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(BIG))


def slow(rows, items):
    spots = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            spots.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(s) for s in spots}:
            for i in range(len(w) - n + 1):
                if ids := spots.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fast(spark, rows, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = contamination(docs(spark, rows, extra=("digest", "start", "h", "win", "n_hit")), bench, **kw).drop("digest")
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 1000, 200).astype(np.uint64)
    for w in range(1, 14):
        assert sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(len(x) - w + 1)]


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(5)
    some = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 2, 4, 7, 12, 13, 14, 30])))) for i in range(25)]
    items += [(3, items[4][1]), (90, items[5][1]), (None, "null id item words"), (91, None), (92, "!?")]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices([f"w{j}" for j in range(9)], k=rng.randint(0, 30)))]
        if i % 2:
            parts += [rng.choice(items)[1] or "", "Ünïcode W1 w2"]
        rows.append((i, " ".join(parts)))
    assert fast(spark, rows, items) == slow(rows, items)


def test_edge_cases(spark):
    passage = " ".join(f"alpha{i}" for i in range(13))
    items = [(1, passage), (10, passage + " tail"), (2, "short one"), (2, "short one")]
    rows = [(1, None), (2, ""), (3, "--- ..."), (4, passage.upper().replace(" ", ", ")), (4, passage), (4, passage),
            (None, f"x {passage} y"), (None, "SHORT-one"), (5, " ".join(f"alpha{i}" for i in range(12))),
            (6, "z " * 60_000 + passage)]
    assert fast(spark, rows, items) == slow(rows, items)
    assert fast(spark, rows, []) == slow(rows, [])
    assert fast(spark, [], items) == []
    df = docs(spark, rows, extra=("row",))
    kept = drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    bad = {x[0] for x in slow(rows, items) if x[-1]}
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 6]
    assert bad == {4, None}


def test_oracle_on_the_smallest_tables(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(oracles.CONTAMINATION).fetchall()
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    got = [tuple(r) for r in contamination(read("documents"), read("benchmark")).drop("digest").collect()]
    assert sorted(got) == sorted(want)
    assert any(r[-1] for r in got)


@pytest.mark.parametrize("copies", [300])
def test_a_passage_in_every_row(spark, copies):
    passage = " ".join(f"beta{i}" for i in range(40))
    rows = [(i, f"start{i} {passage} end{i}") for i in range(copies)]
    items = [(i, passage) for i in range(50)]
    assert fast(spark, rows, items) == slow(rows, items)


def test_a_very_long_item(spark):
    """An item of 20,000 words; its windows cost no more than its words."""
    rng = random.Random(8)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    items = [(1, " ".join(long)), (2, " ".join(long[:13])), (3, "short one")]
    rows = [(1, " ".join(long[700:760])), (2, " ".join(long[:40]) + " a short one"), (3, " ".join(long[9000:9012])), (4, " ".join(long))]
    assert fast(spark, rows, items) == slow(rows, items)
