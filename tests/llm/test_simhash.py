import random

import numpy as np
import pytest
import xxhash
from frames import docs, table, texts

from eventlink.llm.components import components
from eventlink.llm.simhash import _walk, fingerprint, keep_first, links, simhash_groups


def slow_print(text):
    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints, distance=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    some = sorted(root)
    for i, a in enumerate(some):
        for b in some[:i]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in some}


def partition(pairs):
    found = {}
    for node, name in pairs:
        found.setdefault(name, set()).add(node)
    return {frozenset(v) for v in found.values()}


def test_fingerprint_equals_brute_force():
    for text in ["", " \n", "one", "One two", "a b c d", "a b c d e f g A B", "Straße über Öl " * 40]:
        assert fingerprint((text or "").encode()) == slow_print(text)


def near(rng, center, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        center ^= 1 << b
    return center


@pytest.mark.parametrize("distance,node_rows", [(4, 2_000_000), (4, 60), (3, 40), (6, 50)])
def test_links_equal_brute_force(spark, distance, node_rows):
    rng = random.Random(distance * node_rows)
    centers = [rng.getrandbits(64) for _ in range(6)]
    prints = {near(rng, c, 7) for c in centers for _ in range(60)} | {rng.getrandbits(64) for _ in range(200)} | {0, 1, 2 ** 63}
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = links(spark.createDataFrame(rows, "fp long"), distance, node_rows)
    unsigned = lambda x: x % (1 << 64)
    edges = [(unsigned(r["u"]), unsigned(r["v"])) for r in got.collect()]
    assert all(0 < (a ^ b).bit_count() <= distance for a, b in edges)
    want = {g for g in partition(slow_groups(prints, distance).items()) if len(g) > 1}
    roots = components(got)
    assert partition((unsigned(r["node"]), r["root"]) for r in roots.collect()) == want


def test_walk_of_a_dense_node():
    rng = random.Random(1)
    center = rng.getrandbits(64)
    values = np.array(sorted({near(rng, center, 5) for _ in range(900)}), np.uint64)
    own = np.ones(len(values), bool)
    found = _walk(values, own, 4)
    assert len(found) <= len(values) - 1
    for a, b in found:
        assert (a ^ b).bit_count() <= 4
    parent = {int(x): int(x) for x in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[find(a)] = find(b)
    assert partition((x, find(x)) for x in parent) == partition(slow_groups([int(x) for x in values]).items())


def test_documents_equal_brute_force(spark):
    rows = texts(spark)
    prints = {i: slow_print(t) for i, t in rows}
    roots = slow_groups(set(prints.values()))
    low = {}
    for i, p in prints.items():
        low[roots[p]] = min(i, low.get(roots[p], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_groups(table(spark, "documents")).collect()}
    assert got == {i: (f"{p:016x}", low[roots[p]]) for i, p in prints.items()}
    kept = keep_first(table(spark, "documents"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(low.values()))
    assert kept.columns == table(spark, "documents").columns


def test_edge_cases(spark):
    long = "word " * 30_000
    rows = [(5, None), (3, ""), (7, "  "), (9, "a b c d e"), (8, "A b c d e"), (8, "A b c d e"), (None, "a b c d e"),
            (None, "x1 x2 x3 x4 x5 x6"), (20, long)]
    df = docs(spark, rows, extra=("fp", "digest", "root", "component_id"))
    got = [(r["doc_id"], r["component_id"]) for r in simhash_groups(df).collect()]
    want = [(5, 3), (3, 3), (7, 3), (9, 8), (8, 8), (8, 8), (None, 8), (None, None), (20, 20)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str((r["doc_id"], (r["text"] or "")[:3])) for r in kept.collect()) == sorted(
        str(x) for x in [(3, ""), (8, "A b"), (None, "x1 "), (20, "wor")])
    none = df.limit(0)
    assert simhash_groups(none).count() == 0 and keep_first(none).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 150), (150, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 1 for i in range(1, 61)} | {100 + i: 100 for i in range(50)} | {150: 150, 200: 150}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
