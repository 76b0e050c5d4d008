"""SimHash fingerprints and their exact self-join by trie traversal.

A fingerprint is a path in a binary trie.  Two paths are walked together, their
differing bits are added up, and the pair of nodes is given up as soon as the
sum exceeds the error budget of its depth.

The walk starts from four rotations of the fingerprint, 16 bits apart.  If two
fingerprints differ in at most D bits, then in at least one rotation the first
k blocks hold at most k D / 4 of them, for every k (else the excesses over D / 4
round the ring would sum to more than D).  So each rotation is walked under the
budget k D / 4 after k blocks, and the first level keeps 17 nodes in place of
the 2,517 that a single walk would need at D = 4.

Spark deals the node pairs of the first block out by node.  Each task finishes
its nodes in memory by the same walk over sorted arrays.  A node with more rows
than ``node_rows`` goes down another block first, so that a large group of near
copies is spread over its own subtree.  Tasks return a spanning forest of the
links they find, never all pairs, and pass over node pairs whose members are
linked already.

Defined cases: null and empty texts have the fingerprint zero, which is linked
like any other; fewer words than a shingle make one shingle of them all; rows
with a null id take part but never name a component (a component without any
id has a null one); repeated rows are each returned; an empty table gives an
empty result; columns other than the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import digest_of, stage, take_columns, text_of
from .components import components

BLOCK = 16
BLOCKS = 4
SEED = 42
LEAF = 4096
CHUNK = 1 << 16


def fingerprint(raw: bytes, width: int = 4) -> int:
    """Bits set in over half of the shingles' hashes; zero without words."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        spans = zip(starts[k:min(k + CHUNK, n)].tolist(), ends[k + width - 1:min(k + CHUNK, n) + width - 1].tolist())
        h = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprinted(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, digest (of the text), fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(x, width) for x in b["raw"]), np.uint64, len(b)).view(np.int64)
            yield b.drop(columns="raw").assign(fp=fp)

    own = take_columns(docs, doc_id=id_col, text=text_col)
    own = own.select("doc_id", digest_of(text_of("text")).alias("digest"), text_of("text").cast("binary").alias("raw"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInPandas(run, f"doc_id {kind}, digest long, fp long")


def _budget(level: int, distance: int) -> int:
    return (level + 1) * distance // BLOCKS


def _masks(most: int) -> np.ndarray:
    """All 16-bit masks of 1 to ``most`` bits."""
    return np.array([sum(1 << k for k in c) for n in range(1, most + 1) for c in combinations(range(BLOCK), n)], np.uint64)


NODE = "rot int, node long, val long, err int, own boolean"


def _first_level(distance: int):
    """Fingerprints to rows of the first level: four rotations, each at its own
    node and, as a probe, at the greater nodes within the budget."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = b["fp"].to_numpy(np.int64).view(np.uint64)
            for r in range(BLOCKS):
                turned = (fp << np.uint64(BLOCK * r)) | (fp >> np.uint64(64 - BLOCK * r)) if r else fp
                rows = pd.DataFrame({"node": np.zeros(len(fp), np.int64), "val": turned.view(np.int64),
                                     "err": np.zeros(len(fp), np.int32), "own": np.ones(len(fp), bool)})
                for out in _deeper(rows, 0, distance):
                    out.insert(0, "rot", np.int32(r))
                    yield out

    return run


def _deeper(rows: pd.DataFrame, level: int, distance: int) -> Iterator[pd.DataFrame]:
    """Rows of one level to rows of the next block."""
    val = rows["val"].to_numpy(np.int64).view(np.uint64)
    err, own = rows["err"].to_numpy(), rows["own"].to_numpy()
    above = rows["node"].to_numpy(np.int64).view(np.uint64) << np.uint64(BLOCK)
    block = (val >> np.uint64(64 - BLOCK * (level + 1))) & np.uint64(0xFFFF)

    def made(pick, target, e, is_own) -> pd.DataFrame:
        return pd.DataFrame({"node": (above[pick] | target).view(np.int64), "val": val[pick].view(np.int64),
                             "err": e.astype(np.int32), "own": np.full(len(target), is_own)})

    yield made(own, block[own], np.zeros(int(own.sum())), True)
    yield made(~own, block[~own], err[~own], False)
    for mask in _masks(_budget(level, distance)):
        target, bits = block ^ mask, int(mask).bit_count()
        pick = (err + bits <= _budget(level, distance)) & (~own | (target > block))
        yield made(pick, target[pick], err[pick] + bits, False)


def _walk(values: np.ndarray, own: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning links among the members of one node, of which at least one end
    is the node's own: the trie walk over sorted arrays."""
    order = np.argsort(values, kind="stable")
    values, own = values[order], own[order]
    label = np.arange(len(values))
    at_own, at_probe = np.flatnonzero(own), np.flatnonzero(~own)
    links = []
    todo = [(at_own, at_own, True), (at_own, at_probe, False)]
    while todo:
        a, b, same = todo.pop()
        if not len(a) or not len(b) or same and len(a) < 2:
            continue
        x, y = values[a], values[b]
        if len(a) * len(b) <= LEAF:
            i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= distance)
            i, j = a[i], b[j]
            apart = label[i] != label[j]
            while apart.any():
                i, j = i[apart], j[apart]
                links.append((int(values[i[0]]), int(values[j[0]])))
                label[label == label[j[0]]] = label[i[0]]
                apart = label[i] != label[j]
            continue
        low = max(int(x[0] ^ x[-1]).bit_length(), int(y[0] ^ y[-1]).bit_length())  # the bits that are still open
        depth = 64 - low
        if (int(x[0] ^ y[0]) >> low).bit_count() > min(distance, -(-depth // BLOCK) * distance // BLOCKS):
            continue
        if label[a[0]] == label[b[0]] and (label[a] == label[a[0]]).all() and (label[b] == label[b[0]]).all():
            continue
        bit = np.uint64(low - 1)
        a0, b0 = a[(x >> bit) & np.uint64(1) == 0], b[(y >> bit) & np.uint64(1) == 0]
        a1, b1 = a[len(a0):], b[len(b0):]
        todo += [(a0, b1, False), (a0, b0, same), (a1, b1, same)] + ([] if same else [(a1, b0, False)])
    return links


def _joined(distance: int):
    """Rows sorted by (rot, node) to links between fingerprints."""

    def links_of(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows["rot"].to_numpy().astype(np.int64), rows["node"].to_numpy()
        val, own = rows["val"].to_numpy(np.int64).view(np.uint64), rows["own"].to_numpy()
        cut = np.flatnonzero((np.diff(key[0]) != 0) | (np.diff(key[1]) != 0)) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(rows)]))
        found: list[np.ndarray] = []
        size, mine = last - first, np.add.reduceat(own.astype(np.int64), first)
        small = (size * mine <= LEAF) & (mine > 0) & (size > 1)
        picks = np.flatnonzero(small)
        # pairs of all small nodes at once, in pieces of bounded size
        for part in np.split(picks, np.flatnonzero(np.diff(np.cumsum(size[picks] * size[picks]) // (1 << 21))) + 1):
            if not len(part):
                continue
            left = np.concatenate([np.arange(first[g], last[g]) for g in part])
            left = left[own[left]]
            group = np.searchsorted(first, left, side="right") - 1
            times = size[group]
            i = np.repeat(left, times)
            j = np.repeat(first[group] - np.cumsum(times) + times, times) + np.arange(len(i))
            near = np.bitwise_count(val[i] ^ val[j]) <= distance
            near &= ~own[j] | (val[i] < val[j])
            found.append(np.stack([val[i[near]], val[j[near]], key[0][i[near]].astype(np.uint64)], axis=1))
        for g in np.flatnonzero((size * mine > LEAF)):
            span = slice(first[g], last[g])
            if links := _walk(val[span], own[span], distance):
                pairs = np.array(links, np.uint64)
                found.append(np.concatenate([pairs, np.full((len(pairs), 1), key[0][first[g]], np.uint64)], axis=1))
        if not found:
            return pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)})
        rows_ = np.concatenate(found)
        turn = rows_[:, 2] * np.uint64(BLOCK)
        back = lambda x: np.where(turn > 0, (x >> turn) | (x << ((np.uint64(64) - turn) % np.uint64(64))), x)
        out = pd.DataFrame({"u": back(rows_[:, 0]).view(np.int64), "v": back(rows_[:, 1]).view(np.int64)})
        return out.drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            end = (b["rot"].iat[-1], b["node"].iat[-1])
            whole = ~((b["rot"] == end[0]) & (b["node"] == end[1])).to_numpy()
            n = int(whole.sum())  # the rows before the last node are complete
            if n:
                yield links_of(pd.concat([*held, b.iloc[:n]]))
                held = [b.iloc[n:]]
            elif held and (held[-1]["rot"].iat[-1], held[-1]["node"].iat[-1]) != end:
                yield links_of(pd.concat(held))
                held = [b]
            else:
                held.append(b)
        if held:
            yield links_of(pd.concat(held))

    return run


def links(prints: DataFrame, distance: int = 4, node_rows: int = 2_000_000) -> DataFrame:
    """``u``, ``v``: links that connect all fingerprints (column ``fp``, distinct)
    which differ in at most ``distance`` bits."""
    rows = prints.select("fp").mapInPandas(_first_level(distance), NODE)
    found = None
    for level in range(BLOCKS):
        hot = rows.groupBy("rot", "node").count().where(F.col("count") > node_rows).select("rot", "node")
        hot = stage(hot, "hot-nodes") if level < BLOCKS - 1 else None
        split = hot is not None and not hot.isEmpty()
        here = rows.join(hot, ["rot", "node"], "left_anti") if split else rows
        here = (here.repartition("rot", "node").sortWithinPartitions("rot", "node")
                .mapInPandas(_joined(distance), "u long, v long"))
        found = here if found is None else found.unionByName(here)
        if not split:
            return found.distinct()

        def down(batches: Iterator[pd.DataFrame], level: int = level + 1) -> Iterator[pd.DataFrame]:
            for b in batches:
                for r, part in b.groupby("rot"):
                    for out in _deeper(part, level, distance):
                        out.insert(0, "rot", np.int32(r))
                        yield out

        rows = rows.join(hot, ["rot", "node"], "left_semi").select("rot", "node", "val", "err", "own").mapInPandas(down, NODE)
    return found.distinct()


def _grouped(rows: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """``rows`` (doc_id, digest, fp) with ``root``, the name of their component."""
    prints = stage(rows.select("fp").distinct(), "fingerprints")
    roots = components(links(prints, distance, node_rows))
    roots = stage(prints.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
                  .select("fp", F.coalesce("root", "fp").alias("root")), "roots")
    return rows.join(roots, "fp")


def _first(*keys: str) -> Column:
    """The least row by these keys, those without an id last."""
    return F.min(F.struct(F.col(keys[0]).isNull().alias("none"), *keys))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4,
                   node_rows: int = 2_000_000) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row."""
    rows = _grouped(stage(fingerprinted(docs, id_col, text_col, width), "simhash"), distance, node_rows)
    # per fingerprint first: a large group of copies shrinks to a row before it is shuffled by component
    prints = stage(rows.groupBy("fp", "root").agg(F.min("doc_id").alias("low")), "print-ids")
    named = stage(prints.join(prints.groupBy("root").agg(F.min("low").alias("component_id")), "root")
                  .select("fp", "component_id"), "components")
    return rows.select("doc_id", "fp").join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4,
               node_rows: int = 2_000_000) -> DataFrame:
    """One row of each component, the one with the smallest id (ties: the least
    digest of the text; of repeated rows, one), with the columns of ``docs``."""
    rows = _grouped(stage(fingerprinted(docs, id_col, text_col, width), "simhash"), distance, node_rows)
    kept = stage(rows.groupBy("root").agg(_first("doc_id", "digest").alias("r")).select("r.doc_id", "r.digest"), "kept")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.withColumns({"doc_id": F.col("row").getField(id_col),
                               "digest": digest_of(F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")))})
    same = whole["doc_id"].eqNullSafe(kept["doc_id"]) & (whole["digest"] == kept["digest"])
    return whole.join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select("row.*")
