"""Source divergence audit with count-level bitmaps.

How far the sources of a language differ in their use of words: every pair of
sources by the divergence of their smoothed term shares, and for each source the
terms that it uses more than its language does.

A share depends on nothing but the count, so two sources' terms need only be
counted by their pairs of counts.  Terms get bits; for each (source, count) the
terms with that count there form a bitset.  AND plus popcount of two bitsets
gives the number of terms in a joint cell, which is multiplied by the cell's
divergence f.  Cells with a zero on either side are not stored: a source has as
many terms at zero as the language has beyond its own, so for a pair the sum over
all terms is

    sum of n[c] * f(c, 0) + sum of n[d] * f(0, d) + (V - n - n') * f(0, 0)
    + sum over joint cells of joint * (f(c, d) - f(c, 0) - f(0, d) + f(0, 0))

Bitsets are cut into blocks of BITS terms, in order of the language's count, so
that terms of like counts share a block and its levels are few.  A task holds one
block for at most two sets of about SOURCES sources each; the joint cells of all
blocks are added up by Spark.  All arithmetic is in integers.

Words are counted on the map side, by source, in tables that are given out at a
bound; a hot source is one row per term and table.

Defined cases: null text, lang and source are empty texts, and the empty lang and
source are values like any other; rows of equal id are documents of their own; a
language without kept terms gives pairs of value 0, a source without terms takes
part in all pairs, a language of one source gives no pair; equal values rank by
item; a very long text is one list of words in its task; an empty table gives an
empty result; columns other than the three named ones are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage, take_columns, text_of

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
BITS = 256
SOURCES = 64
#: Bounds of a task's table: entries, and bytes of text counted into it.
ENTRIES, BYTES = 400_000, 64 << 20

_LETTERS = {b for b in range(256) if b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A}
#: Bytes of a term, A-Z in lower case; a space for each other byte.
TERM_BYTES = bytes([b | 0x20 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256)])
KEYS = ["lang", "source", "term"]


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(TERM_BYTES).split()


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents)."""
    own = take_columns(docs, text=text_col, lang=lang_col, source=source_col)

    def given(tables: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in tables.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k), pa.array([source] * k), pa.array([t.decode() for t in n]),
                 pa.array(n.values(), pa.int64()), pa.array([df[t] for t in n], pa.int64())], [*KEYS, "n", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, entries, size = defaultdict(lambda: (Counter(), Counter())), 0, 0
        for b in batches:
            for lang, source, text in zip(*[b.column(c).to_pylist() for c in ("lang", "source", "text")]):
                raw = text.encode()
                terms = terms_of(raw)
                if not terms:
                    continue
                n, df = tables[lang, source]
                before = len(n)
                n.update(terms)
                df.update(set(terms))
                entries, size = entries + len(n) - before, size + len(raw)
                if entries > ENTRIES or size > BYTES:
                    yield from given(tables)
                    tables.clear()
                    entries = size = 0
        yield from given(tables)

    own = own.select(text_of("text").alias("text"), text_of("lang").alias("lang"), text_of("source").alias("source"))
    partial = own.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return partial.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); null without terms."""
    wide = [c.cast("decimal(19,0)") for c in (n, total, terms)]
    over = F.when(terms > 0, wide[1] + F.lit(2) * wide[2])
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE) * (wide[0] + F.lit(2)), over)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def level_bitsets(counts: DataFrame) -> DataFrame:
    """lang, block, source, n, bits from lang, block, side, source, bit, n: a bitset
    per block, source and count."""

    def run(key, g):
        sources, owner = np.unique(g["source"].to_numpy(), return_inverse=True)
        found, row = np.unique(np.stack([owner, g["n"].to_numpy()]), axis=1, return_inverse=True)
        on = np.zeros((found.shape[1], BITS), np.uint8)
        on[row, g["bit"].to_numpy()] = 1
        return pd.DataFrame({"lang": key[0], "block": key[1], "source": sources[found[0]], "n": found[1],
                             "bits": [x.tobytes() for x in np.packbits(on, axis=1)]})

    # at most BITS rows a source
    return counts.groupBy("lang", "block", "side").applyInPandas(
        run, "lang string, block long, source string, n long, bits binary")


def joint_cells(levels: DataFrame) -> DataFrame:
    """lang, source, item, value: over the joint cells of each two sources with a
    term in common, the part of the sum that the marginals do not give.  One row a
    block; ``source`` is the smaller name."""

    def run(key, g):
        g = g.sort_values("source", kind="stable")
        names, at = np.unique(g["source"].to_numpy(), return_index=True)
        ends = np.append(at[1:], len(g))
        bits = np.frombuffer(b"".join(g["bits"]), np.uint64).reshape(len(g), -1)
        p, zero, side = (g[c].to_numpy() for c in ("p", "p0", "side"))
        owner = np.repeat(np.arange(len(names)), ends - at)
        out = []
        for k in range(len(names) - 1):
            mine, rest = slice(at[k], ends[k]), slice(ends[k], len(g))
            sums, met = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
            for r in range(mine.start, mine.stop):
                joint = np.bitwise_count(bits[r] & bits[rest]).sum(1).astype(np.int64)
                j = np.flatnonzero(joint)
                h = j + ends[k]
                if key[2] != key[3]:  # two sets of sources: only pairs across them
                    across = side[h] != side[r]
                    j, h = j[across], h[across]
                cell = _f(p[r], p[h]) - _f(p[r], zero[h]) - _f(zero[r], p[h]) + _f(zero[r], zero[h])
                np.add.at(sums, owner[h], joint[j] * cell)
                met[owner[h]] = True
            out += [(key[0], names[k], names[h], sums[h]) for h in np.flatnonzero(met)]
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"])

    return levels.groupBy("lang", "block", "low", "high").applyInPandas(
        run, "lang string, source string, item string, value long")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_docs: int = LEAST_DOCS, top: int | None = TOP, per_set: int = SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source
    of the language, part ``term`` the ``top`` terms (None: all) that the source
    uses more than its language."""
    counts = stage(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    names = take_columns(docs, lang=lang_col, source=source_col)
    names = names.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()

    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
    kept = kept.where(F.col("df") >= least_docs).select("lang", "term", "lang_n")
    # ids in order of the language's count, fixed once written
    order = ["lang", F.desc("lang_n"), "term"]
    kept = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stage(kept.withColumn("id", F.monotonically_increasing_id()), "kept-terms")
    used = stage(counts.drop("df").join(kept, ["lang", "term"]), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    levels = used.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("at_n"))
    totals = levels.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("at_n")).alias("total"),
                                                  F.sum("at_n").alias("own_terms"))
    sets = names.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / per_set).cast("int").alias("sets"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sets, "lang")
    groups = groups.fillna(0, ["total", "own_terms", "terms", "lang_total"])
    groups = groups.withColumn("p0", share(F.lit(0), F.col("total"), F.col("terms")))
    groups = stage(groups, "sources")  # one row per source

    pair = _pairs(used, levels, groups)
    term = _terms(used, groups)
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    term = term.withColumn("rank", rank)
    if top is not None:
        term = term.where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pair.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(columns)
            .unionByName(term.withColumn("part", F.lit("term")).select(columns)))


def _pairs(used: DataFrame, levels: DataFrame, groups: DataFrame) -> DataFrame:
    own = groups.select("lang", "source", "total", "terms", "p0", "sets")
    own = own.withColumn("side", F.pmod(F.xxhash64("source"), F.col("sets")).cast("int"))
    placed = used.join(own, ["lang", "source"]).select(
        "lang", "source", "side", "n", F.shiftright("id", (BITS - 1).bit_length()).alias("block"),
        (F.col("id") % BITS).cast("int").alias("bit"))
    bitsets = level_bitsets(placed).join(own, ["lang", "source"])
    bitsets = bitsets.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    # each set of sources meets each other one, and itself
    bitsets = bitsets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sets") - 1)))
    bitsets = bitsets.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
    joint = joint_cells(bitsets.select("lang", "block", "low", "high", "side", "source", "p", "p0", "bits"))
    joint = joint.groupBy("lang", "source", "item").agg(F.sum("value").alias("joint"))
    joint = joint.unionByName(joint.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "joint"))

    # terms of the one source against a zero in the other
    far = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"),
                        F.col("own_terms").alias("far_terms"))
    own_levels = levels.join(own, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("terms")))
    edge = own_levels.join(far, "lang").where(F.col("source") != F.col("item")).groupBy("lang", "source", "item").agg(
        F.sum(F.col("at_n") * divergence(F.col("p"), F.col("q0"))).alias("edge"))
    back = edge.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("edge").alias("back"))

    keys = ["lang", "source", "item"]
    both = groups.select("lang", "source", "own_terms", "terms", "p0").join(far, "lang")
    both = both.where(F.col("source") != F.col("item"))
    empty = (F.col("terms") - F.col("own_terms") - F.col("far_terms")) * divergence(F.col("p0"), F.col("q0"))
    both = both.join(edge, keys, "left").join(back, keys, "left").join(joint, keys, "left")
    value = sum((F.coalesce(c, F.lit(0)) for c in (empty, F.col("edge"), F.col("back"))), F.coalesce("joint", F.lit(0)))
    return both.select(*keys, value.cast("long").alias("value"))


def _terms(used: DataFrame, groups: DataFrame) -> DataFrame:
    own = used.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    own = own.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    own = own.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("p > q")
    return own.select("lang", "source", F.col("term").alias("item"),
                      divergence(F.col("p"), F.col("q")).cast("long").alias("value"))
