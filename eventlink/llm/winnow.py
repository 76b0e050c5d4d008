"""Benchmark decontamination by winnowing.

An item's windows are its runs of 13 words (a shorter item is one window).  The
fingerprint of a window is the least hash of its 5-word grams, so every window
that two texts share has the same fingerprint in both: the guarantee of
winnowing with nine grams a window.  Document windows are kept when a bitmap of
the benchmark's fingerprints (of fixed size, whatever the benchmark's) lets
them pass; they are joined to the benchmark by fingerprint, and each hit is
extended to its whole window by comparing the words themselves.  False passes
of the bitmap and hash collisions drop out in that join.

Defined cases: a null or empty text has no words, is never contaminated, and as
an item has no window; an item without an id marks words but is not listed;
items with equal words count each, items with equal ids once; repeated
documents are each returned; an empty benchmark hits nothing, an empty document
table gives an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import digest_of, stage, take_columns, text_of

WINDOW = 13
GRAM = 5
FILTER_BITS = 24
#: A-Z lower-cased, every other byte that no word holds to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ROWS = 50_000
WORDS_HELD, BYTES_HELD = 500_000, 64
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash by word; emptied when it holds more words than its bound.  Long words
    are never held."""

    def __missing__(self, word: bytes) -> int:
        if len(word) > BYTES_HELD:
            return xxh64_intdigest(word)
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


HASHES = WordHashes()


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD
    return h ^ (h >> np.uint64(29))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(hashes) - width + 1
    total = hashes[:n].copy()
    for k in range(1, width):
        total = total * ODD + hashes[k:k + n]
    return _mixed(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``, by doubling."""
    n, low, have = len(values) - width + 1, values, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:n], low[width - have:width - have + n])


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of the window of ``length`` words that starts at each word."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    width = min(GRAM, length)
    return _mixed(sliding_min(grams(hashes, width), length - width + 1) + np.uint64(length))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def _window(words: list[bytes], start: int, length: int) -> str:
    return b" ".join(words[start:start + length]).decode("utf-8", "replace")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """One row per window of every item: item_id, line (digest of the item's words
    as one line), length, h, win."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item, raw in zip(b["item_id"], b["raw"]):
                words = words_of(raw)
                if words:
                    length = min(WINDOW, len(words))
                    h = fingerprints(_hashes(words), length).view(np.int64)
                    line = sha256(_window(words, 0, len(words)).encode()).hexdigest()
                    for k in range(0, len(h), ROWS):
                        part = h[k:k + ROWS]
                        yield pd.DataFrame({"item_id": [item] * len(part), "line": line, "length": length, "h": part,
                                            "win": [_window(words, k + i, length) for i in range(len(part))]})

    own = take_columns(benchmark, item_id=item_col, text=text_col)
    own = own.select(F.col("item_id").cast("string"), text_of("text").cast("binary").alias("raw"))
    return own.mapInPandas(run, "item_id string, line string, length int, h long, win string")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bits of the leading FILTER_BITS bits of all fingerprints; at most 512
    pieces of 4 KB come to the driver."""
    at = F.shiftrightunsigned("h", 64 - FILTER_BITS) + 1
    pieces = (windows.select(at.alias("x")).groupBy(F.bitmap_bucket_number("x").alias("k"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).collect())
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for p in pieces:
        start = (p["k"] - 1) * 4096
        bits[start:start + 4096] = np.frombuffer(p["bits"], np.uint8)
    return bits


def document_windows(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """A row per document (start null) and one per window that the bitmap lets
    pass: doc_id, digest, n_words, start, length, h, win."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, blank = shared.value, np.int64(0)
        for b in batches:
            for lo in range(0, len(b), 1000):
                piece = b.iloc[lo:lo + 1000]
                counts, rows = [], []
                for i, raw in enumerate(piece["raw"]):
                    words = words_of(raw)
                    counts.append(len(words))
                    hashes = _hashes(words)
                    for length in lengths:
                        h = fingerprints(hashes, length)
                        at = h >> np.uint64(64 - FILTER_BITS)
                        hit = np.flatnonzero(bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
                        for k in range(0, len(hit), ROWS):
                            part = hit[k:k + ROWS]
                            rows.append(pd.DataFrame({"i": i, "start": part, "length": length, "h": h[part].view(np.int64),
                                                      "win": [_window(words, s, length) for s in part.tolist()]}))
                        if sum(map(len, rows)) > ROWS:
                            yield _placed(piece, pd.concat(rows), blank)
                            rows = []
                base = piece[["doc_id", "digest"]].assign(n_words=np.array(counts, np.int64), start=None, length=None, h=None, win=None)
                yield base
                if rows:
                    yield _placed(piece, pd.concat(rows), blank)

    own = take_columns(docs, doc_id="doc_id", text="text")
    own = own.select("doc_id", digest_of(text_of("text")).alias("digest"), text_of("text").cast("binary").alias("raw"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInPandas(run, f"doc_id {kind}, digest long, n_words long, start int, length int, h long, win string")


def _placed(docs: pd.DataFrame, rows: pd.DataFrame, n_words: np.int64) -> pd.DataFrame:
    named = docs[["doc_id", "digest"]].iloc[rows["i"].to_numpy()].reset_index(drop=True)
    rows = rows.drop(columns="i").reset_index(drop=True)
    return pd.concat([named, rows], axis=1).assign(n_words=n_words)[["doc_id", "digest", "n_words", "start", "length", "h", "win"]]


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["digest"] == b["digest"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = stage(item_windows(benchmark, item_col, item_text_col), "item-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # 1 to 13
    own = take_columns(docs, doc_id=id_col, text=text_col)
    found = stage(document_windows(own, lengths, _bitmap(windows)), "document-windows")

    key = ["length", "h", "win"]
    hits = found.where(F.col("start").isNotNull()).select("doc_id", "digest", "start", *key)
    # one document's windows once, however often its row repeats
    hits = stage(hits.join(windows.select(*key).distinct(), key, "left_semi").distinct(), "hits")

    seen = W.partitionBy("doc_id", "digest").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = hits.select("doc_id", "digest", (end - F.greatest(
        F.col("start"), F.least(end, F.coalesce(F.max(end).over(seen), F.lit(0))))).alias("new"))
    n_hit = covered.groupBy("doc_id", "digest").agg(F.sum("new").cast("long").alias("n_hit"))

    # equal items travel as one line until each document's lines are distinct
    lines = hits.select("doc_id", "digest", *key).distinct().join(windows.select(*key, "line").distinct(), key)
    lines = lines.select("doc_id", "digest", "line").distinct()
    items = lines.join(windows.select("line", "item_id").distinct(), "line").groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))

    base = found.where(F.col("start").isNull()).select("doc_id", "digest", "n_words")
    per = n_hit.join(items, _same(n_hit, items)).select(n_hit["doc_id"], n_hit["digest"], "n_hit", "items")
    out = base.join(per, _same(base, per), "left").select(
        base["doc_id"], base["digest"], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"))
    return out.withColumn("n_items", F.greatest("n_items", F.lit(0).cast("long"))).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = contamination(docs, benchmark, id_col, text_col).where("contaminated").select("doc_id", "digest").distinct()
    bad = stage(bad, "contaminated")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.withColumns({"doc_id": F.col("row").getField(id_col),
                               "digest": digest_of(F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")))})
    return whole.join(bad, _same(whole, bad), "left_anti").select("row.*")
