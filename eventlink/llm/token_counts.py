"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of frequent pieces and their numbers of ids, of
fixed size; tier two is each worker's own bounded cache, filled by the library
for the misses.  No pre-token is shuffled: the frequent pieces come from
bounded summaries, one per task over all of its rows, whose counts are added up
before the best are taken.  The table decides the speed only, never a count.

Defined cases: a null text is empty and has no token; null ids and repeated
rows are counted like any other row; an empty table gives an empty result;
columns other than the two named ones are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import take_columns, text_of
from .pieces import Pieces, sure

TABLE = 65_536
SUMMARY = 8_192
COUNTED = 100_000
PIECE_CHARS = 32
LIMIT = 1024


def frequent(own: DataFrame, table: int = TABLE) -> list[str]:
    """The ``table`` pieces with the highest counts over the tasks' summaries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for b in batches:
            for text in b["text"]:
                seen.update([x for x in text.split(" ") if len(x) <= PIECE_CHARS])
                if len(seen) > 2 * COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED)))
        best = [(k, n) for k, n in seen.most_common(SUMMARY) if sure(k)]
        yield pd.DataFrame(best, columns=["piece", "n"])

    sums = own.select("text").mapInPandas(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r["piece"] for r in sums.orderBy(F.desc("n"), "piece").limit(table).select("piece").collect()]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                 limit: int = LIMIT, table: int = TABLE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
    spark = docs.sparkSession

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Pieces(path, glued=True, counts=True)
        for b in batches:
            yield b.assign(n=[encoder.encoded(" " + x) for x in b["piece"]])

    best = spark.createDataFrame([(x,) for x in frequent(own, table)], "piece string")
    best = best.repartition(max(1, min(table // 4096, spark.sparkContext.defaultParallelism)))
    known = {r["piece"]: r["n"] for r in best.mapInPandas(lengths, "piece string, n int").collect()}
    shared = spark.sparkContext.broadcast(known)  # at most `table` short pieces
    mark = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for b in batches:
            encoder = encoder or _counter(mark, path, shared)
            n = [encoder.of(x) for x in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": n})

    kind = own.schema["doc_id"].dataType.simpleString()
    counted = own.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_COUNTERS: dict = {}


def _counter(mark: str, path: str, shared) -> Pieces:
    """A worker's counter, kept from task to task of the same run."""
    if mark not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[mark] = Pieces(path, glued=True, counts=True, fixed=shared.value)
    return _COUNTERS[mark]
