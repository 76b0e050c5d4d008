"""Token ids as Parquet list columns.

Documents are dealt out by ranges of their id, sorted, encoded and written as
one list of ids per row.  Ids are dictionary encoded (a vocabulary fits a
dictionary page), the sorted and counting columns delta encoded; row groups and
pages have set sizes, and the writer adds page indexes, so that a reader of few
columns or few documents reads little.  A second small table, the manifest, has
for each file part the number of ids before it; it is made from the counts
alone, without reading any id.

Order: ascending id, rows without an id first; rows of the same id by the digest
of their text, equal rows in any order.

Defined cases: a null or empty text is the end id alone; repeated rows are each
written; an empty table gives empty files; columns other than the two named
ones are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlink.session import checkpoint_root

from .common import digest_of, take_columns, text_of
from .pieces import pieces

END = 2
ROW_GROUP = 32 << 20
PAGE = 256 << 10
SLICE = 200
#: Writer settings of the format, by Parquet's own names.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part": "true",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
}


def encoded(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Sorted rows: part (number of the range), doc_id, first (ids before it in
    its part), n_tokens, ids."""
    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
    own = own.withColumn("digest", digest_of(F.col("text")))
    # the row number only lets the sampled bounds part equal rows
    own = own.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("doc_id", "digest", "row")
    own = own.sortWithinPartitions("doc_id", "digest").select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    end = struct.pack("<I", END)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = pieces(path, glued=True), 0
        part = TaskContext.get().partitionId()
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                few = b.slice(lo, SLICE)
                made = [encoder.of(x) + end for x in few.column("text").to_pylist()]
                n = np.fromiter(map(len, made), np.int64, len(made)) // 4
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)), pa.int32()),
                    pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(made))]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), few.column("doc_id"), pa.array(before + ends - n),
                     pa.array(n), lists], ["part", "doc_id", "first", "n_tokens", "ids"])
                before += int(ends[-1])

    return own.mapInArrow(run, f"part int, doc_id {kind}, first long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None) -> None:
    """Write ``folder``/tokens and ``folder``/manifest."""
    spark = docs.sparkSession
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    rows = encoded(docs, id_col, text_col, path)
    rows.write.options(**LAYOUT).parquet(f"{folder}/tokens")
    counts = spark.read.schema(rows.schema).parquet(f"{folder}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # one row per part, a few bytes each
    before = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counts.withColumn("before", F.coalesce(before, F.lit(0).cast("long"))).write.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    tokens, manifest = spark.read.parquet(f"{folder}/tokens"), spark.read.parquet(f"{folder}/manifest")
    return tokens.join(manifest.select("part", "before"), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids")


def ids_digest(tokens: DataFrame) -> DataFrame:
    """The rows with ids_crc32, the checksum of the ids as unsigned 32-bit little
    endian integers, in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            at = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                                              pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tokenizer_path: str | None = None) -> DataFrame:
    """Write the files below the shared folder and return the rows read back."""
    folder = f"{checkpoint_root(docs.sparkSession).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, id_col, text_col, tokenizer_path)
    return read_tokens(docs.sparkSession, folder)
