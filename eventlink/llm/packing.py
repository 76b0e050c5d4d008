"""Packing by multiway differencing (Karmarkar and Karp).

Each task reads its documents in order and packs them block by block, without a
shuffle.  A document's whole windows become sequences of their own; what is
left is cut into pieces and gathered until a block holds about as many tokens
as its windows.  The block's pieces are dealt out by differencing: the two
partial partitions with the greatest imbalance are merged, the fullest windows
of one with the emptiest of the other, until one partition is left.  If its
fullest window exceeds the capacity, the number of windows rises by one and the
block is dealt out anew.

A sequence is numbered by the task's partition and a counter, so a task that
runs again over the same rows gives the same sequences.

Defined cases: a null or empty text is one piece, the end id alone; null ids
and repeated rows are packed like any other row; an empty table gives an empty
result; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import take_columns, text_of
from .pieces import pieces

END = 2
CAPACITY = 4096
MAX_PIECE = 512
WINDOWS = 256
SLACK = 0.003


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of ``sizes`` by window, at most ``windows`` of them."""
    # a partial partition: sums in falling order (windows without any are zero), and the members of each
    heap = [(-s, k, [s], [[k]]) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        meet = max(0, len(a) + len(b) - windows)  # windows in which both have something
        p, q = len(a) - meet, len(b) - meet
        sums = a[:p] + [x + y for x, y in zip(a[p:], reversed(b[q:]))] + b[:q]
        members = in_a[:p] + [x + y for x, y in zip(in_a[p:], reversed(in_b[q:]))] + in_b[:q]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, members = [sums[i] for i in order], [members[i] for i in order]
        gap = sums[0] - (sums[-1] if len(sums) == windows else 0)
        made += 1
        heapq.heappush(heap, (-gap, made, sums, members))
    return heap[0][3] if heap else []


def dealt(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few windows as differencing can keep within the capacity."""
    windows = -(-sum(sizes) // capacity)
    while True:
        found = differencing(sizes, windows)
        if all(sum(sizes[k] for k in w) <= capacity for w in found):
            return found
        windows += 1


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY, max_piece: int = MAX_PIECE, windows: int = WINDOWS, slack: float = SLACK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit little
    endian), doc_tokens, sequence_id, offset.

    ``max_piece``: pieces of a block are no longer than this; ``windows``: of a
    block; ``slack``: share of a block's capacity that is left empty."""
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    want = max(1, int(windows * capacity * (1 - slack)))
    end = struct.pack("<I", END)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = pieces(path, glued=False)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []  # (doc_id, start, ids, doc_tokens, sequence_id, offset)
        block: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        held = 0

        def close() -> None:
            nonlocal number, held
            for window in dealt([len(x[2]) // 4 for x in block], capacity):
                offset = 0
                for k in sorted(window):
                    rows.append((*block[k], number, offset))
                    offset += len(block[k][2]) // 4
                number += 1
            block.clear()
            held = 0

        def out() -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])
            made.insert(2, "length", made["ids"].map(len) // 4)
            rows.clear()
            return made

        for b in batches:
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = encoder.of(text) + end
                n = len(ids) // 4
                start = 0
                while n - start >= capacity:
                    rows.append((doc, start, ids[4 * start:4 * (start + capacity)], n, number, 0))
                    start += capacity
                    number += 1
                while start < n:
                    size = min(n - start, max_piece, want - held)
                    block.append((doc, start, ids[4 * start:4 * (start + size)], n))
                    start += size
                    held += size
                    if held == want:
                        close()
                if len(rows) >= 5000:
                    yield out()
        if block:
            close()
        if rows:
            yield out()

    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInPandas(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long")


def packed_digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
