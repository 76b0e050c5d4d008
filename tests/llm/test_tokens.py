import random
import sys
import zlib
from array import array
from collections import defaultdict
from functools import cache

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from frames import docs, table, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlink.llm.packing import dealt, differencing, pack, packed_digest
from eventlink.llm.pieces import Held, Pieces
from eventlink.llm.token_counts import token_counts
from eventlink.llm.token_files import ids_digest, token_files, write_tokens

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "x\ty", "don't stop 's 'll", "Thing.\nNext, one!? two",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "<|EndOfText|> <|startoftext|>", "é é ́x", "a b  c",
       "a b", "a ​b", "x \u0085y", "ΣΑΣ ΟΔΟΣ", "İstanbul ẞ", "日本 語 です", "1234 5,678.90 ½", "a\x1cb \x1d c\x1f",
       "😀 👍🏽 x", "co­op", "﻿bom x", "tab\t end\r\nnext", "ÀÉ. Öl,ß!\nÑandú?", "ǅ ʰ ª", "a" * 3000, " ".join("ab" * 500)]


@cache
def read(path):
    return Tokenizer.from_file(path)


def library(path, text):
    return read(path).encode(text, add_special_tokens=False).ids


def packed(ids):
    return array("I", ids).tobytes()


@pytest.mark.parametrize("path,glued", [(BYTES, True), (WORDS, False)])
def test_pieces_equal_the_library(path, glued):
    t = Tokenizer.from_file(path)
    fast, count = Pieces(path, glued), Pieces(path, glued, counts=True)
    rng = random.Random(3)
    marks = [" ", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\u0085", "​", "a", "Thing", "é", "́", ".", ",", "'s", "'", "1",
             "²", "ß", "<|endoftext|>", "<|", "Σ", "語", "😀", "ͅ", "ö,", "Öl.\nAb"]
    made = ["".join(rng.choices(marks, k=rng.randint(1, 25))) for _ in range(4000)]
    for x in ODD + made:
        ids = t.encode(x, add_special_tokens=False).ids
        assert fast.of(x) == packed(ids), repr(x)
        assert count.of(x) == len(ids), repr(x)


@pytest.mark.parametrize("path,glued", [(BYTES, True), (WORDS, False)])
def test_pieces_between_all_characters(path, glued):
    """Every assigned character next to a cut."""
    t, fast = Tokenizer.from_file(path), Pieces(path, glued)
    found = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isprintable() and not 0xD800 <= ord(c) < 0xE000]
    for lo in range(0, len(found), 3000):
        some = found[lo:lo + 3000]
        text = " ".join(some)
        assert fast.of(text) == packed(t.encode(text, add_special_tokens=False).ids)


def test_long_pieces_are_not_held():
    made = []
    held = Held(lambda k: made.append(k) or len(k))
    assert [held[k] for k in ("a" * 64, "a" * 64, "b" * 65, "b" * 65)] == [64, 64, 65, 65]
    assert len(made) == 3 and list(held) == ["a" * 64]


def test_held_forgets_only_at_its_bound():
    made = []
    held = Held(lambda k: made.append(k) or k * 2, bound=3, fixed={7: 14})
    assert [held[k] for k in (1, 2, 3, 1, 7, 4, 1, 5, 6, 8, 7, 1)] == [2, 4, 6, 2, 14, 8, 2, 10, 12, 16, 14, 2]
    assert 7 not in made and len(held) <= 4


def test_differencing():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        m = rng.randint(1, 12)
        found = differencing(sizes, m)
        assert len(found) <= m and sorted(k for w in found for k in w) == list(range(len(sizes)))
        for w in dealt(sizes, 100):
            assert sum(sizes[k] for k in w) <= 100
    assert {sum([8, 7, 6, 5, 4][k] for k in w) for w in differencing([8, 7, 6, 5, 4], 2)} == {14, 16}
    assert differencing([], 3) == []


def check_packing(df, rows, capacity=4096):
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append(packed([*library(WORDS, text or ""), 2]))
    got, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, wanted in want.items():
        joined = b"".join(x["ids"] for x in sorted(got[doc], key=lambda x: x["start"]))
        assert sorted(joined) == sorted(b"".join(wanted))
        if len(wanted) == 1:
            assert joined == wanted[0]
            assert {x["doc_tokens"] for x in got[doc]} == {len(joined) // 4}
    assert set(got) == set(want)
    return len(sequences), sum(len(x) // 4 for v in want.values() for x in v)


def test_packing_of_the_smallest_table(spark):
    n, tokens = check_packing(pack(table(spark, "documents")), texts(spark))
    assert n * 4096 < 1.05 * tokens + 8 * 4096
    digest = packed_digest(pack(table(spark, "documents"))).collect()
    some = {(r["doc_id"], r["start"]): r["ids"] for r in pack(table(spark, "documents")).collect()}
    assert all(zlib.crc32(some[r["doc_id"], r["start"]]) == r["ids_crc32"] for r in digest)


def test_packing_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 10_000), (5, "x " * 511), (6, "x " * 4095)]
    df = docs(spark, rows, extra=("ids", "start", "offset"))
    check_packing(pack(df), rows)
    check_packing(pack(df, capacity=64, max_piece=16, windows=4), rows, 64)
    assert pack(df.limit(0)).count() == 0


def slow_files(rows):
    out, before = [], 0
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in keyed:
        ids = packed([*library(BYTES, text or ""), 2])
        out.append((doc, before, len(ids) // 4, zlib.crc32(ids)))
        before += len(ids) // 4
    return out


def test_token_files_round_trip(spark):
    got = [tuple(r) for r in ids_digest(token_files(table(spark, "documents"))).collect()]
    assert sorted(got) == slow_files(texts(spark))


def test_token_files_edge_cases(spark):
    rows = [(4, "b"), (1, None), (2, ""), (2, ""), (None, "null id"), (9, " ".join(ODD)), (7, "word " * 20_000)]
    df = docs(spark, rows, extra=("part", "first", "digest", "row", "ids"))
    got = [tuple(r) for r in ids_digest(token_files(df)).collect()]
    assert sorted(got, key=str) == sorted(slow_files(rows), key=str)
    assert ids_digest(token_files(df.limit(0))).count() == 0


def test_token_files_layout(spark, tmp_path):
    write_tokens(table(spark, "documents"), f"file://{tmp_path}/out")
    files = [f for f in (tmp_path / "out/tokens").iterdir() if f.suffix == ".parquet"]
    meta = pq.ParquetFile(max(files, key=lambda f: f.stat().st_size)).metadata.row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert any("DICTIONARY" in e for e in by["ids.list.element"].encodings)
    for c in ("doc_id", "first", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in by[c].encodings
        assert by[c].has_offset_index and by[c].has_column_index


def test_token_counts(spark):
    rows = texts(spark) + [(100_000 + i, x) for i, x in enumerate(ODD)] + [(None, "a b"), (5, None), (5, None), (6, "x " * 1100)]
    df = docs(spark, rows, extra=("n", "piece", "n_tokens"))
    for kept in (65_536, 50):
        got = [tuple(r) for r in token_counts(df, table=kept).collect()]
        want = [(d, len((x or "").encode()), n := len(library(BYTES, x or "")), n > 1024) for d, x in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts(df.limit(0)).count() == 0
    assert token_counts(df).where(F.col("over_limit")).count() > 0
