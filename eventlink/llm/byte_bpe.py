"""Byte-level BPE over Arrow batches, from a file of ranks, and back.

A file of ranks holds byte strings; the tokenizers library wants characters and
pairs.  Each byte gets a printable character (the table of byte-level
vocabularies), and the pair that makes a token is found by merging the token's
own bytes by rank until two parts are left: a token's bytes never merge across
its edges before it is made, so no other pair can make it.  The library's model
then gives what merging by rank gives, match by match of the pattern.  The model
is built once on the driver and broadcast; its size is that of the vocabulary.

Texts are cut at single spaces between printable characters, where no match of
the pattern crosses, and a worker keeps the ids of short pieces up to a bound.

Offsets: token by token the end in bytes, and the characters it touches; tokens
that share a character each name it whole.  Decoding looks every id's bytes up
and joins them before any character is made, so that a character split between
tokens comes back whole; bytes that form no character become U+FFFD in the text,
and stay as they are in the bytes.

Defined cases: a null text is empty and has no ids; null ids of documents and
repeated rows give one row each; a text of any length is one list; an empty
table gives an empty result; columns other than the two named ones are ignored;
an id that the vocabulary lacks raises when decoded.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from .common import take_columns, text_of
from .pieces import Held, Unsure, sure

RANKS = "byte_bpe_50k.tiktoken"
SLICE = 200
#: Longer pieces are encoded each time, so that what a worker keeps has a bound in bytes.
KEPT_CHARS, KEPT_WORDS, KEPT_PARTS = 64, 500_000, 50_000
#: Letters that every Unicode version counts as such, and with which a text is plain.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[\\x00-\\x7f{LETTERS}]*")


def byte_chars() -> list[str]:
    """The character of each byte: its own where that is printable and no space,
    else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def pair_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens that merge to this one, None if its bytes never get there."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return None
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def library_model(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizers library's form of the ranks, as its JSON."""
    chars = byte_chars()

    def spelled(token: bytes) -> str:
        return "".join([chars[b] for b in token])

    pairs = [pair_of(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    model = BPE(vocab={spelled(t): r for t, r in ranks.items()},
                merges=[(spelled(p[0]), spelled(p[1])) for p in pairs if p], ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"),
                                   ByteLevel(add_prefix_space=False, use_regex=False)])
    return made.to_str()


def plain_form(pattern: str) -> re.Pattern:
    """The pattern for plain texts."""
    return re.compile(pattern.replace("[^\\s\\p{L}\\p{N}]", f"[^\\s{LETTERS}0-9]").replace("\\p{L}", f"[{LETTERS}]")
                      .replace("\\p{N}", "[0-9]"), re.ASCII)


class Encoder:
    """Ids of texts, for one worker process."""

    def __init__(self, model: str, pattern: str):
        self.library = Tokenizer.from_str(model)
        self.model = self.library.model
        self.chars = dict(enumerate(byte_chars()))
        self.match = plain_form(pattern).findall
        self.parts = Held(self._part, KEPT_PARTS)
        self.spaced = Held(self._spaced, KEPT_WORDS)

    def _part(self, part: str) -> bytes:
        """One match of the pattern by the library's model alone."""
        spelled = part.encode().decode("latin-1").translate(self.chars)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _of(self, text: str) -> bytes:
        """A stretch between cuts, with the space before it."""
        if not PLAIN.fullmatch(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        out = []
        for m in self.match(text):
            if len(m) > KEPT_CHARS or m == text:
                out.append(self._part(m))
            elif m[0] == " " and m[1:].isalpha():
                out.append(self.spaced[m[1:]])
            else:
                out.append(self.parts[m])
        return b"".join(out)

    def _spaced(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():  # most misses
            return array("I", [t.id for t in self.model.tokenize(self.chars[32] + piece)]).tobytes()
        if not sure(piece):
            raise Unsure
        return self._of(" " + piece)

    def _grouped(self, pieces: list[str]) -> bytes:
        """The pieces with those between unsafe cuts put together."""
        groups = [[pieces[0]]]
        for before, piece in zip(pieces, pieces[1:]):
            if sure(before) and sure(piece):
                groups.append([piece])
            else:
                groups[-1].append(piece)
        return b"".join([self._of(" ".join(groups[0])), *[self._of(" " + " ".join(g)) for g in groups[1:]]])

    def encode(self, text: str) -> bytes:
        """The ids, four bytes each."""
        pieces = text.split(" ")
        held = self.spaced
        try:
            if not sure(pieces[0]):
                raise Unsure
            return b"".join([self._of(pieces[0]), *[held[p] if len(p) <= KEPT_CHARS else self._spaced(p)
                                                    for p in pieces[1:]]])
        except Unsure:
            return self._grouped(pieces) if text else b""


class Decoder:
    """Bytes of ids."""

    def __init__(self, model: str, pattern: str):
        vocab = json.loads(model)["model"]["vocab"]
        of_char = {c: b for b, c in enumerate(byte_chars())}
        self.bytes: list[bytes | None] = [None] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes([of_char[c] for c in token])
        self.lengths = np.array([len(t or b"") for t in self.bytes], np.int64)
        self.decimals = [str(i) for i in range(len(self.bytes))]

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join([self.bytes[i] for i in ids])
        except (IndexError, TypeError):
            raise ValueError("an id is not in the vocabulary") from None


_HELD: dict = {}


def _worker(kind, mark: str, shared, pattern: str):
    """A worker's encoder or decoder, kept from task to task of the same run."""
    if (kind, mark) not in _HELD:
        for key in [k for k in _HELD if k[1] != mark]:
            del _HELD[key]
        _HELD[kind, mark] = kind(shared.value, pattern)
    return _HELD[kind, mark]


def _list(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values, pa.int32()))


def char_spans(texts: list[bytes], n: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends in bytes, first and end character of the tokens of texts with ``n``
    tokens each of the given lengths in bytes."""
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size) - size
    ends = np.cumsum(lengths)
    if not np.array_equal(np.add.reduceat(np.append(lengths, 0), np.cumsum(n) - n) * (n > 0), size):
        raise ValueError("ids do not cover their text")
    # characters begun up to each byte, over all texts
    begun = np.cumsum((np.frombuffer(b"".join(texts), np.uint8) & 0xC0) != 0x80)
    base = np.repeat(np.append(0, begun)[first], n)
    starts = ends - lengths
    return ends - np.repeat(first, n), begun[starts] - 1 - base, begun[ends - 1] - base


def encoded(b: pa.RecordBatch, encoder: Encoder, decoder: Decoder) -> pa.RecordBatch:
    """doc_id, ids, byte_end, char_start, char_end of doc_id, text."""
    texts = b.column("text").to_pylist()
    made = [encoder.encode(x) for x in texts]
    n = np.fromiter(map(len, made), np.int64, len(made)) // 4
    ids, ends = np.frombuffer(b"".join(made), np.uint32), np.cumsum(n)
    spans = char_spans([x.encode() for x in texts], n, decoder.lengths[ids])
    return pa.RecordBatch.from_arrays([b.column("doc_id"), *[_list(ends, v.astype(np.int32)) for v in (ids, *spans)]],
                                      ["doc_id", "ids", "byte_end", "char_start", "char_end"])


def decoded(b: pa.RecordBatch, decoder: Decoder) -> pa.RecordBatch:
    """doc_id, ids, bytes of doc_id, ids."""
    raw = [decoder.decode(x or []) for x in b.column("ids").to_pylist()]
    return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(raw, pa.binary())],
                                      ["doc_id", "ids", "bytes"])


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, SLICE):
            yield b.slice(lo, SLICE)


class ByteBpe:
    """Encoder and decoder over DataFrames for one file of ranks."""

    def __init__(self, spark: SparkSession, ranks_path: str | None = None, pattern: str | None = None):
        pattern = pattern or public_tokenizers.PATTERN
        shared = spark.sparkContext.broadcast(
            library_model(read_ranks(ranks_path or public_tokenizers.path(RANKS)), pattern))
        mark = uuid.uuid4().hex
        self.worker = lambda kind: _worker(kind, mark, shared, pattern)

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, ids, byte_end, char_start, char_end; the last three token by token."""
        worker, own = self.worker, texts_of(docs, id_col, text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield encoded(b, worker(Encoder), worker(Decoder))

        lists = [StructField(c, ArrayType(IntegerType())) for c in ("ids", "byte_end", "char_start", "char_end")]
        return own.mapInArrow(run, StructType([own.schema["doc_id"], *lists]))

    def decode(self, tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
        """doc_id, ids, bytes, text."""
        worker = self.worker
        own = take_columns(tokens, doc_id=id_col, ids=ids_col).select("doc_id", F.col("ids").cast("array<int>"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield decoded(b, worker(Decoder))

        back = own.mapInArrow(run, StructType([own.schema["doc_id"], StructField("ids", ArrayType(IntegerType())),
                                               StructField("bytes", BinaryType())]))
        return back.withColumn("text", F.make_valid_utf8(F.col("bytes").cast("string")))

    def round_trip(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Encode and decode batch by batch, and the digests of both: doc_id,
        n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256
        (of the decoded bytes)."""
        worker, own = self.worker, texts_of(docs, id_col, text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                decoder = worker(Decoder)
                ids = encoded(b, worker(Encoder), decoder).column("ids").to_pylist()
                shown = [" ".join([decoder.decimals[i] for i in x]) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([sha256(x.encode()).hexdigest() for x in shown]),
                     pa.array([sha256(decoder.decode(x)).hexdigest() for x in ids])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        digests = [StructField("n_tokens", LongType()), *[StructField(c, StringType()) for c in ("ids_sha256", "decoded_sha256")]]
        return own.mapInArrow(run, StructType([own.schema["doc_id"], *digests]))


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
