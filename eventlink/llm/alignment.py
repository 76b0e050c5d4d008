"""Cross-tokenizer alignment with external spill counting.

Two vocabularies cut the same bytes.  Every byte range between neighbouring
token ends of either lies in one token of each: one link.  Where both end, a
group ends.  How sure a link is follows from how often its two ids are linked in
the whole corpus, so each document needs counts over all documents back.

* A task encodes its documents and gathers pair-document records (pair, document,
  times).  At SPILL records it sorts them side-major (B id, A id, document), cuts
  them by the low bits of the B id, and gives each part out as a zstd run: a head
  with the run's own total of each pair, and a body with the documents.
* Per radix part, a k-way heap merge over the heads counts each pair.  B ids come
  one after the other, so the highest count of an id is known when the id ends,
  and each run gets its pairs' counts back in its own order.  At most FAN runs
  are merged by one task: above that, groups of runs are merged into one head
  each, level by level, and the answers come back down the same way.
* Per run, bodies meet the answers and are added up by document.

A hot pair is one entry of each head, however many documents hold it; bodies are
never brought together by key.  A task holds a run, or FAN heads of one part.

Texts are cut at single spaces between printable characters, where neither
vocabulary's tokens cross, and stretches of plain letters also before marks and
line ends (no piece of B has a space mark behind another character, a line end, or
a letter before a mark, which is checked); a task keeps short stretches, and the
words and marks that they are made of, up to a bound.

Defined cases: texts that are null, empty, or that either vocabulary does not give
back byte for byte, have no tokens: zeros and an empty digest.  Null and repeated
ids give a row for each row; a very long text is one document of its run; equal
counts all count as the highest; an empty table gives an empty result; columns
other than the two named ones are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .byte_bpe import byte_chars
from .common import stage, take_columns, text_of
from .pieces import LETTERS, LETTERS_ONLY, MARKS, PLAIN, Pieces, sure

#: Records of a run; longest kept stretch, and how many are kept.
SPILL = 4 << 20
KEPT_CHARS, KEPT, KEPT_ATOMS = 64, 250_000, 250_000
FAN = 64
SLICE = 200
#: A key: B id, A id, document's place in its run.
ID_BITS, PLACE_BITS = 20, 24
SPACE_MARK = "▁"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Aligner:
    """Links of stretches of text, for one worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Pieces(path_a, glued=True)
        self.a.library.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_char = {c: i for i, c in enumerate(byte_chars())}
        names = [self.a.library.id_to_token(i) for i in range(self.a.library.get_vocab_size())]
        self.bytes_a = [bytes([of_char[c] for c in x]) for x in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        crossing = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}|\n|[{LETTERS}][{MARKS}]")
        if any(map(crossing.search, pieces)) or max(len(names), len(pieces)) > 1 << ID_BITS:
            raise ValueError("a piece crosses a cut, or a vocabulary is too large")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.line_end = self.b.encode("\n")
        self.atoms: dict[str, tuple] = {}
        self.old_atoms: dict[str, tuple] = {}
        self.forget()

    def forget(self) -> None:
        """Empty the tables: place, groups, links and sizes of each stretch."""
        self.places: dict[str, int] = {}
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.sizes = np.zeros((0, len(COUNTS)), np.int64)
        self.short = 0

    def _ids_a(self, atom: str) -> list[int]:
        if LETTERS_ONLY.fullmatch(atom, 1) and atom[0] in " \n":
            raw = self.a._word(atom[1:], self.a.space if atom[0] == " " else "")
            raw = raw if atom[0] == " " else self.a.bare["\n"] + raw
        else:
            raw = self.a.encoded(atom)
        return memoryview(raw).cast("I").tolist()

    def _made(self, atoms: list[str]) -> Iterator[tuple[str, tuple[str, bytes, tuple]]]:
        """Groups, links and sizes of atoms; one that does not come back byte for
        byte gets none.  B puts a space before what it is given: an atom that
        begins with none is given behind a line end."""
        spaced = [x[0] == " " for x in atoms]
        given = [x[1:] if s else "\n" + x for x, s in zip(atoms, spaced)]
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for atom, s, ids_b in zip(atoms, spaced, self.b.encode(given, num_threads=1) if given else []):
            ids_b = ids_b if s else ids_b[len(self.line_end):]
            ids_a, want = self._ids_a(atom), atom.encode()
            tokens_a, tokens_b = [*map(of_a, ids_a)], [*map(of_b, ids_b)]
            if b"".join(tokens_a) == want == b"".join(tokens_b):
                keys, groups = linked(ids_a, ids_b, tokens_a, tokens_b)
                yield atom, (";".join(groups), array("Q", keys).tobytes(),
                             (len(ids_a), len(ids_b), len(groups), len(keys)))
            else:
                yield atom, ("", b"", (0, 0, 0, 0))

    def learn(self, units: list[str]) -> None:
        """Align stretches, each with the space before it."""
        parts, sizes = [], []
        for unit in units:
            m = PLAIN.fullmatch(unit)
            if m and len(unit) <= KEPT_CHARS:
                word, marks, line, after, more = m.groups()
                parts.append([x for x in (" " + word, marks, line and line + after, more) if x])
            else:
                parts.append(None)
        if len(self.atoms) > KEPT_ATOMS:
            self.atoms, self.old_atoms = {}, self.atoms
        atoms, old = self.atoms, self.old_atoms
        new = {x for p in parts if p for x in p if x not in atoms}
        for x in new & old.keys():
            atoms[x] = old[x]
        atoms.update(self._made([x for x in new if x not in atoms]))
        rest = dict(self._made([" " + u for u, p in zip(units, parts) if p is None]))
        self.places.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        for unit, p in zip(units, parts):
            if not p or len(p) == 1:
                groups, links, size = atoms[p[0]] if p else rest[" " + unit]
            elif len(p) == 2:
                (groups, links, (a, b, c, d)), (more, keys, (e, f, g, h)) = atoms[p[0]], atoms[p[1]]
                groups, links, size = f"{groups};{more}", links + keys, (a + e, b + f, c + g, d + h)
            else:
                made = [atoms[x] for x in p]
                groups, links = ";".join([m[0] for m in made]), b"".join([m[1] for m in made])
                size = tuple(map(sum, zip(*[m[2] for m in made])))
            self.groups.append(groups)
            self.links.append(links)
            sizes.append(size)
        self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64).reshape(-1, len(COUNTS))])

    def units(self, text: str) -> list[str]:
        """The text cut where neither vocabulary's tokens cross."""
        pieces = text.split(" ")
        if (text.replace("\n", "").isprintable() and not {text[0], text[-1]} & {" ", "\n"}
                and not any(x in text for x in ("  ", " \n", "\n "))):
            return pieces
        out = [pieces[0]]
        for before, piece in zip(pieces, pieces[1:]):
            if sure(before) and sure(piece):
                out.append(piece)
            else:
                out[-1] += " " + piece
        return out

    def align(self, texts: list[str]) -> list[list[int]]:
        """Places of each text's stretches in the tables until the next call; texts
        without tokens have none."""
        for unit in list(self.places)[self.short:]:  # long ones are not kept
            del self.places[unit]
        self.groups, self.links, self.sizes = (x[:self.short] for x in (self.groups, self.links, self.sizes))
        if self.short > KEPT:
            self.forget()
        cut = [self.units(x) if x and SPACE_MARK not in x else [] for x in texts]
        new = {u for units in cut for u in units if u not in self.places}
        self.learn([u for u in new if len(u) <= KEPT_CHARS])
        self.short = len(self.groups)
        self.learn([u for u in new if len(u) > KEPT_CHARS])
        found = [[self.places[u] for u in units] for units in cut]
        lost = self.sizes[:, COUNTS.index("n_links")] == 0
        if lost.any():  # a stretch that does not come back takes its text with it
            found = [[] if at and lost[at].any() else at for at in found]
        gc.freeze()  # the tables hold no cycles: collections need not look through them again
        return found


def linked(ids_a: list[int], ids_b: list[int], tokens_a: list[bytes], tokens_b: list[bytes]) -> tuple[list[int], list[str]]:
    """Keys of the links of one stretch in order, and its groups as text."""
    if len(ids_a) == 1 or len(ids_b) == 1:  # one group, all linked to the one
        return ([(b << ID_BITS | a) << PLACE_BITS for b in ids_b for a in ids_a],
                [f"{','.join(map(str, ids_a))}|{','.join(map(str, ids_b))}"])
    keys, groups = [], []
    i = j = from_a = from_b = 0
    ends_a, ends_b = [*accumulate(map(len, tokens_a))], [*accumulate(map(len, tokens_b))]
    end_a, end_b, a, b = ends_a[0], ends_b[0], ids_a[0], ids_b[0]
    while True:
        keys.append((b << ID_BITS | a) << PLACE_BITS)
        if end_a < end_b:
            i += 1
            end_a, a = ends_a[i], ids_a[i]
        elif end_b < end_a:
            j += 1
            end_b, b = ends_b[j], ids_b[j]
        else:
            i, j = i + 1, j + 1
            if i - from_a == j - from_b == 1:
                groups.append(f"{a}|{b}")
            else:
                groups.append(f"{','.join(map(str, ids_a[from_a:i]))}|{','.join(map(str, ids_b[from_b:j]))}")
            if i == len(ids_a):
                return keys, groups
            from_a, from_b, end_a, end_b, a, b = i, j, ends_a[i], ends_b[j], ids_a[i], ids_b[j]


# -- runs ---------------------------------------------------------------------

def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, one after the other, under zstd."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join([a.tobytes() for a in arrays]))


def unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    raw, sizes, out, at = zstandard.ZstdDecompressor().decompress(blob), [np.dtype(k).itemsize for k in kinds], [], 0
    n = len(raw) // sum(sizes)
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * size
    return out


HEAD = (np.uint64, np.int64, np.int64)  # pair, links, records
BODY = (np.uint32, np.uint32)  # place, links
ANSWER = (np.int64, np.uint8)  # count, whether it is its B id's highest


def runs_of(keys: np.ndarray, times: np.ndarray, radix_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """radix, head and body of each part of one run."""
    parts = (keys >> np.uint64(ID_BITS + PLACE_BITS)) & np.uint64((1 << radix_bits) - 1)
    order = np.lexsort((keys, parts))
    keys, times, parts = keys[order], times[order], parts[order]
    pairs, place = keys >> np.uint64(PLACE_BITS), (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.uint32)
    firsts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(keys) else np.array([], np.int64)
    for lo, hi in zip(firsts, np.append(firsts[1:], len(keys))):
        at = np.flatnonzero(np.append(True, pairs[lo + 1:hi] != pairs[lo:hi - 1]))
        head = packed(pairs[lo:hi][at], np.add.reduceat(times[lo:hi], at), np.diff(np.append(at, hi - lo)))
        yield int(parts[lo]), head, packed(place[lo:hi], times[lo:hi].astype(np.uint32))


RUN_FIELDS = [StructField("run", LongType()), StructField("radix", IntegerType()), StructField("head", BinaryType()),
              StructField("body", BinaryType())]
DOC_FIELDS = [StructField("place", IntegerType()), *[StructField(c, LongType()) for c in COUNTS],
              StructField("groups_sha256", StringType())]


def spilled(own: DataFrame, path_a: str, path_b: str, radix_bits: int, spill: int, groups: bool) -> DataFrame:
    """Rows of documents (radix null) and of runs (place null)."""
    doc_field = own.schema["doc_id"]
    doc_fields = [doc_field, *DOC_FIELDS, StructField("groups", ArrayType(StringType()))]
    schema = StructType([*doc_fields, *RUN_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, place, records, held, kind = 0, 0, 0, [], None

        def rows(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            out = []
            for f in schema.fields:
                arrow = kind if f.name == "doc_id" else ARROW[f.name]
                values = columns.get(f.name)
                out.append(pa.nulls(n, arrow) if values is None else
                           values if isinstance(values, pa.Array) else pa.array(values, arrow))
            return pa.RecordBatch.from_arrays(out, schema.names)

        def given() -> Iterator[pa.RecordBatch]:
            keys, times = (np.concatenate(x) for x in zip(*held))
            for radix, head, body in runs_of(keys, times, radix_bits):
                yield rows(run=[first + number], radix=[radix], head=[head], body=[body])

        for b in batches:
            kind = b.column("doc_id").type
            aligner = _aligner(path_a, path_b)
            for lo in range(0, b.num_rows, SLICE):
                few = b.slice(lo, SLICE)
                found = aligner.align(few.column("text").to_pylist())
                sizes = aligner.sizes
                flat = np.array([i for at in found for i in at], np.int64)
                n = np.array([len(at) for at in found], np.int64)
                owner = np.repeat(np.arange(len(found)), n)
                sums = np.zeros((len(found), len(COUNTS)), np.int64)
                np.add.at(sums, owner, sizes[flat])
                shown = [[aligner.groups[i] for i in at] for at in found]
                digests = [hashlib.sha256(";".join(x).encode()).hexdigest() if x else "" for x in shown]
                yield rows(doc_id=few.column("doc_id"), run=[first + number] * len(found),
                           place=range(place, place + len(found)), groups_sha256=digests,
                           groups=[[g for s in x for g in s.split(";")] for x in shown] if groups else None,
                           **{c: sums[:, k] for k, c in enumerate(COUNTS)})
                keys = np.frombuffer(b"".join([aligner.links[i] for i in flat.tolist()]), np.uint64)
                keys = keys | np.repeat((place + owner).astype(np.uint64), sizes[flat, 3])
                pairs, times = np.unique(keys, return_counts=True)
                held.append((pairs, times))
                records, place = records + len(pairs), place + len(found)
                if records >= spill or place + SLICE >= 1 << PLACE_BITS:
                    yield from given()
                    number, place, records, held = number + 1, 0, 0, []
        if held:
            yield from given()

    return own.mapInArrow(run, schema)


ARROW = {"run": pa.int64(), "radix": pa.int32(), "head": pa.binary(), "body": pa.binary(), "place": pa.int32(),
         "groups_sha256": pa.string(), "groups": pa.list_(pa.string()), **{c: pa.int64() for c in COUNTS}}
_ALIGNERS: dict = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of vocabularies."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


# -- merging ------------------------------------------------------------------

def merged(heads: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, list[int]]]:
    """Pair, its links, and the places of the runs that hold it, by a heap over
    the runs' pairs, which are in order."""
    streams = [zip(pairs.tolist(), repeat(k), links.tolist()) for k, (pairs, links) in enumerate(heads)]
    last, total, holders = None, 0, []
    for pair, k, links in heapq.merge(*streams):
        if pair != last:
            if last is not None:
                yield last, total, holders
            last, total, holders = pair, 0, []
        total += links
        holders.append(k)
    if last is not None:
        yield last, total, holders


def answered(pairs: Iterator[tuple[int, int, list[int]]], n_runs: int) -> list[tuple[list[int], list[bool]]]:
    """For each run its pairs' counts, and whether each is its B id's highest."""
    counts, best = [[] for _ in range(n_runs)], [[] for _ in range(n_runs)]
    side, waiting = None, []

    def give():
        top = max(total for total, _ in waiting)
        for total, holders in waiting:
            for k in holders:
                counts[k].append(total)
                best[k].append(total == top)

    for pair, total, holders in pairs:
        if pair >> ID_BITS != side:
            if waiting:
                give()
            side, waiting = pair >> ID_BITS, []
        waiting.append((total, holders))
    if waiting:
        give()
    return list(zip(counts, best))


def _answer_rows(g, answers) -> pd.DataFrame:
    return pd.DataFrame({"run": g["run"], "radix": g["radix"],
                         "answer": [packed(np.array(c, ANSWER[0]), np.array(b, ANSWER[1])) for c, b in answers]})


def _read_heads(g) -> list[tuple[np.ndarray, np.ndarray]]:
    return [tuple(unpacked(x, *HEAD)[:2]) for x in g["head"]]


def raised(heads: DataFrame) -> DataFrame:
    """run, radix, head: the heads (run, radix, head, team) of a team as one."""

    def up(key, g):
        found = [(pair, total) for pair, total, _ in merged(_read_heads(g))]
        pairs, totals = np.array([p for p, _ in found], np.uint64), np.array([t for _, t in found], np.int64)
        return pd.DataFrame({"run": [key[1]], "radix": [key[0]], "head": [packed(pairs, totals, totals)]})

    above = heads.groupBy("radix", "team").applyInPandas(up, "run long, radix int, head binary")
    return stage(above, "pair-heads")


def teams(heads: DataFrame, n_runs: int, fan: int) -> tuple[DataFrame, int]:
    n = -(-n_runs // fan)
    return heads.withColumn("team", F.pmod(F.xxhash64("run"), F.lit(n).cast("long"))), n


def answers(heads: DataFrame, n_runs: int, fan: int = FAN) -> DataFrame:
    """run, radix, answer of heads (run, radix, head); no task merges more than
    about ``fan`` of them."""

    def final(key, g):
        return _answer_rows(g, answered(merged(_read_heads(g)), len(g)))

    if n_runs <= fan:
        return heads.groupBy("radix").applyInPandas(final, "run long, radix int, answer binary")

    def down(key, g, back):
        own = _read_heads(g)
        total, best = unpacked(back["answer"].iloc[0], *ANSWER)
        pairs = np.unique(np.concatenate([p for p, _ in own]))  # as the team's head has them
        places = [np.searchsorted(pairs, p) for p, _ in own]
        return _answer_rows(g, [(total[at], best[at]) for at in places])

    dealt, n = teams(heads, n_runs, fan)
    back = answers(raised(dealt), n, fan).withColumnRenamed("run", "team")
    return dealt.groupBy("radix", "team").cogroup(back.groupBy("radix", "team")).applyInPandas(
        down, "run long, radix int, answer binary")


def contributions(bodies: DataFrame, back: DataFrame) -> DataFrame:
    """run, place, n_best, count_sum of the documents with links."""

    def add(key, g, a):
        by_radix = dict(zip(a["radix"], a["answer"]))
        best, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radix, head, body in zip(g["radix"], g["head"], g["body"]):
            records = unpacked(head, *HEAD)[2]
            place, times = unpacked(body, *BODY)
            count, top = (np.repeat(x, records).astype(np.int64) for x in unpacked(by_radix[radix], *ANSWER))
            more = int(place.max()) + 1 - len(best)
            if more > 0:
                best, total = (np.append(x, np.zeros(more, np.int64)) for x in (best, total))
            np.add.at(best, place, top * times)
            np.add.at(total, place, count * times)
        at = np.flatnonzero(total)
        return pd.DataFrame({"run": key[0], "place": at.astype(np.int32), "n_best": best[at], "count_sum": total[at]})

    # a group is one run
    return bodies.groupBy("run").cogroup(back.groupBy("run")).applyInPandas(
        add, "run long, place int, n_best long, count_sum long")


def pair_runs(docs: DataFrame, id_col: str, text_col: str, path_a: str | None, path_b: str | None, groups: bool,
              radix_bits: int | None, spill: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows of documents, rows of runs, and the number of runs; written once."""
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    if radix_bits is None:  # about one part a shuffle partition
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        radix_bits = min(max((partitions - 1).bit_length(), 4), 15)
    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
    rows = stage(spilled(own, path_a, path_b, radix_bits, spill, groups), "pair-runs")
    runs = rows.where(F.col("radix").isNotNull())
    return rows.where(F.col("radix").isNull()), runs, runs.select("run").distinct().count()


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
              path_b: str | None = None, groups: bool = False, radix_bits: int | None = None, spill: int = SPILL,
              fan: int = FAN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per
    row; ``groups`` adds the groups themselves, as texts in order."""
    rows, runs, n = pair_runs(docs, id_col, text_col, path_a, path_b, groups, radix_bits, spill)
    back = answers(runs.select("run", "radix", "head"), n, fan)
    sums = contributions(runs.select("run", "radix", "head", "body"), back)
    rows = rows.select("doc_id", "run", "place", *COUNTS, "groups_sha256", *(["groups"] if groups else []))
    rows = rows.join(sums, ["run", "place"], "left").drop("run", "place")
    return rows.fillna(0, ["n_best", "count_sum"])


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                path_b: str | None = None, radix_bits: int | None = None, spill: int = SPILL,
                fan: int = FAN) -> DataFrame:
    """b_id, a_id, links, best: the corpus-wide mapping between the vocabularies."""
    _, runs, n = pair_runs(docs, id_col, text_col, path_a, path_b, False, radix_bits, spill)
    heads = runs.select("run", "radix", "head")
    while n > fan:
        dealt, n = teams(heads, n, fan)
        heads = raised(dealt)

    def listed(key, g):
        pairs = np.array([p for p, _, _ in merged(_read_heads(g))], np.uint64)
        (links, best), = answered(((p, t, [0]) for p, t, _ in merged(_read_heads(g))), 1)
        low = np.uint64((1 << ID_BITS) - 1)
        return pd.DataFrame({"b_id": (pairs >> np.uint64(ID_BITS)).astype(np.int32), "a_id": (pairs & low).astype(np.int32),
                             "links": np.array(links, np.int64), "best": np.array(best, bool)})

    return heads.groupBy("radix").applyInPandas(listed, "b_id int, a_id int, links long, best boolean")
