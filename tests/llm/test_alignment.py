import gc
import hashlib
import random
from collections import Counter
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from frames import docs, table, texts
from tokenizers import Tokenizer

from eventlink.llm import alignment as M
from eventlink.llm.alignment import Aligner, alignment, answered, merged, pair_counts
from eventlink.llm.byte_bpe import byte_chars

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "a\n\nb", "x\ty", "don't 'll", "<|endoftext|> <s> <unk> <0x41>", "é é ́x",
       "日本 語 です", "1234 5,678.90", "a\x1cb \x1d c\x1f\x00", "😀 👍🏽 x", "co­op", "mark▁in word", "▁", "a ▁ b", "tab\t end\r\n",
       "a" * 3000, "語" * 500, " ".join("ab" * 500), "x   y", "ﬁ Ａ"]


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@cache
def names():
    a, b = libraries()
    back = {c: i for i, c in enumerate(byte_chars())}
    of_a = [bytes([back[c] for c in a.id_to_token(i)]) for i in range(a.get_vocab_size())]
    of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(b.id_to_piece(list(range(b.vocab_size()))))]
    return of_a, of_b


def ranges(ids, of):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(of[i])))
        at += len(of[i])
    return out


def slow_links(text):
    """Tokens of the whole text, links by comparing every two ranges nearby, groups."""
    a, b = libraries()
    if not text:
        return None
    ra = ranges(a.encode(" " + text, add_special_tokens=False).ids, names()[0])
    rb = ranges(b.encode(text), names()[1])
    want = (" " + text).encode()
    if b"".join(names()[0][i] for i, _, _ in ra) != want or b"".join(names()[1][i] for i, _, _ in rb) != want:
        return None
    ends = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
    groups, lo = [], 0
    for e in ends:
        groups.append("|".join(",".join(str(i) for i, s, f in r if lo <= s and f <= e) for r in (ra, rb))
                      if len(want) < 2000 else (lo, e))
        lo = e
    links, j = [], 0
    for i, s, f in ra:
        while rb[j][2] <= s:
            j += 1
        k = j
        while k < len(rb) and rb[k][1] < f:
            links.append((rb[k][0], i))
            k += 1
    return len(ra), len(rb), groups, links


def slow(rows):
    found = [(d, slow_links(x)) for d, x in rows]
    count = Counter(p for _, f in found if f for p in f[3])
    top = {}
    for (b, _), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for d, f in found:
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if isinstance(groups[0], str) else None
        out.append((d, n_a, n_b, len(groups), len(links), sum(count[p] == top[p[0]] for p in links),
                    sum(count[p] for p in links), digest))
    return out, count, top


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(df, rows, **options):
    got = sorted([tuple(r[c] for c in COLUMNS) for r in alignment(df, **options).collect()], key=str)
    want = sorted(slow(rows)[0], key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7] and w[7] in (None, g[7])


def test_stretches_equal_whole_texts():
    rng = random.Random(5)
    marks = [" ", " ", "  ", "\n", "\t", "\x1c", "a", "Thing", "é", "́", ".", ",", "'s", "1", "ß", "<|endoftext|>", "語", "😀", "ö,",
             "\u0085", "▁", "the"]
    aligner = Aligner(A, B)
    made = ODD + ["".join(rng.choices(marks, k=rng.randint(1, 25))) for _ in range(3000)]
    for lo in range(0, len(made), 100):
        some = made[lo:lo + 100]
        for x, at in zip(some, aligner.align(some)):
            want = slow_links(x)
            assert (want is None) == (not at), repr(x)
            if want:
                assert aligner.sizes[at].sum(0).tolist() == [want[0], want[1], len(want[2]), len(want[3])], repr(x)
                if len(x) < 1500:
                    assert [g for i in at for g in aligner.groups[i].split(";")] == want[2], repr(x)


def test_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(M, "KEPT", 5)
    aligner = Aligner(A, B)
    for k in range(20):
        some = [f"w{k} w{k + 1} " + "x" * 200 + str(k), "again and again"]
        for x, at in zip(some, aligner.align(some)):
            assert aligner.sizes[at].sum(0)[0] == slow_links(x)[0]
        assert len(aligner.groups) <= 5 + 6 and aligner.short <= 5 + 5


def test_merge_and_highest():
    heads = [([5, 9 << 20, (9 << 20) + 1], [1, 2, 3]), ([9 << 20], [1]), ([], []), ([5, (9 << 20) + 1], [4, 0])]
    import numpy as np

    runs = [(np.array(p, np.uint64), np.array(n, np.int64)) for p, n in heads]
    assert [(p, n) for p, n, _ in merged(runs)] == [(5, 5), (9 << 20, 3), ((9 << 20) + 1, 3)]
    assert answered(merged(runs), 4) == [([5, 3, 3], [True, True, True]), ([3], [True]), ([], []), ([5, 3], [True, True])]


def test_smallest_table(spark):
    check(table(spark, "documents"), texts(spark))


@pytest.mark.parametrize("options", [{}, {"spill": 300, "fan": 2, "radix_bits": 2}, {"spill": 1, "fan": 3, "radix_bits": 4}])
def test_edges(spark, options):
    rows = texts(spark)[:60] + [(90_000 + i, x) for i, x in enumerate(ODD)] + [
        (None, "a b"), (5, None), (5, None), (6, "word " * 5_000), (7, "same text"), (7, "same text"), (8, "x" * 20_000)]
    df = docs(spark, rows, extra=("run", "place", "radix", "head", "n_a")).repartition(5)
    check(df, rows, **options)


def test_groups_and_pairs(spark):
    rows = texts(spark)[:40]
    df = docs(spark, rows)
    for r in alignment(df, groups=True).collect():
        want = slow_links(dict(rows)[r["doc_id"]])
        if want and isinstance(want[2][0], str):
            assert r["groups"] == want[2]
    _, count, top = slow(rows)
    for options in ({}, {"spill": 500, "fan": 2}):
        got = {(r["b_id"], r["a_id"]): (r["links"], r["best"]) for r in pair_counts(df, **options).collect()}
        assert got == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_empty(spark):
    df = docs(spark, [(1, "a")]).limit(0)
    assert alignment(df).count() == 0
    assert alignment(docs(spark, [(1, None), (2, "")])).select("n_links").collect() == [(0,), (0,)]


def test_links_and_groups_of_any_two_cuts():
    """Each range between neighbouring ends is a link, ends that both share part the groups."""
    draw = random.Random(3)
    for _ in range(300):
        n = draw.randint(1, 9)
        cuts = [sorted({n, *draw.sample(range(1, n + 1), draw.randint(0, n))}) for _ in "ab"]
        ids = [[draw.randrange(90) for _ in c] for c in cuts]
        tokens = [[b"x" * (hi - lo) for lo, hi in zip([0, *c], c)] for c in cuts]
        at = lambda k, end: sum(e < end for e in cuts[k])
        keys = [(ids[1][at(1, e)] << M.ID_BITS | ids[0][at(0, e)]) << M.PLACE_BITS for e in sorted({*cuts[0], *cuts[1]})]
        shared = sorted({*cuts[0]} & {*cuts[1]})
        groups = ["|".join(",".join(str(i) for i, e in zip(ids[k], cuts[k]) if lo < e <= hi) for k in (0, 1))
                  for lo, hi in zip([0, *shared], shared)]
        assert M.linked(*ids, *tokens) == (keys, groups)


def test_kept_stretches_are_not_collected_again():
    """Each full collection of a task went through all stretches that it keeps."""
    aligner = Aligner(A, B)
    try:
        aligner.align(["some words, and more words\nbehind a line end", "", "more"])
        tracked = {id(x) for x in gc.get_objects()}
        assert id(aligner.places) not in tracked and id(aligner.groups) not in tracked
        assert not any(id(made) in tracked for made in aligner.atoms.values()) and aligner.atoms
    finally:
        gc.unfreeze()
