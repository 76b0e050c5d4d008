import hashlib
import random
import sys

import public_tokenizers
import pytest
import tiktoken
from frames import docs, table, texts
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from eventlink.llm.byte_bpe import RANKS, ByteBpe, Decoder, Encoder, library_model, read_ranks
from eventlink.llm.pieces import sure

PATTERN = public_tokenizers.PATTERN
ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "a\n\nb", "x\ty", "don't 'll I'VE", "<|endoftext|> a<|endoftext|>",
       "é é ́x", "日本 語 です", "1234 5,678.90 ½", "a\x1cb \x1d c\x1f\x00", "😀 👍🏽 x", "co­op", "tab\t end\r\nnext", "a" * 3000,
       "語" * 2000, " ".join("ab" * 500), "Ünï cödé", "x y 　 z", "'s", " 's", "a 's", ".\n\n\n b"]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def wanted(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model(ranks):
    return library_model(ranks, PATTERN)


def ids_of(raw):
    return list(memoryview(raw).cast("I"))


def test_ids_equal_merging_by_rank(model, wanted):
    coder, back = Encoder(model, PATTERN), Decoder(model, PATTERN)
    rng = random.Random(11)
    marks = [" ", " ", "  ", "\n", "\t", "\x1c", "\u0085", "a", "Thing", "é", "Öl", "ÿ2", "́", ".", ",", "'s", "'", "1", "²", "ß", "<|",
             "Σ", "語", "😀", "ö,", "'LL", "\r\n", "12a"]
    made = ["".join(rng.choices(marks, k=rng.randint(1, 25))) for _ in range(4000)]
    for x in ODD + made:
        ids = ids_of(coder.encode(x))
        assert ids == wanted.encode_ordinary(x), repr(x)
        assert back.decode(ids) == x.encode()


def test_every_character(model, wanted):
    coder = Encoder(model, PATTERN)
    found = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    for lo in range(0, len(found), 1000):
        some = found[lo:lo + 1000]
        assert ids_of(coder.encode(" ".join(some))) == wanted.encode_ordinary(" ".join(some))
        for c in some[::7]:
            x = f"a{c}a 1{c}1 .{c}."
            assert ids_of(coder.encode(x)) == wanted.encode_ordinary(x)
    assert sum(map(sure, found)) > 100_000


def test_unreachable_tokens_and_ties():
    """A token whose bytes never merge to it counts as a whole match only; of
    equal pairs the leftmost merges first."""
    own = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"xyz": 258, b"bc": 259, b"abc": 260, b"ab": 261}
    coder = Encoder(library_model(own, PATTERN), PATTERN)
    want = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
    for x in ["aaa", "aaaa", "aaaaa", "xyz", "xyzz", "abc", "abcabc", "aabc", "aaabcc", "a xyz xyzxyz aaa"]:
        assert ids_of(coder.encode(x)) == want.encode_ordinary(x), x


def slow(rows, wanted):
    for doc, text in rows:
        ids = wanted.encode_ordinary(text or "")
        yield (doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256((text or "").encode()).hexdigest())


def test_round_trip(spark, wanted):
    rows = texts(spark) + [(90_000 + i, x) for i, x in enumerate(ODD)] + [
        (None, "a b"), (5, None), (5, None), (6, "word " * 30_000), (7, "語" * 40_000), (8, "x" * 50_000)]
    df = docs(spark, rows, extra=("ids", "bytes", "n_tokens", "byte_end"))
    got = [tuple(r) for r in ByteBpe(spark).round_trip(df).collect()]
    assert sorted(got, key=str) == sorted(slow(rows, wanted), key=str)
    assert ByteBpe(spark).round_trip(df.limit(0)).count() == 0


def test_offsets(spark, model, wanted):
    """Ends in bytes are running sums; characters are those that the library names."""
    library = Tokenizer.from_str(model)
    rows = texts(spark)[:80] + [(90_000 + i, x) for i, x in enumerate(ODD)]
    for r in ByteBpe(spark).encode(docs(spark, rows)).collect():
        x = dict(rows)[r["doc_id"]]
        raw, at = (x or "").encode(), 0
        for i, end in zip(r["ids"], r["byte_end"]):
            assert wanted.decode_single_token_bytes(i) == raw[at:end]
            at = end
        assert at == len(raw)
        assert list(zip(r["char_start"], r["char_end"])) == library.encode(x).offsets


def test_decoding_of_split_characters(spark, ranks):
    """Tokens of a cut sequence: whole characters come back, halves become U+FFFD
    in the text and stay in the bytes."""
    coder = ByteBpe(spark)
    first, second, third = [ranks[bytes([b])] for b in "語".encode()]
    df = spark.createDataFrame([(1, [first, second, third]), (2, [first, second]), (3, [third]), (4, None), (5, [])],
                               "doc_id long, ids array<int>")
    got = {r["doc_id"]: (bytes(r["bytes"]), r["text"]) for r in coder.decode(df).collect()}
    assert got[1] == ("語".encode(), "語")
    assert got[2][0] == "語".encode()[:2] and set(got[2][1]) == {"�"}
    assert got[3][0] == "語".encode()[2:] and set(got[3][1]) == {"�"}
    assert got[4] == got[5] == (b"", "")
    with pytest.raises(PythonException, match="vocabulary"):
        coder.decode(spark.createDataFrame([(1, [50_300])], "doc_id long, ids array<int>")).collect()


def test_whole_table(spark, wanted):
    got = [tuple(r) for r in ByteBpe(spark).round_trip(table(spark, "documents")).collect()]
    assert sorted(got) == sorted(slow(texts(spark), wanted))
