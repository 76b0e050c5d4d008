import re
from collections import Counter, defaultdict

import pytest
from frames import table
from pyspark.sql import functions as F

from eventlink.llm import divergence as D
from eventlink.llm.divergence import source_divergence, terms_of

COLUMNS = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join([chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text])


def slow(rows, least=10, top=10):
    """Every kept term of a language against every source, zeros included."""
    n, df, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = WORD.findall(lower(text or ""))
        groups[lang].add(source)
        n[lang, source].update(words)
        total[lang].update(words)
        df[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in df[lang].items() if k >= least]
        v = len(kept)

        def share(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (size + 2 * v) for t in kept}

        p, q = {s: share(n[lang, s]) for s in sources}, share(total[lang])

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, cut in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:cut]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def got(df, **options):
    found = source_divergence(df, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def test_terms():
    for text in ["", "Ab-cD9e", "É é Öl", "a\x00b\x7fc", "語a 語", "don't @[`{ x_y", " \t\n"]:
        assert [t.decode() for t in terms_of(text.encode())] == WORD.findall(lower(text))


def test_smallest_table(spark):
    df = table(spark, "documents")
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
    assert got(df) == slow(rows)


@pytest.mark.parametrize("per_set", [64, 2])
def test_edges(spark, per_set, monkeypatch):
    """Nulls, ties, repeated rows, sources and languages without kept terms, one
    source alone, very long texts, more than one set of sources, many tables a task."""
    monkeypatch.setattr(D, "ENTRIES", 50)
    rows = [(i % 7, f"Common w{chr(97 + i % 5)} é{chr(97 + i % 3)} tie tied", "en", f"s{i % 9}") for i in range(200)]
    rows += [(5, None, "en", "quiet"), (6, "", "en", None), (7, "123 ...", "en", "digits"), (8, "rare words", "xx", "a"),
             (9, None, "xx", None), (None, "word " * 5, None, "lonely"), (None, None, None, None)]
    rows += [(k, "same same text", "fr", "only") for k in range(12)]
    rows += [(100, "common " * 20_000 + "x" * 100_000, "en", "s1"), (101, "common", "en", "s1"), (101, "common", "en", "s1")]
    df = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("x") for c in ("n", "term", "side", "p", "rank")})
    assert got(df, per_set=per_set) == slow(rows)
    assert got(df, per_set=per_set, least_docs=1, top=3) == slow(rows, 1, 3)


def test_many_counts(spark):
    """Blocks whose terms all have counts of their own, and counts beyond 32 bits of scale."""
    rows = [(i, " ".join([f"{chr(97 + k % 26)}{chr(97 + k // 26)} " * ((k * (i % 3 + 1)) % 97) for k in range(300)]),
             "en", f"s{i % 3}") for i in range(12)]
    assert got(spark.createDataFrame(rows, COLUMNS)) == slow(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], COLUMNS)) == []
