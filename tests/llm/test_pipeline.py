import pytest
from frames import docs, table, texts
from test_host_quality import slow_measures
from test_secret_scan import slow_base
from test_simhash import slow_groups, slow_print
from test_tokens import check_packing
from test_winnow import slow as slow_hits

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from eventlink.llm.packing import pack  # noqa: E402
from eventlink.llm.secret_scan import redacted, train  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark):
    """Every stage on all that its predecessor kept."""
    items = [tuple(r) for r in table(spark, "benchmark").collect()]
    df, rows = table(spark, "documents"), dict(texts(spark))
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]

    def after(name, want):
        nonlocal df, rows
        df = steps[name](spark, df, SF)
        assert df.columns == COLUMNS
        got = {r["doc_id"]: r["text"] for r in df.collect()}
        assert got == want
        assert len(got) < len(rows) or name == "secret_scans"
        rows = want

    def good(text):
        n, _, _, _, repeat = slow_measures(text)
        return n >= 50 and 100 * repeat <= 50 * n

    after("quality_rules", {i: t for i, t in rows.items() if good(t)})
    prints = {i: slow_print(t) for i, t in rows.items()}
    root = slow_groups(set(prints.values()))
    first = {}
    for i in sorted(rows):
        first.setdefault(root[prints[i]], i)
    after("simhash_near_dedup", {i: rows[i] for i in first.values()})
    bad = {r[0] for r in slow_hits(list(rows.items()), items) if r[-1]}
    after("benchmark_decontamination", {i: t for i, t in rows.items() if i not in bad})
    ratio = train(df)
    after("secret_scans", {i: redacted(t, ratio) for i, t in rows.items()})
    assert not any(slow_base(t) for t in rows.values())
    assert {r["doc_id"]: r["n_chars"] for r in df.collect()} == {i: len(t) for i, t in rows.items()}
    check_packing(pack(df), list(rows.items()))
    last = steps["packing"](spark, df, SF)
    assert {r["doc_id"] for r in last.collect()} == set(rows)
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, ran.collect()))[:50] and ran.columns == last.columns
    assert {(r["doc_id"], r["start"], r["length"]) for r in ran.collect()} and {r["doc_id"] for r in ran.collect()} == set(rows)


def test_edge_rows_pass_every_stage(spark):
    long = " ".join(f"long{i}" for i in range(60_000))
    some = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, some), (3, some), (None, some + " more of it here"), (4, long, None)]
    df = docs(spark, rows, extra=("row", "digest", "ids"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        for frame in (df, df.limit(0)):
            out = step(spark, frame, SF)
            assert out.columns == df.columns, name
            assert out.count() <= frame.count()
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, df, SF).select("doc_id").distinct().count() == 5 and last(spark, df.limit(0), SF).count() == 0
