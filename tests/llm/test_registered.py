import re

import __spark_entry__ as entry


def test_every_operator_has_one_query():
    found = [m[1] for m in map(re.compile(r"op(\d+)_").match, entry.queries()) if m]
    assert sorted(map(int, found)) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_come_in_order():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]
