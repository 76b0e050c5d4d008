import random
import zlib

import numpy as np
from frames import docs, table

from eventlink.llm.toxicity import DIMS, FOLDS, Active, fit, terms, toxicity, train


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(len(s))
    return (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_pairs_that_add_up_to_nothing():
    """Insult with group mention is toxic, either alone is not."""
    rng = random.Random(6)
    lists, y = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"n{rng.randrange(50)}" for _ in range(6)] + ["insult"] * insult + ["group"] * group
        lists.append(np.array(terms(" ".join(words))))
        y.append(int(insult and group))
    model = fit(lists[:3000], np.array(y[:3000]))
    score = lambda t: model.score(terms(t))
    assert score("insult group n1") > 0.5 > max(score("insult n1"), score("group n1"), score("n1"), score(""))
    # one who adds weights only cannot rank the pair above the sum of its parts
    one, other, both = (np.log(p / (1 - p)) for p in map(score, ("insult", "group", "insult group")))
    assert both - one > other - np.log(score("") / (1 - score("")))
    held = np.array([model.score(list(x)) for x in lists[3000:]])
    assert auc(np.array(y[3000:]), held) > 0.99


def test_pairs_of_neutral_words():
    """Toxic when one of two words stands without the other: neither tells anything alone."""
    rng = random.Random(9)
    lists, y = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"n{rng.randrange(50)}" for _ in range(6)] + ["insult"] * insult + ["group"] * group
        lists.append(np.array(terms(" ".join(words))))
        y.append(int(insult != group))
    model = fit(lists[:3000], np.array(y[:3000]))
    score = lambda t: model.score(terms(t))
    assert min(score("insult n1"), score("group n1")) > 0.5 > max(score("insult group n1"), score("n1"))
    held = np.array([model.score(list(x)) for x in lists[3000:]])
    assert auc(np.array(y[3000:]), held) > 0.95


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity(table(spark, "documents", sf), table(spark, "labels", sf)).where("held_out").collect()
    truth = {r["doc_id"]: r["toxic"] for r in table(spark, "labels", sf).collect()}
    known = [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["doc_id"] in truth]
    y, s, p = (np.array(x) for x in zip(*known))
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % FOLDS == 0 for r in rows)
    assert auc(y, s) > 0.97 and (p[y == 1]).mean() > 0.85 and p[y == 0].mean() < 0.01


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "you idiot scum " * 3), (None, "idiot"), (4, "idiot " * 30_000), (4, "idiot " * 30_000)]
    rows += [(10 + i, f"you idiot n{i % 7}" if i % 2 else f"kind words n{i % 7}") for i in range(200)]
    df = docs(spark, rows, extra=("toxic", "score", "terms", "held_out"))
    labels = [(i, 1, i % 2) for i in range(10, 210)] + [(10, 1, None), (None, 1, 1), (11, 0, 1), (11, 0, 1), (5000, 1, 1), (3, 1, 7)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity(df, known).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[4]["predicted"] == 1 and by[1]["score"] == by[2]["score"] and by[1]["predicted"] == 0
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["score"] for r in toxicity(df, known.limit(0)).collect()] == [0.0] * len(rows)
    assert toxicity(df.limit(0), known).count() == 0


def test_held_out_labels_are_never_read(spark):
    df = docs(spark, [(i, f"bad n{i % 9}" if i % 2 else f"good n{i % 9}") for i in range(300)])
    truth = [(i, i % 2) for i in range(300)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in truth]
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity(df, spark.createDataFrame(x, "doc_id long, toxic int")).collect())
              for x in (truth, turned)]
    assert scores[0] == scores[1]


def test_scores_equal_brute_force(spark):
    """The fit on whole term lists, and every pair of a text's terms on its own."""
    rng = random.Random(3)
    extra = [(10**6, " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(20_000)) + " idiot"), (10**6 + 1, "")]
    sf = "/root/testdata/sf0.01"
    df = table(spark, "documents", sf).select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    labels = table(spark, "labels", sf).select("doc_id", "toxic").union(
        spark.createDataFrame([(10**6, 1), (10**6 + 1, 0)], "doc_id long, toxic int"))
    text = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    truth = {}
    for r in labels.collect():
        if r["toxic"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            truth[r["doc_id"]] = max(r["toxic"], truth.get(r["doc_id"], 0))
    ids = sorted(set(truth) & set(text))
    model = fit([np.array(terms(text[i]), np.int64) for i in ids], np.array([truth[i] for i in ids]))
    assert len(model.row) > 20
    for r in toxicity(df, labels).collect():
        rows = [model.row[p] for p in terms(text[r["doc_id"]]) if p in model.row]
        z = model.bias + sum(model.weights[a] for a in rows)
        z += sum(model.factors[a] @ model.factors[b] for k, a in enumerate(rows) for b in rows[:k])
        assert abs(r["score"] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


def test_active_places_are_the_model_s(spark):
    model = train(table(spark, "documents").select("doc_id", "text"), table(spark, "labels").select("doc_id", "toxic"))
    active = Active(model)
    for r in table(spark, "documents").limit(30).collect():
        assert active.places(r["text"]) == [p for p in terms(r["text"]) if p in model.row]
    assert max(model.row) < DIMS
