"""Small inputs shared by the operator tests."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=()):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra
    columns whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit("x") for c in extra})


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark, sf=SF):
    return [(r["doc_id"], r["text"]) for r in table(spark, "documents", sf).select("doc_id", "text").collect()]
