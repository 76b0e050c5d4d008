"""Quality rules judged per host.

Each document gets rule measures from native array functions.  The failures of
every rule are summed by host, each host's rate is shrunk towards a beta prior
that is fitted to all hosts (method of moments), and the verdict of the host is
joined back to its documents.

Defined cases: a null text has no words and fails the base rule; a null host is
no host, such documents are judged by the base rule alone; repeated rows each
count and are each judged; an empty table gives an empty result; columns other
than the three named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stage, take_columns, text_of

#: Fixed values of the contract.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Further rules that only count towards the verdict of a host.
MAX_SYMBOLS_PER_WORD = 0.1
WORD_LENGTH = (2.0, 15.0)
MAX_HOST_RATE = 0.8

RULES = ("short", "repeated", "symbols", "word_length")


def _covered(positions: Column, width: int) -> Column:
    """How many places the windows that start at these sorted, distinct
    positions cover together."""
    gaps = F.zip_with(F.slice(positions, 1, F.size(positions) - 1),
                      F.slice(positions, 2, F.size(positions) - 1),
                      lambda a, b: F.least(F.lit(width), b - a))
    inner = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)
    return F.when(F.size(positions) == 0, F.lit(0)).otherwise(inner + width)


def _repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found more than once."""

    def windows(ws: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ws) - width + 1),
                           lambda i: F.concat_ws(" ", *[F.element_at(ws, i + k) for k in range(width)]))

    def placed(grams: Column) -> Column:
        return F.array_sort(F.zip_with(grams, F.sequence(F.lit(1), F.size(grams)),
                                       lambda g, p: F.struct(g.alias("g"), p.alias("p"))))

    def doubles(rows: Column) -> Column:
        pairs = F.zip_with(F.slice(rows, 1, F.size(rows) - 1), F.slice(rows, 2, F.size(rows) - 1),
                           lambda a, b: F.when(a["g"] == b["g"], F.array(a["p"], b["p"])))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

    def covered(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
            bind(bind(placed(grams), doubles), lambda p: _covered(p, width)))

    return F.when(F.size(words) <= width, F.lit(0)).otherwise(bind(windows(words), covered))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _repeat_words(ws).cast("long").alias("n_repeat_words"))

    symbols = F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    words = F.array_remove(F.split(text, WHITE_SPACE, -1), "")
    return F.struct(
        bind(words, of_words).alias("w"),
        symbols.cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))


def measured(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the measures, the base rule and an array of failed rules."""
    m = docs.withColumn("_m", measures(text))
    m = m.select(*[c for c in docs.columns],
                 F.col("_m.w.n_words").alias("n_words"), F.col("_m.w.word_chars").alias("word_chars"),
                 F.col("_m.n_symbols").alias("n_symbols"), F.col("_m.n_dup_lines").alias("n_dup_lines"),
                 F.col("_m.w.n_repeat_words").alias("n_repeat_words"))
    n, mean = F.col("n_words"), F.try_divide("word_chars", "n_words")
    short = n < MIN_WORDS
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n
    symbols = F.col("n_symbols") > F.lit(MAX_SYMBOLS_PER_WORD) * n
    length = (n > 0) & ~F.coalesce(mean.between(*WORD_LENGTH), F.lit(False))
    return m.withColumns({
        "base_failed": short | repeated,
        "failed": F.array(*[x.cast("int") for x in (short, repeated, symbols, length)])})


def host_verdicts(rows: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: ``host``, ``host_failed``.

    For every rule: prior mean = failures over documents of all hosts; between-host
    variance = weighted variance of the rates less the binomial noise; prior
    strength = mean (1 - mean) / variance - 1, at least 1.  A host fails when the
    posterior mean of any rule exceeds ``max_rate``."""
    k = range(len(RULES))
    hosts = (rows.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("failed")[i]).alias(f"f{i}") for i in k]))
    hosts = stage(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("hosts"),
                      *[(F.sum(f"f{i}") / F.sum("n")).alias(f"m{i}") for i in k],
                      *[F.sum(F.col(f"f{i}") * F.col(f"f{i}") / F.col("n")).alias(f"q{i}") for i in k]).first()
    failed = F.lit(False)
    for i in k:
        mean = total[f"m{i}"]
        if not mean:  # no failure of this rule anywhere, or no host
            continue
        spread = mean * (1 - mean)
        variance = total[f"q{i}"] / total["docs"] - mean * mean - spread * total["hosts"] / total["docs"]
        strength = max(1.0, spread / variance - 1) if variance > 1e-9 else 1e9
        failed = failed | ((F.col(f"f{i}") + mean * strength) / (F.col("n") + strength) > max_rate)
    return hosts.select("host", failed.alias("host_failed"))


def judged(rows: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``rows`` of :func:`measured` with ``kept``.  Only rejected hosts take part
    in the join; their table is written first, so that Spark sees its size
    before it chooses between broadcasting it and splitting a hot host."""
    bad = stage(host_verdicts(rows, max_rate).where("host_failed"), "rejected-hosts")
    out = rows.join(bad, "host", "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_failed").isNull()).drop("host_failed")


def host_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, base rule and verdict per row: doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    own = take_columns(docs, doc_id=id_col, host=host_col, text=text_col)
    rows = stage(measured(own, text_of("text")).drop("text"), "quality")
    return judged(rows, max_rate).drop("host", "failed")


def keep_quality(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                 max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{host_col}`").alias("host"))
    rows = stage(measured(whole, F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))), "quality-rows")
    return judged(rows, max_rate).where("kept").select("row.*")
