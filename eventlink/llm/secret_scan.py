"""Secret scans: fixed patterns, and strings that look random to two Markov models.

Bigram models over the characters of keys are trained from labelled samples.
Random strings are what the fixed patterns match in the corpus, in equal shares
with a uniform model, which stands for keys of any other alphabet.  Ordinary
identifiers are, in equal shares, the corpus's own runs of eight or more such
characters that no pattern touches (also in capitals, which running text seldom
shows) and a made sample of what code holds: common words joined in camel case,
as constants, by signs and as paths, rulers of one sign, and the alphabet in
order.  Shares, not counts, are mixed, so the models are alike at every size of
the corpus.  All documents are counted; each task returns two tables of fixed
size.  Twenty or more characters of a run that no pattern covers, also beside
one that does, are a secret when the mean log-likelihood ratio of a pair of
neighbours exceeds ``threshold``; the mean does not grow with the length.

Defined cases: a null or empty text holds none, and stays as it is; a very long
text is scanned whole, a run of any length gets one score; repeated rows are
each scanned; an empty table trains on the made sample alone and gives an empty
result; columns other than the named ones are ignored, or kept by
:func:`redact`.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import take_columns, text_of

#: Fixed values of the contract: kinds in order, pattern, group and least length.
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
#: A text without any of these (lower-cased) has no match of that kind.
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",)}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = re.compile(rf"[{re.escape(ALPHABET)}]{{8,}}")
STATES = len(ALPHABET) + 1  # the last state is the end of a string
CODES = np.full(256, STATES - 1, np.uint8)
CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
LEAST = 20
#: Share of the uniform model in the random and in the ordinary class.
UNIFORM = (0.5, 0.02)
THRESHOLD = 0.5
RULER = 400
MARK = "[SECRET]"
#: Labelled sample: words that identifiers of code and paths are made of.
WORDS = """abstract access account action active adapter address admin agent alias allow amount analysis append
application argument array attribute audio background backup balance banner batch billing binary block border bottom
bridge browser bucket buffer build button cache calendar callback cancel channel character checkout client cluster
color column command comment common company compile complete component config connect content context control cookie
counter country create currency current custom database default delete deploy detail device dialog directory display
document domain download driver dynamic element email enable engine entity error event example exception execute
expire export factory feature field filter folder footer format forward frame function gallery gateway generate global
group handler hardware header height history identity image import include index initial insert install instance
integer interface internal invoice item iterator journal keyboard kernel label language latest launch layout library
license limit linux listener local location logger machine manager mapping market maximum member memory menu message
method minimum mobile model module monitor mouse network notify number object observer offset option order output
package""".split()


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind's place, end, value) of the fixed patterns, by start and kind."""
    found, low = [], text.lower()
    for place, (kind, pattern, group, least) in enumerate(KINDS):
        if kind in HINTS and not any(h in low for h in HINTS[kind]):
            continue
        found += [(m.start(), place, m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def other_runs(text: str, base: list, least: int) -> Iterator[tuple[int, int]]:
    """Runs of the alphabet, ``least`` characters or longer, that touch no base span."""
    for m in RUN.finditer(text):
        if m.end() - m.start() >= least and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            yield m.start(), m.end()


def open_pieces(text: str, base: list, least: int) -> Iterator[tuple[int, int]]:
    """What base spans leave of the runs of the alphabet, in pieces of ``least`` characters or more."""
    for m in RUN.finditer(text):
        at = m.start()
        for s, _, e, _ in base:
            if s < m.end() and at < e:
                if s - at >= least:
                    yield at, s
                at = max(at, e)
        if m.end() - at >= least:
            yield at, m.end()


def pair_counts(strings: list[str]) -> np.ndarray:
    """Counts of neighbouring characters, ends included."""
    if not strings:
        return np.zeros(STATES * STATES, np.int64)
    codes = CODES[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("latin-1", "replace"), np.uint8)].astype(np.int64)
    return np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES * STATES)


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio, random to ordinary, of every pair of characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, STATES * STATES), np.int64)
        for b in batches:
            for lo in range(0, len(b), 500):
                random, ordinary = [], []
                for text in b["text"].iloc[lo:lo + 500]:
                    base = base_spans(text)
                    random += [value for *_, value in base]
                    ordinary += [text[s:e] for s, e in other_runs(text, base, 8)]
                sums[0] += pair_counts(random)
                sums[1] += pair_counts(ordinary) + pair_counts([x.upper() for x in ordinary])
        cls, pair = np.nonzero(sums)
        yield pd.DataFrame({"cls": cls.astype(np.int32), "pair": pair.astype(np.int32), "n": sums[cls, pair]})

    own = take_columns(docs, text=text_col).select(text_of("text").alias("text"))
    rows = own.mapInPandas(run, "cls int, pair int, n long").groupBy("cls", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, STATES * STATES))
    for r in rows:  # two tables of STATES * STATES at most
        counts[r["cls"], r["pair"]] = r["n"]
    return log_ratio(counts)


def made_identifiers() -> list[str]:
    """The made sample of ordinary strings."""
    out = [sign * RULER for sign in ALPHABET]
    out += [x * len(WORDS) for x in (string.ascii_uppercase, string.ascii_lowercase, string.digits)]
    for step in (1, 7, 31, 64):
        for i, first in enumerate(WORDS):
            few = [first, WORDS[(i + step) % len(WORDS)], WORDS[(i + 3 * step) % len(WORDS)]]
            titled = [w.capitalize() for w in few]
            out += ["".join(titled), first + "".join(titled[1:]), "_".join(few).upper(), "_".join(few), "-".join(few),
                    "/" + "/".join(few) + "/", "".join(titled) + str(i % 10), "_".join([*few, str(i)]),
                    "/".join([*few[:2], "".join(titled)]), f"{1970 + i % 80}-{1 + i % 12:02}-{1 + i % 28:02}"]
    return out


def shares(counts: np.ndarray) -> np.ndarray:
    """Share of each character behind each; uniform behind one that was not seen."""
    total = counts.sum(axis=1, keepdims=True)
    return np.where(total > 0, counts / np.maximum(total, 1), 1 / STATES)


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Of the pair counts of the corpus, random and ordinary."""
    random, ordinary = (shares(x) for x in counts.reshape(2, STATES, STATES))
    made = shares(pair_counts(made_identifiers()).reshape(STATES, STATES))
    if not counts.reshape(2, -1)[1].any():
        ordinary = made
    models = [(1 - u) * x + u / STATES for x, u in zip((random, (ordinary + made) / 2), UNIFORM)]
    return (np.log(models[0]) - np.log(models[1])).ravel()


def score(text: str, ratio: np.ndarray) -> float:
    """Mean log-likelihood ratio of the pairs of neighbours, ends included."""
    codes = CODES[np.frombuffer(f"\n{text}\n".encode("latin-1", "replace"), np.uint8)].astype(np.int64)
    return float(ratio[codes[:-1] * STATES + codes[1:]].mean())


def spans(text: str, ratio: np.ndarray, threshold: float = THRESHOLD) -> tuple[list, list]:
    """Base spans, and all spans as (start, kind's place, end)."""
    base = base_spans(text)
    more = [(s, len(KINDS), e) for s, e in open_pieces(text, base, LEAST) if score(text[s:e], ratio) > threshold]
    return base, sorted([x[:3] for x in base] + more)


def _joined(found: list) -> str:
    names = [k[0] for k in KINDS] + ["markov"]
    return ",".join(f"{names[x[1]]}:{x[0]}:{x[2]}" for x in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans per row."""
    ratio = train(docs, text_col)
    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                base, found = spans(text, ratio, threshold)
                n = [sum(x[1] == k for x in base) for k in range(len(KINDS))]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
            made = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            made.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield made

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInPandas(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, ratio: np.ndarray, threshold: float = THRESHOLD, mark: str = MARK) -> str:
    """The text with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in spans(text, ratio, threshold)[1]:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           threshold: float = THRESHOLD, mark: str = MARK) -> DataFrame:
    """All rows and columns of ``docs``, with the secrets of the text replaced and
    its length column, if there is one, brought up to date where it changed."""
    ratio = train(docs, text_col)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: x if x is None or x is pd.NA else redacted(x, ratio, threshold, mark))

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = out.withColumn("clean", clean(F.col("row").getField(text_col).cast("string")))
    old = F.col("row").getField(text_col)
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text_col:
            value = F.col("clean").cast(docs.schema[c].dataType)
        elif c == length_col:
            value = F.when(old.eqNullSafe(F.col("clean")), value).otherwise(
                F.char_length("clean").cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return out.select(*columns)
