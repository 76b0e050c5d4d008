"""Scans of the driver tables and of the fixture views built over them.

``Fixtures(spark, sf_dir)`` hands out DataFrames; projection and filters of the
operators reach the parquet scan through the views (Catalyst inlines them).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize
from .fixture_sql import FIXTURE_SQL

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_FX_NAME = re.compile(r"\bfx_\w+\b")
#: The join of the two largest tables, as the fact views write it.
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
#: The columns of a fact view that its dictionaries are the distinct rows of, and those dictionaries.
_CODES = {"fx_dx": (("dx_type", "dx"), ("fx_dict9", "fx_dict10")),
          "fx_px": (("px_type", "px"), ("fx_pxdict9", "fx_pxdict10"))}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_deps(name: str) -> list[str]:
    """Fixture views ``name`` reads, transitively, in creation order (itself last)."""
    order = list(FIXTURE_SQL)
    needed: set[str] = set()

    def visit(n: str) -> None:
        if n in needed:
            return
        needed.add(n)
        for dep in _FX_NAME.findall(FIXTURE_SQL[n]):
            if dep != n and dep in FIXTURE_SQL:
                visit(dep)

    visit(name)
    return [n for n in order if n in needed]


def fixture_ctes(*names: str) -> str:
    """``WITH`` clause defining the given fixtures (and what they read) for SQL oracles."""
    wanted: list[str] = []
    for n in names:
        for d in fixture_deps(n):
            if d not in wanted:
                wanted.append(d)
    order = [n for n in FIXTURE_SQL if n in wanted]
    return "WITH " + ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n].strip()}\n)" for n in order)


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self._kept: set[str] = set()
        self._codes: dict[str, DataFrame] = {}
        self._lines: DataFrame | None = None
        self._tag = uuid.uuid4().hex[:8]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def _bound_sql(self, sql: str, of: str) -> tuple[str, list[str]]:
        """Register the tables/views that the text of the fixture ``of`` reads under
        names private to this instance and return the text rewritten to use them, so
        no session-wide view such as ``orders`` is created or replaced."""
        def alias(name: str) -> str:
            return f"__eventlink_{self._tag}_{name}"

        views = []
        if self._lines is not None and _LINES in sql:
            self._lines.createOrReplaceTempView(alias("lines"))
            views.append(alias("lines"))
            sql = sql.replace(_LINES, alias("lines"))
        words = set(re.findall(r"\b\w+\b", sql))
        for t in DRIVER_TABLES:
            if t in words:
                self.table(t).createOrReplaceTempView(alias(t))
                views.append(alias(t))
                sql = re.sub(rf"\b{t}\b", alias(t), sql)
        # a dictionary of distinct codes is the same over the distinct codes
        codes = {n: df for n, df in self._codes.items() if of in _CODES[n][1]}
        for n, df in (self._built | codes).items():
            if n in words:
                df.createOrReplaceTempView(alias(n))
                views.append(alias(n))
                sql = re.sub(rf"\b{n}\b", alias(n), sql)
        return sql, views

    def get(self, name: str) -> DataFrame:
        if name not in FIXTURE_SQL:
            raise KeyError(f"unknown fixture {name!r}")
        for n in fixture_deps(name):
            if n not in self._built:
                sql, views = self._bound_sql(FIXTURE_SQL[n], n)
                self._built[n] = self.spark.sql(sql)  # analysed now: the views are resolved into the plan
                for v in views:
                    self.spark.catalog.dropTempView(v)
        return self._built[name]

    def keep(self, name: str, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """The fixture ``name`` with its rows written once by ``stage``; fixtures
        over it that are built later read those rows too."""
        if name not in self._kept:
            self._built[name] = stage(self.get(name), name)
            self._kept.add(name)
        return self._built[name]

    def codes(self, name: str, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """The distinct codes of the fact view ``name``, with their types, written once by
        ``stage``; its dictionaries that are built later read them in place of the facts."""
        if name not in self._codes:
            self._codes[name] = stage(self.get(name).select(*_CODES[name][0]).distinct(), f"{name}-codes")
        return self._codes[name]

    def keep_lines(self) -> None:
        """Join lineitem and orders and write the rows once, with the columns that the
        fact views take; views over the join that are built later read those rows."""
        if self._lines is None:
            texts = " ".join(sql.replace(_LINES, "") for sql in FIXTURE_SQL.values() if _LINES in sql)
            words = set(re.findall(r"\b\w+\b", texts))
            lines, orders = self.table("lineitem"), self.table("orders")
            both = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
            self._lines = materialize(both.select(*[c for c in both.columns if c in words]), "lines")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self.get(name)
        raise AttributeError(name)
