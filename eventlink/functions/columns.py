"""Scalar column helpers (§2.2 predicates, §2.9 scalar functions).

All of them return ``Column`` expressions built from built-in functions, so
they stay inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text sentinels meaning "missing" in the source data.
SENTINELS = ("NI", "UN", "OT")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def least_strict(*cols: str | Column) -> Column:
    """``least`` that is NULL when any argument is NULL (H1).

    Spark's and DuckDB's ``least`` skip NULLs; the warehouse the reference ran on
    does not, and the exclusion rule P12 depends on it.
    """
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def between_rows(col: str | Column, lo: str | Column, hi: str | Column) -> Column:
    """Value within per-row bounds, inclusive."""
    return _c(col).between(_c(lo), _c(hi))


def not_sentinel(col: str | Column, values: Iterable[str] = SENTINELS) -> Column:
    """Non-null, non-blank after trim and not a sentinel (P10).  NULL input -> false."""
    t = F.trim(_c(col))
    return F.coalesce(t.isNotNull() & (t != F.lit("")) & ~t.isin(list(values)), F.lit(False))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` counted on date boundaries."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date")).cast("bigint")


def stay_length(admit: str | Column, discharge: str | Column) -> Column:
    """Length of stay in days; a same-day or unknown stay counts as 1."""
    d = days_between(admit, discharge)
    return F.coalesce(F.when(d != 0, d), F.lit(1).cast("bigint"))


def age_years(birth: str | Column, at: str | Column) -> Column:
    """Age in whole years, ``round(days / 365.25)``."""
    return F.round(days_between(birth, at) / F.lit(365.25)).cast("bigint")


def strip_zeros(col: str | Column) -> Column:
    """Remove leading zeros (``ltrim(x, '0')``)."""
    return F.regexp_replace(_c(col), r"^0+", "")


def group_code(col: str | Column) -> Column:
    """Normalise a 3-character group code: longer -> leading zeros stripped,
    shorter -> left-padded with zeros, else trimmed.  The value is trimmed first
    (the reference pads/strips the untrimmed value, H17)."""
    t = F.trim(_c(col))
    n = F.length(t)
    return (F.when(n > 3, strip_zeros(t))
            .when(n < 3, F.lpad(t, 3, "0"))
            .otherwise(t))


def strip_dots(col: str | Column) -> Column:
    return F.replace(_c(col), F.lit("."), F.lit(""))


def pad_right(col: str | Column, n: int, pad: str = "0") -> Column:
    return F.rpad(_c(col), n, pad)


def is_digits(col: str | Column) -> Column:
    """All-digit text (H2: ``[0-9]``, never a POSIX class)."""
    return _c(col).rlike(r"^[0-9]+$")


def try_number(col: str | Column, faithful: bool = False) -> Column:
    """Text to number without raising.  ``faithful`` mirrors a scale-0 numeric
    cast (rounds to integers) as the reference's warehouse did (H5)."""
    if faithful:
        return _c(col).try_cast("decimal(38,0)").cast("double")
    return _c(col).try_cast("double")


def recode_first(cols: Sequence[str | Column], mapping: Mapping[str, str],
                 missing: str = "NI", other: str = "OT",
                 missing_values: Iterable[str] = ("NI", "UN")) -> Column:
    """First non-null of ``cols`` (two-source precedence), then a code map;
    NULL or a missing sentinel -> ``missing``; unmapped -> ``other`` (P16)."""
    v = F.coalesce(*[_c(c) for c in cols])
    expr = None
    for k, lab in mapping.items():
        expr = (F.when(v == F.lit(k), F.lit(lab)) if expr is None
                else expr.when(v == F.lit(k), F.lit(lab)))
    miss = v.isNull() | v.isin(list(missing_values))
    expr = F.when(miss, F.lit(missing)) if expr is None else expr.when(miss, F.lit(missing))
    return expr.otherwise(F.lit(other))


def recode_any(cols: Sequence[str | Column], yes: str = "Y", no: str = "N",
               default: str = "NI") -> Column:
    """Any source says ``yes`` -> yes; else any says ``no`` -> no; else default."""
    cs = [_c(c) for c in cols]
    any_yes = F.lit(False)
    any_no = F.lit(False)
    for c in cs:
        any_yes = any_yes | F.coalesce(c == F.lit(yes), F.lit(False))
        any_no = any_no | F.coalesce(c == F.lit(no), F.lit(False))
    return F.when(any_yes, F.lit(yes)).when(any_no, F.lit(no)).otherwise(F.lit(default))


def clip_bucket(col: str | Column, cap: float | None = None,
                edges: Sequence[tuple[float, float | None, str]] = (),
                default: str | None = None) -> Column:
    """Clip at ``cap`` (P14) or, with ``edges`` = [(lo, hi, label)], bucket into
    ordered classes with a default label (P15).  ``hi=None`` is open-ended."""
    c = _c(col)
    if not edges:
        return F.when(c >= F.lit(cap), F.lit(cap).cast("bigint")).otherwise(c)
    expr = None
    for lo, hi, lab in edges:
        cond = c >= F.lit(lo) if hi is None else c.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))
