"""Text, code and identifier expressions (F10-F13, F18-F24) plus case-folded
comparison helpers.  No Python UDFs: everything is a Catalyst expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


_EXACT: ContextVar[bool] = ContextVar("exact_text", default=False)


@contextmanager
def exact_text():
    """Within this block ``ci_eq`` / ``ci_in`` build exact comparisons.

    Folding (the default) matches the source database's case-insensitive
    collation but compiles to ``lower(trim(col))``, which parquet cannot
    evaluate, so such filters run after the scan.  For a source whose
    vocabulary is known to be stored in one spelling, plans built in this block
    push the comparisons into the scan.  It holds for the calling thread and
    block only; plans built elsewhere are not affected.
    """
    token = _EXACT.set(True)
    try:
        yield
    finally:
        _EXACT.reset(token)


def fold(c) -> Column:
    """Case- and edge-space-insensitive form of a text column.

    The source database compares text case-insensitively and the jobs rely on
    it ('HIV program' vs 'HIV Program'); we compare folded values and keep the
    stored spelling in outputs.
    """
    return F.lower(F.trim(as_col(c)))


def ci_eq(c, literal: str) -> Column:
    """Case-insensitive equality with a literal (exact within ``exact_text``)."""
    if _EXACT.get():
        return as_col(c) == F.lit(literal)
    return fold(c) == F.lit(literal.strip().lower())


def ci_in(c, literals: Iterable[str]) -> Column:
    """Case-insensitive membership in a literal list (exact within ``exact_text``)."""
    literals = list(literals)
    if _EXACT.get():
        return as_col(c).isin(literals)
    return fold(c).isin([x.strip().lower() for x in literals])


def join_nonnull(sep: str, *cols) -> Column:
    """``concat_ws`` -- nulls are skipped, never null itself."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def concat_strict(*cols) -> Column:
    """``concat`` -- null if any part is null."""
    return F.concat(*[as_col(c) for c in cols])


def substring0(c, start0: int, end0: int) -> Column:
    """0-based, end-exclusive cut (the ETL's string-cut step)."""
    return F.substring(as_col(c), start0 + 1, end0 - start0)


def number_text(n) -> Column:
    """Number as text without a trailing ``.0`` for whole values (SQL CONCAT of a number)."""
    x = as_col(n)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x == F.floor(x), x.cast("decimal(38,0)").cast("string"))
            .otherwise(x.cast("string")))


def less_than_text(n) -> Column:
    """``'<' || n`` for results reported as below a detection limit."""
    return F.concat(F.lit("<"), number_text(n))


def format_identifier(c) -> Column:
    """split on single spaces; a part whose text starts like a number
    (optional sign then a digit) is left-padded with '0' to 4 characters;
    parts are re-joined with '-'.  ``'ABC 12'`` -> ``'ABC-0012'``,
    ``'ABC 12A'`` -> ``'ABC-012A'``, ``'ABC 12345'`` unchanged but hyphenated.
    """
    parts = F.split(as_col(c), " ", -1)
    padded = F.transform(
        parts,
        lambda p: F.when(p.rlike(r"^\s*[+-]?[0-9]") & (F.length(p) < 4), F.lpad(p, 4, "0")).otherwise(p),
    )
    return F.when(as_col(c).isNull() | (as_col(c) == ""), as_col(c)).otherwise(F.array_join(padded, "-"))


def gender_code(c) -> Column:
    """m -> 1, f -> 2, anything else null."""
    g = fold(c)
    return F.when(g == "m", F.lit(1)).when(g == "f", F.lit(2))


def blank_to_null(c) -> Column:
    x = as_col(c)
    return F.when(F.trim(x) == "", F.lit(None).cast("string")).otherwise(x)


def name_fallback(*cols, default: str = "Unknown") -> Column:
    """first non-blank of several name candidates, else ``default``."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(default))


def visit_key(patient, d) -> Column:
    """``patient-yyyy-MM-dd`` key of a calculated visit."""
    return F.concat_ws("-", as_col(patient).cast("string"), F.date_format(F.to_date(as_col(d)), "yyyy-MM-dd"))
