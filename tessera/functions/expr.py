"""Column-expression helpers shared by the operators.

All helpers return native Spark ``Column`` expressions (whole-stage codegen,
no Python in the row path).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_list(key) -> list[str]:
    """A key given as one column name or a sequence of names, as a list."""
    return [key] if isinstance(key, str) else list(key)


def threshold_class(value, thresholds: Sequence[tuple[float, str]], else_label: str) -> Column:
    """Ordered strict ``>`` thresholds -> label; the else-label also catches NULL.

    ``thresholds`` is checked top to bottom, e.g. ``[(20, 'star'), (15, 'good'), (10, 'average')]``.
    """
    v = col_of(value)
    expr = None
    for bound, label in thresholds:
        cond = v > F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


def text_flag(text, needle: str) -> Column:
    """Substring presence as a NULL-safe boolean (NULL text -> false)."""
    return F.coalesce(F.instr(col_of(text), needle), F.lit(0)) > 0


def clock_to_minutes(clock) -> Column:
    """``'MM:SS'`` -> decimal minutes as double.

    Missing seconds count as 0 (``'12'`` -> 12.0); an unparsable part gives
    NULL instead of failing the job.
    """
    c = col_of(clock)
    mins = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("double")
    sec_txt = F.split_part(c, F.lit(":"), F.lit(2))
    secs = F.when(sec_txt == "", F.lit(0.0)).otherwise(sec_txt.try_cast("double"))
    return mins + secs / F.lit(60.0)


def day_range(df, ts: str, start=None, end=None) -> Column:
    """``start <= to_date(ts) <= end`` written on the raw timestamp column.

    Comparing the column itself with literals of its own type (instead of
    wrapping it in ``to_date``) lets Parquet skip row groups: the predicate
    appears under ``PushedFilters``.
    """
    import datetime as _dt

    dtype = df.schema[ts].dataType
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(str(start)).cast(dtype))
    if end is not None:
        nxt = _dt.date.fromisoformat(str(end)[:10]) + _dt.timedelta(days=1)
        cond = cond & (F.col(ts) < F.lit(nxt.isoformat()).cast(dtype))
    return cond


def guarded_ratio(num, den, zero_as: float = 1.0) -> Column:
    """``num / den`` with a zero denominator replaced by ``zero_as``."""
    d = col_of(den)
    return col_of(num) / F.when(d == 0, F.lit(zero_as)).otherwise(d)


def null_safe_changed(cols: Iterable[str], prev_prefix: str = "_prev_") -> Column:
    """True when any column differs from its ``prev_prefix`` twin (NULL = NULL)."""
    out = None
    for c in cols:
        diff = ~F.col(c).eqNullSafe(F.col(prev_prefix + c))
        out = diff if out is None else (out | diff)
    return out if out is not None else F.lit(False)


def is_date_type(df, column: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[column].dataType, T.DateType)


def period_add(c, n: int, is_date: bool) -> Column:
    return F.date_add(col_of(c), n) if is_date else col_of(c) + F.lit(n)


def period_diff(a, b, is_date: bool) -> Column:
    return F.datediff(col_of(a), col_of(b)) if is_date else col_of(a) - col_of(b)


def period_lit(v, is_date: bool) -> Column:
    return F.to_date(F.lit(str(v))) if is_date else F.lit(v)
