"""Joins of solutions: on equal terms, where unbound variables are compatible with all.

Variables that are bound in every row give plain equi-joins, for which Spark picks and adapts the
physical strategy. Where every shared variable may be unbound on a side, inner, outer, semi and anti joins
are split into rows that bind one and rows that do not, so that no nested-loop join of whole sides arises.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.expressions import common
from ..sources.mapping import NotStable
from ..sources.solutions import Solutions, column_name, union


def _right(var: str) -> str:
    return column_name(var) + "__r"


def renamed(s: Solutions) -> Solutions:
    """The same with columns that clash with no others."""
    return Solutions(s.df.select(*[F.col(column_name(v)).alias(_right(v)) for v in s.kinds]), s.kinds)


def right_columns(s: Solutions) -> dict:
    return {v: (F.col(_right(v)), k) for v, k in s.kinds.items()}


def shared(a: Solutions, b: Solutions) -> list[str]:
    names = [v for v in a.kinds if v in b.kinds]
    for v in names:
        if all((s.kinds[v].prefix or "").startswith("_:row-") for s in (a, b)):
            raise NotStable(f"?{v} stands for rows without a key and can be matched in one group only")
    return names


def compatible(a: Solutions, b: Solutions) -> Column:
    """Whether a row of ``a`` and a renamed one of ``b`` agree in the variables that both bind."""
    out = None
    for v in shared(a, b):
        x, y, kind = common(a.typed(v), right_columns(b)[v])
        same = x == y
        if a.kinds[v].maybe:
            same = same | F.col(column_name(v)).isNull()
        if b.kinds[v].maybe:
            same = same | F.col(_right(v)).isNull()
        out = same if out is None else out & same
    return F.lit(True) if out is None else out


def merged(a: Solutions, b: Solutions, outer: bool = False) -> dict:
    """Columns of joined rows; outer: those of ``b`` may lack."""
    out = {}
    for v in a.kinds:
        if v not in b.kinds:
            out[v] = a.typed(v)
            continue
        x, y, kind = common(a.typed(v), right_columns(b)[v])
        if not a.kinds[v].maybe:
            out[v] = (x, replace(kind, maybe=False))
        else:
            out[v] = (F.coalesce(x, y), replace(kind, maybe=outer or b.kinds[v].maybe))
    for v in b.kinds:
        if v not in a.kinds:
            out[v] = (F.col(_right(v)), b.kinds[v].may_lack(outer or b.kinds[v].maybe))
    return out


def join(a: Solutions, b: Solutions) -> Solutions:
    names = shared(a, b)
    if names and not _definite(a, b):
        return _split(a, b, names[0])
    r = renamed(b)
    if not names:
        return Solutions(a.df.crossJoin(r.df), {}).select(merged(a, b))
    return Solutions(a.df.join(r.df, compatible(a, b)), {}).select(merged(a, b))


def _definite(a: Solutions, b: Solutions) -> list[str]:
    """The shared variables that every row of both sides binds: what an equi-join can go by."""
    return [v for v in shared(a, b) if not a.kinds[v].maybe and not b.kinds[v].maybe]


def _bound(s: Solutions, v: str) -> Solutions:
    """The rows that bind a variable."""
    k = s.kinds[v]
    return Solutions(s.df.where(F.col(column_name(v)).isNotNull()), s.kinds | {v: replace(k, maybe=False)}) if k.maybe else s


def _unbound(s: Solutions, v: str) -> Solutions:
    """The rows that do not bind a variable, without it."""
    return Solutions(s.df.where(F.col(column_name(v)).isNull()), s.kinds).select({x: c for x, c in s.columns().items() if x != v})


def _split(a: Solutions, b: Solutions, v: str) -> Solutions:
    """Join on a variable that may be unbound: bound with bound, and unbound rows by the other variables."""
    parts = [join(_bound(a, v), _bound(b, v))]
    if a.kinds[v].maybe:
        parts.append(join(_unbound(a, v), b))
    if b.kinds[v].maybe:
        parts.append(join(_bound(a, v), _unbound(b, v)))
    return union(parts)


def left_join(a: Solutions, b: Solutions, condition=None) -> Solutions:
    """``condition`` maps the merged columns to a further join condition."""
    if shared(a, b) and not _definite(a, b):
        found = join(a, b)
        if condition is not None:
            found = found.where(condition(found.columns()))
        return union([found, semi_join(a, b, True, condition)])
    on = compatible(a, b)
    if condition is not None:
        on = on & condition(merged(a, b))  # a condition that is null matches nothing, as one that is false
    return Solutions(a.df.join(renamed(b).df, on, "left"), {}).select(merged(a, b, outer=True))


def semi_join(a: Solutions, b: Solutions, negated: bool, condition=None) -> Solutions:
    """Rows of ``a`` that are compatible with some row of ``b``, or with none."""
    names = shared(a, b)
    if names and not _definite(a, b):
        return _split_semi(a, b, negated, names, lambda x, y: condition(merged(x, y)) if condition is not None else None, all_match=True)
    on = compatible(a, b)
    if condition is not None:
        on = on & condition(merged(a, b))  # a condition that is null matches nothing, as one that is false
    elif not names:
        b = Solutions(b.df.limit(1), b.kinds)  # whether there is a row is all that matters
    return Solutions(a.df.join(renamed(b).df, on, "left_anti" if negated else "left_semi"), a.kinds)


def _split_semi(a: Solutions, b: Solutions, negated: bool, names: list[str], test, all_match: bool) -> Solutions:
    """Semi and anti joins where any shared variable may be unbound, as equi-joins of rows that bind one of ``names``.

    The variables before ``names`` are unbound on a side. Rows that have none of them in common match if ``all_match`` says so.
    """
    if not names:
        if not all_match:
            return a if negated else Solutions(a.df.limit(0), a.kinds)
        on = test(a, b)
        r = renamed(b).df
        return Solutions(a.df.join(r.limit(1) if on is None else r, F.lit(True) if on is None else on, "left_anti" if negated else "left_semi"), a.kinds)
    v, rest = names[0], names[1:]

    def matched(x: Solutions, y: Solutions, anti: bool) -> Solutions:
        on = compatible(x, y)
        more = test(x, y)
        return Solutions(x.df.join(renamed(y).df, on if more is None else on & more, "left_anti" if anti else "left_semi"), x.kinds)

    ours, theirs = _bound(a, v), _bound(b, v)
    parts = [matched(ours, theirs, negated)]
    if b.kinds[v].maybe:
        if negated:
            parts = [_split_semi(parts[0], _unbound(b, v), True, rest, test, all_match)]
        else:
            parts.append(_split_semi(matched(ours, theirs, True), _unbound(b, v), False, rest, test, all_match))
    if a.kinds[v].maybe:
        # Rows keep the column of a variable that they do not bind; only what they are matched by lacks it.
        loose = Solutions(a.df.where(F.col(column_name(v)).isNull()), a.kinds)
        parts.append(_split_semi(loose, Solutions(b.df, b.kinds).select({x: c for x, c in b.columns().items() if x != v}), negated, rest, test, all_match))
    df = parts[0].df
    for p in parts[1:]:
        df = df.union(p.df)
    return Solutions(df, a.kinds)


def minus(a: Solutions, b: Solutions, aside: str | None = None) -> Solutions:
    """Rows of ``a`` that agree with no row of ``b`` with which they share a bound variable.

    ``aside`` is a variable that both sides bind, and that is none of the pattern's.
    """
    names = [v for v in shared(a, b) if v != aside]
    if not names:
        return a
    sure = _definite(a, b)
    if not sure:
        return _split_semi(a, b, True, names, lambda x, y: None, all_match=False)
    on = compatible(a, b)
    if sure == [aside]:
        some = F.lit(False)
        for v in names:
            some = some | (F.col(column_name(v)).isNotNull() & F.col(_right(v)).isNotNull())
        on = on & some
    return Solutions(a.df.join(renamed(b).df, on, "left_anti"), a.kinds)
