"""Compiles algebra bottom-up to DataFrames.

Patterns with one subject are merged to one scan, type patterns that a foreign key implies are dropped,
and predicates that a source lacks end a pattern while planning; each such step is noted in ``trace``.
Join order and strategy, pushdown into scans and pruning are Catalyst's and adaptive execution's.
"""

from __future__ import annotations

import itertools
from dataclasses import fields, is_dataclass
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import Scope, Typed, common
from ..operators import paths
from ..sources.solutions import Solutions, column_name, empty, union, unit
from ..sources.triples import TripleSource
from ..sparql import algebra as A
from ..terms import (
    BOX_KIND, BOOLEAN, DOUBLE, INTEGER, IRI, LITERAL, NODE_KIND, NUMERIC, SPARK_TYPES, STRING, XSD, BNode, Kind, Literal, Var, box, box_constant, is_numeric, lexical, literal_kind, number,
    spark_literal,
)
from . import joins, rewrite

_fresh = itertools.count()
#: Named graphs that a pattern may be planned for one by one; it is refused beyond them.
MOST_GRAPHS = 1000


class Compiler:
    """source: where triples come from. rules: backward rules, by the predicate of their heads."""

    def __init__(self, spark: SparkSession, source: Any, rules: dict[str, list] | None = None, trace: list[str] | None = None, raw: Any = None, rewrites: bool = True):
        self.rewrites = rewrites
        self.spark, self.source, self.rules = spark, source, rules or {}
        self.trace = trace if trace is not None else []
        self.raw = raw or source  # what native graph queries see
        self.expanding: frozenset[str] = frozenset()
        #: Templates that variables can have only, as far as the sides that are joined tell.
        self.hints: dict[str, set[str]] = {}
        #: What a part is joined with, by the variables that every row of it binds to nodes; kept by native graph queries only.
        self.sides: dict[str, Solutions] = {}

    def compile(self, node: Any) -> Solutions:
        return getattr(self, "c_" + type(node).__name__.lower())(node)

    @property
    def graph_variable(self) -> str | None:
        """The variable that every solution binds to its graph's name, inside GRAPH with a variable."""
        return getattr(self.source, "variable", None)

    def _in_graphs(self, s: Solutions) -> Solutions:
        """Solutions that say nothing of graphs hold in each."""
        return s if self.graph_variable is None or self.graph_variable in s.kinds else joins.join(self.source.names(), s)

    # Basic graph patterns ---------------------------------------------------------------------------
    def c_bgp(self, node: A.BGP) -> Solutions:
        triples = paths.inline(node.triples)
        basic, rest = [], []
        for t in triples:
            derived = isinstance(t.p, IRI) and t.p.value in self.rules and t.p.value not in self.expanding
            (basic if isinstance(t.p, IRI | Var) and not derived else rest).append(t)
        parts = self._basic(basic, node.columns)
        parts += [self._derived(t) if isinstance(t.p, IRI) else paths.compile_path(self, t) for t in rest]
        return self._in_graphs(self._connected(parts))

    def _basic(self, triples: list[A.Triple], columns: list[A.Triple] = ()) -> list[Solutions]:
        known = self.source.predicates()
        for t in triples:
            if known is not None and isinstance(t.p, IRI) and t.p.value not in known:
                self.trace.append(f"no triples with {t.p.value}: the pattern is empty")
                return [empty(self.spark, {x.name: NODE_KIND for t in [*triples, *columns] for x in (t.s, t.p, t.o) if isinstance(x, Var)})]
        if not self.rewrites and not isinstance(self.source, TripleSource):
            return [self.source.star(t.s, [t]) for t in triples]
        wanted = {t.s for t in columns}
        kept = [t for t in triples if t.s in wanted or not self.source.implied(t, triples)]
        if len(kept) < len(triples):
            self.trace.append(f"{len(triples) - len(kept)} type pattern(s) implied by a foreign key")
        if isinstance(self.source, TripleSource):
            return [self.source.pattern(t) for t in kept]
        stars: dict[A.Term, list[A.Triple]] = {}
        for t in kept:
            stars.setdefault(t.s, []).append(t)
        for s, own in stars.items():
            if len(own) > 1:
                self.trace.append(f"{len(own)} patterns of {A.text(s)} in one scan")
        return [self.source.star(s, own, [t for t in columns if t.s == s], self._prefixes(s, kept)) for s, own in stars.items()]

    def _prefixes(self, subject: A.Term, triples: list[A.Triple]) -> set[str] | None:
        """The templates that a subject can have, from edges into it and from what its side is joined with."""
        if not isinstance(subject, Var):
            return None
        known = [self.hints[subject.name]] if subject.name in self.hints else []
        for t in triples:
            if t.o == subject and isinstance(t.p, IRI) and (found := self.source.targets(t.p.value)) is not None:
                known.append(found)
        return set.intersection(*known) if known else None

    def beside(self, left: Solutions, node: Any, optional: bool = False) -> Solutions:
        """Compiles what is joined with ``left``: tables that can't match it need no scan.

        What is known further out does not hold inside an optional side: a row that fails there may
        leave a variable unbound, which joins where the row would not.
        """
        outer, self.hints = self.hints, {} if optional else self.hints
        base = self.hints
        sure = {v: {k.prefix} for v, k in left.kinds.items() if k.form == "node" and k.prefix is not None and not k.maybe}
        self.hints = {**base, **{v: base[v] & p if v in base else p for v, p in sure.items()}}
        try:
            return self.compile(node)
        finally:
            self.hints = outer

    def _connected(self, parts: list[Solutions]) -> Solutions:
        """Joins parts so that each shares a variable with those before it where possible."""
        if not parts:
            return unit(self.spark)
        out, rest = parts[0], parts[1:]
        while rest:
            at = next((i for i, p in enumerate(rest) if set(p.kinds) & set(out.kinds)), None)
            if at is None:
                self.trace.append("patterns without a common variable: a product")
                at = 0
            out = joins.join(out, rest.pop(at))
        return out

    def _derived(self, t: A.Triple) -> Solutions:
        """A pattern whose predicate has backward rules: stored triples and what the rules derive."""
        from ..operators import rules

        self.trace.append(f"{t.p.value} expanded by {len(self.rules[t.p.value])} rule(s)")
        return rules.backward(self, t)

    # Operators --------------------------------------------------------------------------------------
    def c_join(self, node: A.Join) -> Solutions:
        if isinstance(node.left, A.BGP) and not node.left.triples:
            return self.compile(node.right)
        left = self.compile(node.left)
        return joins.join(left, self.beside(left, node.right))

    def optional_column(self, left: Any, right: Any, condition: Any = None) -> Any | None:
        """The left side with an optional pattern as a column of its scan, if a table can give it."""
        t = rewrite.single(right)
        if t is None or not self.rewrites or isinstance(self.source, TripleSource) or t.p.value in self.rules:
            return None
        merged = rewrite.as_column(left, right, condition)
        if merged is not None:
            self.trace.append(f"optional {t.p.value} read as a column")
        return merged

    def c_leftjoin(self, node: A.LeftJoin) -> Solutions:
        merged = self.optional_column(node.left, node.right, node.condition)
        if merged is not None:
            return self.compile(merged)
        condition = None
        if node.condition is not None:
            condition = lambda columns: self.scope(columns).truth(node.condition)
        left = self.compile(node.left)
        return joins.left_join(left, self.beside(left, node.right, True), condition)

    def c_union(self, node: A.Union) -> Solutions:
        out = union([self.compile(node.left), self.compile(node.right)])
        return Solutions(out.df.distinct(), out.kinds) if node.distinct else out

    def c_minus(self, node: A.Minus) -> Solutions:
        left = self.compile(node.left)
        return joins.minus(left, self.beside(left, node.right, True), self.graph_variable)

    def c_filter(self, node: A.Filter) -> Solutions:
        out = self.compile(node.child)
        for c in conjuncts(node.condition):
            negated = isinstance(c, A.Call) and c.name == "!" and isinstance(c.args[0], A.Exists)
            if isinstance(c, A.Exists) or negated:
                e = c.args[0] if negated else c
                out = self._exists(out, e.pattern, e.negated != negated)
                continue
            marks: dict[A.Exists, str] = {}
            for e in nested_exists(c):
                out, marks[id(e)] = self._marked(out, e)
            scope = Scope(out.columns(), lambda e, marks=marks: F.col(marks[id(e)]))
            out = Solutions(out.df.where(scope.truth(c)), out.kinds)
            out = out.select(out.columns()) if marks else out
        return out

    def _inner(self, out: Solutions, pattern: Any) -> tuple[Solutions, Any]:
        """A pattern of EXISTS, and its outermost filter, which may use variables from outside."""
        if isinstance(pattern, A.Filter):
            return self.beside(out, pattern.child, True), pattern.condition
        return self.beside(out, pattern, True), None

    def _exists(self, out: Solutions, pattern: Any, negated: bool) -> Solutions:
        inner, condition = self._inner(out, pattern)
        use = None if condition is None else lambda columns: self.scope(columns).truth(condition)
        return joins.semi_join(out, inner, negated, use)

    def _marked(self, out: Solutions, e: A.Exists) -> tuple[Solutions, str]:
        """Adds a column that tells whether the pattern has a match, for use inside an expression."""
        name = f"_exists{id(e)}"
        inside = rewrite.variables(e.pattern)
        names = [v for v in out.kinds if v in inside]
        columns = [column_name(v) for v in names]
        # Of the variables that the pattern mentions, each combination is tested once and joined back.
        keys = Solutions(out.df.select(*columns).distinct(), {v: out.kinds[v] for v in names})
        hit = self._exists(keys, e.pattern, False).df
        if not names:
            hit = hit.limit(1)
        hit = hit.select(*[F.col(c).alias(c + "__k") for c in columns], F.lit(True).alias(name))
        on = F.lit(True)
        for c in columns:
            on = on & F.col(c).eqNullSafe(F.col(c + "__k"))
        df = out.df.join(hit, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)) != F.lit(e.negated))
        return Solutions(df.drop(*[c + "__k" for c in columns]), out.kinds), name

    def scope(self, columns: dict[str, Typed]) -> Scope:
        return Scope(columns)

    def c_extend(self, node: A.Extend) -> Solutions:
        out = self.compile(node.child)
        if node.var.name in out.kinds:
            raise ValueError(f"?{node.var.name} is bound already")
        marks: dict[int, str] = {}
        for e in nested_exists(node.value):
            out, marks[id(e)] = self._marked(out, e)
        col, kind = Scope(out.columns(), lambda e: F.col(marks[id(e)])).value(node.value)
        sure = isinstance(node.value, IRI | Literal) or (isinstance(node.value, Var) and not kind.maybe)
        out = out.extend(node.var.name, (col, kind if sure else kind.may_lack()))
        return out.select(out.columns())

    def c_values(self, node: A.Values) -> Solutions:
        if not node.rows:
            return empty(self.spark, {v.name: NODE_KIND for v in node.vars})
        kinds: dict[str, Kind] = {}
        cells: list[list[Column]] = [[] for _ in node.rows]
        for i, v in enumerate(node.vars):
            terms = [r[i] for r in node.rows]
            kind = values_kind([t for t in terms if t is not None])
            kinds[v.name] = kind.may_lack(None in terms)
            for row, t in zip(cells, terms, strict=True):
                row.append(constant(t, kind).alias(column_name(v.name)))
        if not node.vars:
            return self._in_graphs(Solutions(self.spark.range(len(node.rows)).select(), {}))
        return self._in_graphs(Solutions(self.spark.range(1).select(F.inline(F.array(*[F.struct(*row) for row in cells]))), kinds))

    def c_unwind(self, node: A.Unwind) -> Solutions:
        out = self.compile(node.child)
        terms = node.values
        kind = values_kind(terms)
        made = out.df.withColumn(column_name(node.var.name), F.explode(F.array(*[constant(t, kind) for t in terms])))
        return Solutions(made, out.kinds | {node.var.name: kind})

    def c_graph(self, node: A.Graph) -> Solutions:
        def inside(source: Any, child: Any) -> Solutions:
            return Compiler(self.spark, source, trace=self.trace, raw=self.raw).compile(child)

        if not isinstance(node.name, Var):
            return self._in_graphs(inside(self.source.graph(node.name.value), node.child))
        name, own = node.name.name, f"_graph{next(_fresh)}"
        source = self.source.graphs(own)
        if source is None:
            return empty(self.spark, {name: NODE_KIND})
        if not within_graphs(node.child):
            return self._in_graphs(self._each_graph(source, name, node.child, inside))
        found = inside(source, node.child)
        if name in found.kinds:  # the pattern binds the variable too
            given = source.names().df.select(*[F.col(column_name(own)).alias(column_name(v)) for v in (own, name)])
            found = joins.join(found, Solutions(given, {own: NODE_KIND, name: NODE_KIND}))
            return self._in_graphs(found.select({v: c for v, c in found.columns().items() if v != own}))
        return self._in_graphs(found.select({name if v == own else v: c for v, c in found.columns().items()}))

    def _each_graph(self, source: Any, name: str, child: Any, inside: Any) -> Solutions:
        """Graph by graph, where a subquery cuts off or aggregates all of a graph's solutions."""
        names = [r[0] for r in source.names().df.limit(MOST_GRAPHS + 1).collect()]
        if len(names) > MOST_GRAPHS:
            raise ValueError(f"a subquery with LIMIT, OFFSET or an aggregate without GROUP BY runs in at most {MOST_GRAPHS} graphs of a variable; name the graph")
        given = {n: Solutions(self.spark.range(1).select(F.lit(n).alias(column_name(name))), {name: NODE_KIND}) for n in names}
        parts = [joins.join(inside(self.source.graph(n), child), given[n]) for n in sorted(names)]
        return union(parts) if parts else empty(self.spark, {name: NODE_KIND})

    def c_native(self, node: A.Native) -> Solutions:
        from ..operators import cypher

        found, names = cypher.run(Compiler(self.spark, self.raw, trace=self.trace), node.text)
        by_name = {v.name: v.name for v in node.vars if v.name in names}
        wanted = by_name or {v.name: n for v, n in zip(node.vars, names, strict=False)}
        return self._in_graphs(found.select({v: url_as_node(found.typed(n)) for v, n in wanted.items()}))

    def _inside(self, node: Any, names: set[str]) -> Solutions:
        """Compiles a subquery, of whose variables only some are those outside."""
        outer, self.hints = self.hints, {v: p for v, p in self.hints.items() if v in names}
        try:
            return self.compile(node)
        finally:
            self.hints = outer

    def c_group(self, node: A.Group) -> Solutions:
        child = self._inside(node.child, {v.name for v, e in node.keys if v == e})
        scope = Scope(child.columns())
        columns = {v.name: scope.value(e) for v, e in node.keys}
        if self.graph_variable is not None:
            columns[self.graph_variable] = child.typed(self.graph_variable)
        df = child.df
        args: dict[str, Typed] = {}
        for v, a in node.aggregates:
            args[v.name] = (F.lit(1), INTEGER) if a.arg is None and not a.distinct else (F.struct(F.lit(1), *[F.col(column_name(x)) for x in child.kinds if not x.startswith("_")]), BOX_KIND) if a.arg is None else scope.value(a.arg)
        df = df.select(*[c.alias(column_name(v)) for v, (c, _) in columns.items()], *[c.alias("_in" + v) for v, (c, _) in args.items()])
        kinds = {v: k for v, (_, k) in columns.items()}
        made = []
        for v, a in node.aggregates:
            col, kind = aggregate(a, "_in" + v.name, args[v.name][1])
            made.append(col.alias(column_name(v.name)))
            kinds[v.name] = kind
        keys = [F.col(column_name(v)) for v in columns]
        if not made:
            out = df.select(*keys).distinct() if keys else self.spark.range(1).select()
        else:
            out = df.groupBy(*keys).agg(*made) if keys else df.agg(*made)
        return Solutions(out, kinds)

    def c_project(self, node: A.Project) -> Solutions:
        child = self._inside(node.child, {v.name for v in node.vars}) if node.vars is not None else self.compile(node.child)
        names = [v.name for v in node.vars] if node.vars is not None else [v for v in child.kinds if not v.startswith("_")]
        if self.graph_variable is not None:
            names.append(self.graph_variable)
        null = (F.lit(None).cast("string"), STRING.may_lack())
        return child.select({v: child.typed(v) if v in child.kinds else null for v in names})

    def c_distinct(self, node: A.Distinct) -> Solutions:
        inner = node.child
        if isinstance(inner, A.Project) and isinstance(inner.child, A.OrderBy):
            ordered = inner.child
            if all(isinstance(k, Var) and (inner.vars is None or k in inner.vars) for k, _ in ordered.keys):
                # An order does not outlast the removal of duplicates, so it comes after it.
                return self.compile(A.OrderBy(A.Distinct(A.Project(ordered.child, inner.vars)), ordered.keys))
        out = self.compile(inner)
        return Solutions(out.df.distinct(), out.kinds)

    def c_orderby(self, node: A.OrderBy) -> Solutions:
        out = self.compile(node.child)
        scope = Scope(out.columns())
        keys = [k.asc_nulls_first() if up else k.desc_nulls_last() for e, up in node.keys for k in sort_keys(scope.value(e))]
        return Solutions(out.df.orderBy(*keys), out.kinds)

    def c_slice(self, node: A.Slice) -> Solutions:
        out = self._inside(node.child, set())  # which rows are cut off must not depend on what is outside
        df = out.df.offset(node.offset) if node.offset else out.df
        return Solutions(df.limit(node.limit) if node.limit is not None else df, out.kinds)


def within_graphs(node: Any) -> bool:
    """Whether a pattern's solutions in all graphs at once are those in each: no part cuts off or aggregates across graphs."""
    if isinstance(node, A.Slice) or (isinstance(node, A.Group) and not node.keys):
        return False
    if isinstance(node, tuple | list):
        return all(map(within_graphs, node))
    return not is_dataclass(node) or all(within_graphs(getattr(node, f.name)) for f in fields(node))


def conjuncts(e: Any) -> list[Any]:
    return conjuncts(e.args[0]) + conjuncts(e.args[1]) if isinstance(e, A.Call) and e.name == "&&" else [e]


def nested_exists(e: Any) -> list[A.Exists]:
    if isinstance(e, A.Exists):
        return [e]
    return [x for a in e.args for x in nested_exists(a)] if isinstance(e, A.Call) else []


def values_kind(terms: list) -> Kind:
    """The kind of a column of constants."""
    if not terms:
        return NODE_KIND
    if all(isinstance(t, IRI | BNode) for t in terms):
        return NODE_KIND
    if all(isinstance(t, Literal) and not t.lang for t in terms):
        kinds = {literal_kind(t.dt) for t in terms}
        if len(kinds) == 1:
            return kinds.pop()
    return BOX_KIND


def constant(term: Any, kind: Kind) -> Column:
    """A constant in a column of ``kind``; None is unbound."""
    if term is None:
        return F.lit(None).cast("struct<kind:tinyint,lex:string,dt:string,lang:string>" if kind.form == "box" else SPARK_TYPES.get(kind.dt, "string"))
    if kind.form == "box":
        return box_constant(term)
    if kind.form == "node":
        return F.lit(term.value if isinstance(term, IRI) else "_:" + term.label)
    return spark_literal(term)[0]


def url_as_node(value: Typed) -> Typed:
    """Strings that look like web addresses, as IRIs: what native graph queries return has no other mark."""
    col, kind = value
    if kind.form == "literal" and kind.dt == XSD + "string":
        return F.when(col.rlike("^https?://"), box(col, Kind("node"))).otherwise(box(col, kind)), BOX_KIND.may_lack(kind.maybe)
    return value


def sort_keys(value: Typed) -> list[Column]:
    """Unbound, blank nodes, IRIs, literals; numbers by value."""
    col, kind = value
    if kind.form != "box":
        return [lexical(col, kind) if kind.form == "node" and kind.prefix is None else col]
    return [col["kind"], number(col, kind), col["lex"]]


def aggregate(a: A.Aggregate, name: str, kind: Kind) -> Typed:
    """An aggregate over the column ``name``."""
    col = F.col(name)
    once = "DISTINCT " if a.distinct else ""
    if a.name == "COUNT":
        return (F.count_distinct(col) if a.distinct else F.count(col)), INTEGER
    if a.name in ("SUM", "AVG"):
        n = number(col, kind)
        if is_numeric(kind):
            f = F.expr(f"{a.name.lower()}({once}`{name}`)")
            if a.name == "AVG":
                return F.coalesce(F.expr(f"avg({once}cast(`{name}` as double))"), F.lit(0.0)), DOUBLE
            return F.coalesce(f, F.lit(0).cast(SPARK_TYPES[kind.dt])).cast(SPARK_TYPES[kind.dt]), kind.may_lack(False)
        made = (F.sum_distinct(n) if a.distinct else F.sum(n)) if a.name == "SUM" else (F.try_divide(F.sum_distinct(n), F.count_distinct(n)) if a.distinct else F.avg(n))
        # One value that is no number leaves the sum unbound.
        return F.when(F.count(col) == F.count(n), F.coalesce(made, F.lit(0.0))), DOUBLE.may_lack()
    if a.name in ("MIN", "MAX", "SAMPLE"):
        f = F.max if a.name == "MAX" else F.min
        if kind.form == "box":
            return f(F.when(col.isNotNull(), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys((col, kind)))], col.alias("term"))))["term"], kind.may_lack()
        return f(col), kind.may_lack()
    if a.name == "GROUP_CONCAT":
        texts = lexical(col, kind)
        return F.array_join(F.array_sort((F.collect_set if a.distinct else F.collect_list)(texts)), a.separator), STRING
    if a.name == "COLLECT":
        return F.array_join(F.array_sort(F.collect_list(lexical(col, kind))), ","), STRING
    raise ValueError(f"unknown aggregate {a.name}")


__all__ = ["BOOLEAN", "Compiler", "LITERAL", "NUMERIC", "common", "conjuncts", "union"]
