"""Property paths.

Sequences and inverses become triple patterns; alternatives are unions. Closures are sets of node
pairs found by a semi-naive loop: each round joins the newest pairs with the edges and keeps what is
new, until nothing is. A constant end keeps the loop to what can be reached from it. Hops of native
graph queries give one row a path without a repeated edge: from an end that the pattern knows they go round
by round, by the edges at the newest nodes only; between all nodes they are joins of all edges.
"""

from __future__ import annotations

import itertools
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import equal
from ..sources.solutions import Solutions, column_name, empty, union
from ..sparql import algebra as A
from ..storage import checkpoint
from ..terms import INTEGER, IRI, NODE_KIND, TYPE, BNode, Literal, Var, box_constant, lexical

if TYPE_CHECKING:
    from ..plans.compiler import Compiler

_fresh = itertools.count()
#: Newest pairs (about 100 bytes each) up to which they are broadcast to the edges.
BROADCAST_PAIRS = 100_000


def _var(hint: str) -> Var:
    return Var(f"_{hint}{next(_fresh)}")


def inline(triples: list[A.Triple]) -> list[A.Triple]:
    """Triples whose sequences and inverses are written out as patterns."""
    out = []
    for t in triples:
        if isinstance(t.p, A.Seq):
            middle = _var("p")
            out += inline([A.Triple(t.s, t.p.left, middle), A.Triple(middle, t.p.right, t.o)])
        elif isinstance(t.p, A.Inverse):
            out += inline([A.Triple(t.o, t.p.path, t.s)])
        else:
            out.append(t)
    return out


def compile_path(c: Compiler, t: A.Triple) -> Solutions:
    p = t.p
    if isinstance(p, A.Alt):
        return union([c.compile(A.BGP([A.Triple(t.s, side, t.o)])) for side in (p.left, p.right)])
    if isinstance(p, A.NotIn):
        parts = []
        for names, s, o in ((p.forward, t.s, t.o), (p.inverse, t.o, t.s)):
            if names or (not p.inverse and s is t.s):
                v = _var("p")
                found = c.compile(A.BGP([A.Triple(s, v, o)]))
                found = found.where(~F.col(column_name(v.name)).isin(*[n.value for n in names]))
                parts.append(found.select({x: k for x, k in found.columns().items() if x != v.name}))
        return union(parts)
    if isinstance(p, A.Hops):
        return _hops(c, t)
    if isinstance(p, A.Closure):
        return _ends(c, t, closure(c, p, t.s, t.o))
    raise ValueError(f"no such path: {p}")


def pairs(c: Compiler, path: Any) -> DataFrame:
    """(a, b) of nodes as strings that a path connects; literals are no ends of further steps and are left out."""
    s, o = _var("s"), _var("o")
    found = c.compile(A.BGP([A.Triple(s, path, o)]))
    a, b = found.typed(s.name), found.typed(o.name)
    df = found.df
    if b[1].form == "box":
        df = df.where(b[0]["kind"] != 3)
    elif b[1].form == "literal":
        df = df.where(F.lit(False))
    graph = [found.typed(c.graph_variable)[0].alias("g")] if c.graph_variable else []
    return df.select(*graph, lexical(*a).alias("a"), lexical(*b).alias("b"))


def _name(term: A.Term) -> str | None:
    return term.value if isinstance(term, IRI) else None


def closure(c: Compiler, p: A.Closure, s: A.Term, o: A.Term) -> DataFrame:
    start, end = _name(s), _name(o)
    if (start or end) and not p.bound and c.graph_variable is None:
        reached = _walk(c, p.path, start, end)
    elif p.bound:
        reached = pairs(c, p.path).distinct()
    else:
        # From a known end only few edges are read, a scan a round; else all are, so they are kept.
        edges = pairs(c, p.path)
        reached = reach(edges if start or end else checkpoint(edges.distinct()), start=start, end=end)
    if p.least == 0:
        known = start or end
        if known:
            nodes = c.source.names().df.toDF("g") if c.graph_variable else c.spark.range(1).select()
            nodes = nodes.withColumn("node", F.lit(known))
        else:
            nodes = c.source.nodes()
        zero = nodes.select(*([F.col("g")] if c.graph_variable else []), F.col("node").alias("a"), F.col("node").alias("b"))
        reached = reached.unionByName(zero).distinct()
    return reached


#: Newest nodes of a walk from a known end up to which their patterns are planned one by one, each with a constant end.
FEW_NODES = 8


def _walk(c: Compiler, path: Any, start: str | None, end: str | None) -> DataFrame:
    """(a, b) of :func:`reach` from a known end: while few nodes are new, their keys reach the scans; then by rounds over all edges."""
    backwards, known = start is None, start or end
    seen: list[str] = []
    newest = [known]
    while newest and len(newest) <= FEW_NODES:
        v = _var("n")
        steps = [c.compile(A.BGP([A.Triple(v, path, IRI(x)) if backwards else A.Triple(IRI(x), path, v)])) for x in newest]
        parts = []
        for found in steps:
            col, kind = found.typed(v.name)
            if kind.form != "literal":  # literals are no ends of further steps
                df = found.df.where(col["kind"] != 3) if kind.form == "box" else found.df
                parts.append(df.select(lexical(col, kind).alias("node")))
        if not parts:
            newest = []
            break
        nodes = parts[0]
        for p in parts[1:]:
            nodes = nodes.union(p)
        # With more than a bounded number, the rest is a frame's work.
        got = [r[0] for r in nodes.where("node is not null").distinct().limit(MOST_NODES + 1).collect()]
        if len(got) > MOST_NODES:
            break
        newest = [x for x in got if x not in seen]
        seen += newest
    row = (lambda x: (x, known)) if backwards else (lambda x: (known, x))
    held = c.spark.createDataFrame([row(x) for x in seen], "a string, b string")
    if not newest:
        return held
    return reach(pairs(c, path), start=start, end=end)


#: Nodes that come to the driver at once in such a walk, at most.
MOST_NODES = 1000


def reach(edges: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """All (a, b) with a walk of one edge or more from a to b; from ``start`` or to ``end`` only, if given. Walks stay in a graph if edges name theirs (g)."""
    graph = ["g"] if "g" in edges.columns else []
    backwards = start is None and end is not None
    if backwards:
        edges = edges.select(*graph, F.col("b").alias("a"), F.col("a").alias("b"))
    step = edges.select(*graph, F.col("a").alias("via"), F.col("b").alias("next"))
    newest = checkpoint(edges.where(F.col("a") == (end if backwards else start)).distinct()) if start or end else edges
    known = newest
    while n := newest.count():
        near = F.broadcast(newest) if n <= BROADCAST_PAIRS else newest
        further = step.join(near.withColumnRenamed("b", "via"), ["via", *graph]).select(*graph, "a", F.col("next").alias("b")).distinct()
        newest = checkpoint(further.join(known, [*graph, "a", "b"], "left_anti"))
        known = known.union(newest)
    return known.select(*graph, F.col("b").alias("a"), F.col("a").alias("b")) if backwards else known


def _ends(c: Compiler, t: A.Triple, found: DataFrame) -> Solutions:
    """Pairs as solutions of a triple's ends."""
    bound: dict = {c.graph_variable: (F.col("g"), NODE_KIND)} if c.graph_variable else {}
    for term, col in ((t.s, F.col("a")), (t.o, F.col("b"))):
        if isinstance(term, Var):
            if term.name in bound:
                found = found.where(equal(bound[term.name], (col, NODE_KIND)))
            else:
                bound[term.name] = (col, NODE_KIND)
        elif isinstance(term, IRI):
            found = found.where(col == term.value)
        else:
            return empty(c.spark, {**{v: k for v, (_, k) in bound.items()}, **{x.name: NODE_KIND for x in (t.s, t.o) if isinstance(x, Var)}})
    out = Solutions(found, {})
    return out.select(bound) if bound else Solutions(found.select(), {})


def _edges(c: Compiler, predicate: IRI | None, s: A.Term | None = None, o: A.Term | None = None) -> DataFrame:
    """(a, b, e): ends of relationships as strings, and an id of the edge, which may repeat; without a predicate, all between nodes but types. ``s`` and ``o`` are ends that are given."""
    s, p, o = s or _var("s"), _var("p"), o or _var("o")
    found = c.compile(A.BGP([A.Triple(s, predicate or p, o)]))
    a, b = (found.typed(x.name) if isinstance(x, Var) else (F.lit(_name(x) or f"_:{x.label}"), NODE_KIND) for x in (s, o))
    name = F.lit(predicate.value) if predicate else lexical(*found.typed(p.name))
    df = found.df
    if b[1].form == "box":
        df = df.where(b[0]["kind"] != 3)
    elif b[1].form == "literal":
        df = df.where(F.lit(False))
    df = df.select(lexical(*a).alias("a"), lexical(*b).alias("b"), name.alias("p")).where(F.col("p") != TYPE)
    return df.select("a", "b", F.struct("a", "p", "b").alias("e"))


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "e")


def edges_of(c: Compiler, predicate: IRI | None, both: bool = False) -> DataFrame:
    """(a, b, e) of relationships, each once; ``both``: and once from its other end."""
    df = _edges(c, predicate).distinct()
    return df.union(_turned(df.where("a <> b"))) if both else df


def _leaving(c: Compiler, p: A.Hops, against: bool, nodes: DataFrame, subject: Var | None = None) -> DataFrame | None:
    """(a, b, e) of the edges that a walk can go by from ``nodes`` (one column ``node``, each once); None if there are no nodes.

    Few nodes are constants of scans; more are joined with the scans before edges are made distinct, so that no table of all edges
    is shuffled or written. ``subject`` is a variable that stands for the nodes and of which the planner may know more.
    """
    ways = [False, True] if p.both else [against]
    few = [r[0] for r in nodes.limit(FEW_NODES + 1).collect()]
    parts = []
    if len(few) <= FEW_NODES:
        for x in few:
            node = BNode(x[2:]) if x.startswith("_:") else IRI(x)
            parts += [_turned(_edges(c, p.predicate, o=node)) if way else _edges(c, p.predicate, node) for way in ways]
    else:
        near = F.broadcast(nodes) if nodes.count() <= BROADCAST_PAIRS else nodes
        for way in ways:
            found = _turned(_edges(c, p.predicate, o=subject)) if way else _edges(c, p.predicate, subject)
            parts.append(found.join(near, found["a"] == near["node"], "left_semi"))
    if not parts:
        return None
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out.distinct()  # an edge from a node to itself is the same either way


def _walks(c: Compiler, p: A.Hops, nodes: DataFrame, backwards: bool, subject: Var) -> DataFrame:
    """(a, b, n) of the walks of ``p`` that leave ``nodes`` (backwards: that end there), one row a walk."""
    against = p.reverse != backwards
    held = None
    if (against or p.both) and not c.source.same_names(p.predicate):
        # Each scan numbers rows without a key anew, so that all rounds have to read one table.
        held = edges_of(c, p.predicate, p.both)
        held = checkpoint(_turned(held) if against else held)
    parts, newest, walks, n = [], nodes, None, 0
    if p.low == 0:
        all_nodes = c.source.nodes()
        parts.append(all_nodes.join(nodes, "node", "left_semi").select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("bigint").alias("n")))
    while p.high is None or n < p.high:
        n += 1
        edges = _leaving(c, p, against, newest, subject if n == 1 else None) if held is None else held if n > 1 else held.join(nodes, held["a"] == nodes["node"], "left_semi")
        if edges is None:
            break
        if n == 1:
            walks = edges.select("a", "b", F.array("e").alias("path"))
        else:
            step = edges.select(F.col("a").alias("via"), F.col("b").alias("next"), F.col("e").alias("used"))
            walks = walks.join(step, (walks["b"] == step["via"]) & ~F.array_contains("path", step["used"]))
            walks = walks.select("a", F.col("next").alias("b"), F.concat("path", F.array("used")).alias("path"))
        walks = checkpoint(walks)
        if walks.isEmpty():  # no edge repeats, so walks end
            break
        if n >= p.low:
            parts.append(walks.select("a", "b", F.lit(n).cast("bigint").alias("n")))
        newest = walks.select(F.col("b").alias("node")).distinct()
    out = parts[0] if parts else c.spark.createDataFrame([], "a string, b string, n bigint")
    for x in parts[1:]:
        out = out.union(x)
    return out.select(F.col("b").alias("a"), F.col("a").alias("b"), "n") if backwards else out


def _all_walks(c: Compiler, t: A.Triple) -> DataFrame:
    """(a, b, n) of the walks between all nodes, or from one that is a constant, one row a walk."""
    p: A.Hops = t.p
    edges = edges_of(c, p.predicate, p.both)
    if p.high is None:
        edges = checkpoint(edges)
    if p.reverse:
        edges = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "e")
    step = edges.select(F.col("a").alias("via"), F.col("b").alias("next"), F.col("e").alias("used"))
    walks = edges.select("a", "b", F.array("e").alias("path"))
    if isinstance(t.s, IRI):
        walks = walks.where(F.col("a") == t.s.value)
    parts = []
    if p.low == 0:
        nodes = c.source.nodes()
        parts.append(nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("bigint").alias("n")))
    n = 0
    while p.high is None or n < p.high:
        n += 1
        if n > 1:
            walks = walks.join(step, (walks["b"] == step["via"]) & ~F.array_contains(walks["path"], step["used"])).select("a", F.col("next").alias("b"), F.concat("path", F.array("used")).alias("path"))
        if n >= p.low:
            parts.append(walks.select("a", "b", F.lit(n).cast("bigint").alias("n")))
        if p.high is None:  # no edge repeats, so walks end
            walks = checkpoint(walks)
            if walks.isEmpty():
                parts = parts or [walks.select("a", "b", F.lit(n).cast("bigint").alias("n"))]
                break
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def _hops(c: Compiler, t: A.Triple) -> Solutions:
    p: A.Hops = t.p
    for term, backwards in ((t.s, False), (t.o, True)):
        if isinstance(term, Var) and term.name in c.sides and c.graph_variable is None:
            # What the pattern is joined with tells an end: only walks from there are looked for.
            side = c.sides[term.name]
            nodes = side.df.select(lexical(*side.typed(term.name)).alias("node")).distinct()
            out = _walks(c, p, nodes, backwards, term)
            break
    else:
        out = _all_walks(c, t)
    ends = _ends(c, t, out) if p.length is None else None
    if ends is not None:
        return ends
    length = p.length
    found = _ends(c, A.Triple(t.s, t.p, t.o), out)
    kinds = dict(found.kinds)
    df = out
    columns: list[Column] = []
    seen: dict[str, Column] = {}
    for term, col in ((t.s, F.col("a")), (t.o, F.col("b"))):
        if isinstance(term, Var):
            if term.name in seen:
                df = df.where(seen[term.name] == col)
            else:
                seen[term.name] = col
                columns.append(col.alias(column_name(term.name)))
        elif isinstance(term, IRI):
            df = df.where(col == term.value)
    return Solutions(df.select(*columns, F.col("n").alias(column_name(length.name))), kinds | {length.name: INTEGER})


def shortest(c: Compiler, predicate: IRI | None, both: bool, most: int | None, starts: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """(a, b, n): least counts of edges between distinct nodes, by breadth-first rounds, at most ``most`` of them (None: until no pair is new).

    Only paths from nodes of ``starts``, or else to those of ``ends`` (one column each), are searched; without either, those between all pairs.
    """
    edges = edges_of(c, predicate, both).select("a", "b").where("a <> b").distinct()
    backwards = starts is None and ends is not None
    if backwards:
        edges = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = checkpoint(edges)
    step = edges.select(F.col("a").alias("via"), F.col("b").alias("next"))
    given = ends if backwards else starts
    newest = edges if given is None else edges.join(given.toDF("a").distinct(), "a", "left_semi")
    newest = checkpoint(newest.withColumn("n", F.lit(1).cast("bigint")))
    known, n = newest, 1
    while (most is None or n < most) and not newest.isEmpty():
        n += 1
        further = newest.join(step, newest["b"] == step["via"]).select("a", F.col("next").alias("b")).where("a <> b").distinct()
        newest = checkpoint(further.join(known, ["a", "b"], "left_anti").withColumn("n", F.lit(n).cast("bigint")))
        known = known.union(newest)
    return known.select(F.col("b").alias("a"), F.col("a").alias("b"), "n") if backwards else known


__all__ = ["Literal", "box_constant", "closure", "compile_path", "inline", "reach", "shortest"]
