"""SPARQL Update, CONSTRUCT and DESCRIBE: templates instantiated for each solution."""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.compiler import Compiler
from ..sources import readers
from ..sources.solutions import Solutions
from ..sources.triples import SCHEMA, frame
from ..sparql import algebra as A
from ..sparql.parser import ground
from ..storage import snapshot
from ..terms import BOX as BOXED
from ..terms import BNODE, IRI, LITERAL, BNode, Var, box, box_constant, lexical
from ..terms import NODE_KIND as NODE

if TYPE_CHECKING:
    from ..graph import TripleGraph


def instantiate(found: Solutions, template: list[tuple[A.Term | None, A.Triple]], fresh: bool = True) -> DataFrame:
    """(g, s, p, o) for each solution and template triple; those with an unbound or misplaced term are left out.

    Blank nodes of a template are new for every solution.
    """
    if not template:
        return found.df.sparkSession.createDataFrame([], SCHEMA)
    df = found.df.withColumn("_row", F.monotonically_increasing_id()) if fresh else found.df

    def cell(term: A.Term) -> Column:
        if isinstance(term, Var) and term.name.startswith("_b"):
            return box(F.concat(F.lit(f"_:{term.name}-"), F.col("_row").cast("string")), NODE)
        if isinstance(term, Var):
            return box(*found.typed(term.name)) if term.name in found.kinds else F.lit(None).cast(BOXED)
        return box_constant(term)

    rows = [
        F.struct(
            (F.lit(None).cast("string") if g is None else cell(g)["lex"]).alias("g"), cell(t.s).alias("s"), cell(t.p).alias("p"), cell(t.o).alias("o"), F.lit(g is not None).alias("named")
        )
        for g, t in template
    ]
    flat = df.select(F.inline(F.array(*rows)))
    good = (F.col("s.kind") != LITERAL) & (F.col("p.kind") == 2) & F.col("o").isNotNull() & (~F.col("named") | F.col("g").isNotNull())
    return flat.where(F.coalesce(good, F.lit(False))).select("g", F.col("s.lex").alias("s"), F.col("p.lex").alias("p"), "o")



def describe(c: Compiler, q: A.Query) -> DataFrame:
    """Outgoing triples of the resources, and those of blank nodes that they lead to.

    Each resource is a pattern of its own, with the resource as subject or joined with the query's
    pattern, so that only tables that can hold it are read.
    """
    p, o = Var("_p"), Var("_o")

    def outgoing(subject: A.Term, pattern: object | None) -> DataFrame:
        triple = A.BGP([A.Triple(subject, p, o)])
        found = c.compile(triple if pattern is None else A.Join(A.Distinct(A.Project(pattern, [subject])), triple))
        s = F.lit(subject.value) if isinstance(subject, IRI) else lexical(*found.typed(subject.name))
        return found.df.select(s.alias("s"), lexical(*found.typed(p.name)).alias("p"), box(*found.typed(o.name)).alias("o"))

    parts = [outgoing(t, None) for t in q.describe if isinstance(t, IRI)]
    if q.pattern is not None:
        names = [t for t in q.describe if isinstance(t, Var)] or [Var(v) for v in c.compile(q.pattern).kinds if not v.startswith("_")]
        parts += [outgoing(v, q.pattern) for v in names]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    out = out.distinct()
    if not c.source.blank_objects():
        return out
    triples = all_triples(c)
    newest = out = snapshot(out)
    while True:
        blanks = newest.where(F.col("o.kind") == BNODE).select(F.col("o.lex").alias("s")).distinct().join(out.select("s").distinct(), "s", "left_anti")
        newest = snapshot(triples.join(blanks, "s", "left_semi"))
        if newest.isEmpty():
            return out.distinct()
        out = out.unionByName(newest)


def all_triples(c: Compiler) -> DataFrame:
    found = c.compile(A.BGP([A.Triple(Var("s"), Var("p"), Var("o"))]))
    return found.df.select(lexical(*found.typed("s")).alias("s"), lexical(*found.typed("p")).alias("p"), box(*found.typed("o")).alias("o"))


@dataclass
class Change:
    """Triples (g, s, p, o) that go, and then such that come."""

    gone: DataFrame | None = None
    more: DataFrame | None = None


def _same(df: DataFrame, others: DataFrame, how: str) -> DataFrame:
    same = F.col("a.g").eqNullSafe(F.col("b.g")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.p") == F.col("b.p")) & F.col("a.o").eqNullSafe(F.col("b.o"))
    return df.alias("a").join(others.alias("b"), same, how)


def without(df: DataFrame, gone: DataFrame) -> DataFrame:
    """Triples (g, s, p, o) that are not among others, as whole terms."""
    return _same(df, gone, "left_anti")


def among(df: DataFrame, others: DataFrame) -> DataFrame:
    """Triples (g, s, p, o) that are among others, as whole terms."""
    return _same(df, others, "left_semi")


def run(graph: TripleGraph, u: A.Update) -> None:
    spark = graph.spark
    if u.kind == "DATA":
        gone = frame(spark, [(g.value if g else None, _ground(t)) for g, t in u.delete]) if u.delete else None
        more = frame(spark, [(g.value if g else None, _ground(t)) for g, t in u.insert]) if u.insert else None
        graph.apply(Change(gone, more))
    elif u.kind == "MODIFY":
        source = graph.dataset(u.default, u.named) if u.default or u.named else graph.source()
        found = Compiler(spark, source).compile(u.pattern)
        # Deletions come first, and both are instantiated from the state before.
        graph.apply(Change(instantiate(found, u.delete) if u.delete else None, instantiate(found, u.insert) if u.insert else None))
    elif u.kind == "CLEAR":
        if u.target == "ALL":
            graph.clear()
        elif u.target == "NAMED":
            graph.apply(lambda df: df.where("g is null"))
        else:
            graph.apply(lambda df: df.where(~_in(u.target)))
    elif u.kind in ("COPY", "MOVE", "ADD"):

        def copied(df: DataFrame) -> DataFrame:
            moved = df.where(_in(u.source)).withColumn("g", F.lit(u.target).cast("string"))
            rest = df.where(~_in(u.target))
            rest = rest.where(~_in(u.source)) if u.kind == "MOVE" else rest
            return rest.unionByName(moved)

        if u.source != u.target:
            graph.apply(Change(more=graph.base.where(_in(u.source)).withColumn("g", F.lit(u.target).cast("string"))) if u.kind == "ADD" else copied)
    elif u.kind == "LOAD":
        more = readers.read(spark, u.source.removeprefix("file://") if u.source.startswith("file://") else u.source)
        graph.add_all(more.withColumn("g", F.lit(u.target).cast("string")) if u.target else more)


def _in(name: str | None) -> Column:
    return F.col("g").isNull() if name is None else F.coalesce(F.col("g") == name, F.lit(False))


def _ground(t: A.Triple) -> A.Triple:
    t = A.Triple(ground(t.s), ground(t.p), ground(t.o))
    if any(isinstance(x, Var) for x in (t.s, t.p, t.o)):
        raise ValueError("data can't hold variables")
    return t


__all__ = ["BNode", "Change", "among", "describe", "instantiate", "run", "without"]
