"""Stored triples: a DataFrame of subject, predicate and boxed object, with the graph's name.

A catalogue of predicates (the kinds and datatypes of their objects, one small aggregation a
snapshot) tells the planner which columns can be native and which patterns are empty.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import equal
from ..sparql import algebra as A
from ..terms import BNODE, BOX, BOX_KIND, INTEGERS, IRI, LITERAL, NODE, NODE_KIND, SPARK_TYPES, XSD, BNode, Kind, Literal, Var, box_constant, literal_kind, spark_literal
from .solutions import Solutions, column_name, empty, union

SCHEMA = f"g string, s string, p string, o {BOX}"
#: Predicates that a catalogue lists; with more, object columns are boxed.
MOST_PREDICATES = 10_000


class TripleSource:
    """The triples of one graph: the default graph (name None) or a named one."""

    #: The variable that patterns bind to the graph's name.
    variable: str | None = None

    def __init__(self, spark: SparkSession, df: DataFrame, name: str | None = None):
        self.spark, self.all, self.name = spark, df, name
        self.df = df.where(F.col("g").isNull() if name is None else F.col("g") == name).select("s", "p", "o")

    @cached_property
    def catalogue(self) -> dict[str, set[tuple[int, str | None, bool]]] | None:
        """For each predicate, what its objects are: (kind, datatype, has a language); None if there are too many predicates."""
        rows = self.df.groupBy("p", "o.kind", "o.dt", F.col("o.lang").isNotNull().alias("tagged")).agg(F.count("*")).limit(MOST_PREDICATES + 1).collect()
        if len(rows) > MOST_PREDICATES:
            return None
        out: dict[str, set] = {}
        for r in rows:
            out.setdefault(r["p"], set()).add((r["kind"], r["dt"], r["tagged"]))
        return out

    def predicates(self) -> set[str] | None:
        return None if self.catalogue is None else set(self.catalogue)

    def implied(self, triple: A.Triple, others: list[A.Triple]) -> bool:
        return False

    def _object(self, predicate: A.Term) -> tuple[Column, Kind]:
        """The object column, native if the catalogue allows."""
        kinds = self.catalogue.get(predicate.value, set()) if self.catalogue is not None and isinstance(predicate, IRI) else None
        if not kinds:
            return F.col("o"), BOX_KIND
        if all(k != LITERAL for k, _, _ in kinds):
            return F.col("o.lex"), NODE_KIND
        if all(k == LITERAL and not tagged for k, _, tagged in kinds):
            found = {XSD + "integer" if dt in INTEGERS else dt for _, dt, _ in kinds}
            if len(found) == 1:
                kind = literal_kind(found.pop())
                name = SPARK_TYPES.get(kind.dt, "string")
                if name == "boolean":
                    return F.col("o.lex").isin("true", "1"), kind
                # Malformed lexical forms stay terms, so only well-formed ones make a column native.
                return (F.col("o.lex") if name == "string" else F.col("o.lex").try_cast(name)), kind
        return F.col("o"), BOX_KIND

    def star(self, subject: A.Term, triples: list[A.Triple]) -> Solutions:
        raise NotImplementedError("patterns of stored triples are joined one by one")

    def pattern(self, t: A.Triple) -> Solutions:
        """Solutions of one triple pattern."""
        bound: dict = {} if self.variable is None else {self.variable: (F.col("g"), NODE_KIND)}
        names = {**{v: NODE_KIND for v in bound}, **{x.name: NODE_KIND for x in (t.s, t.p, t.o) if isinstance(x, Var)}}
        if self.catalogue is not None and isinstance(t.p, IRI) and t.p.value not in self.catalogue:
            return empty(self.spark, names)
        df = self.df
        if isinstance(t.p, IRI):
            df = df.where(F.col("p") == t.p.value)
        if not isinstance(t.s, Var):
            if isinstance(t.s, Literal):
                return empty(self.spark, names)
            df = df.where(F.col("s") == (t.s.value if isinstance(t.s, IRI) else "_:" + t.s.label))
        obj = self._object(t.p)
        if isinstance(t.o, Literal):
            df = df.where(F.col("o.kind") == LITERAL).where(same_value(F.col("o"), t.o))
        elif not isinstance(t.o, Var):
            df = df.where(F.col("o") == box_constant(t.o))
        for term, value in ((t.s, (F.col("s"), NODE_KIND)), (t.p, (F.col("p"), NODE_KIND)), (t.o, obj)):
            if isinstance(term, Var):
                if term.name in bound:
                    df = df.where(equal(bound[term.name], value))
                else:
                    bound[term.name] = value
        out = Solutions(df, {})
        return out.select(bound) if bound else Solutions(df.select(), {})

    def nodes(self) -> DataFrame:
        objects = self.df.where(F.col("o.kind") != LITERAL).select(F.col("o.lex").alias("node"))
        return self.df.select(F.col("s").alias("node")).union(objects).distinct()

    def same_names(self, predicate: IRI | None) -> bool:
        """Stored subjects have their names."""
        return True

    def graph(self, name: str) -> TripleSource:
        return TripleSource(self.spark, self.all, name)

    def graphs(self, variable: str) -> NamedGraphs:
        """All named graphs at once, with the graph's name in a variable."""
        return NamedGraphs(self.spark, self.all, variable)

    def blank_objects(self) -> bool:
        """Whether objects can be blank nodes."""
        return self.catalogue is None or any(kind == BNODE for kinds in self.catalogue.values() for kind, _, _ in kinds)


class NamedGraphs(TripleSource):
    """The triples of all named graphs. Every pattern binds ``variable`` to the graph's name, so that patterns join within a graph."""

    def __init__(self, spark: SparkSession, df: DataFrame, variable: str):
        self.spark, self.all, self.variable = spark, df, variable
        self.df = df.where("g is not null").select("g", "s", "p", "o")

    def names(self) -> Solutions:
        return Solutions(self.df.select(F.col("g").alias(column_name(self.variable))).distinct(), {self.variable: NODE_KIND})

    def nodes(self) -> DataFrame:
        objects = self.df.where(F.col("o.kind") != LITERAL).select("g", F.col("o.lex").alias("node"))
        return self.df.select("g", F.col("s").alias("node")).union(objects).distinct()


def same_value(o: Column, term: Literal) -> Column:
    """Whether a boxed literal has the value of a constant: numbers by value, others by term."""
    value, kind = spark_literal(term)
    if kind.form == "literal" and kind.dt in (XSD + "integer", XSD + "decimal", XSD + "double", XSD + "float", XSD + "dateTime", XSD + "date", XSD + "boolean"):
        return F.coalesce(equal((o, BOX_KIND), (value, kind)), F.lit(False))
    return o == box_constant(term)


def row(graph: str | None, t: A.Triple) -> tuple:
    """A given triple as a row of ``SCHEMA``."""

    def cell(term) -> tuple:
        if isinstance(term, Literal):
            return (LITERAL, term.lex, term.dt, term.lang)
        return (BNODE, "_:" + term.label, None, None) if isinstance(term, BNode) else (NODE, term.value, None, None)

    return (graph, cell(t.s)[1], t.p.value, cell(t.o))


def frame(spark: SparkSession, triples: list[tuple[str | None, A.Triple]]) -> DataFrame:
    """Given triples as a frame of ``SCHEMA``."""
    return spark.createDataFrame([row(g, t) for g, t in triples], SCHEMA)


__all__ = ["NamedGraphs", "SCHEMA", "TripleSource", "frame", "row", "same_value", "union"]
