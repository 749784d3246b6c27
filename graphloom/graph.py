"""The graph that users query and change.

A graph is a virtual one over mapped tables, or stored triples, whose snapshots are replaced by
updates. ``query`` gives native columns; ``terms`` gives boxed terms.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.expressions import Typed
from .operators import rules as R
from .operators import update as U
from .plans.compiler import Compiler
from .sources import readers
from .sources.mapping import MappedSource
from .sources.solutions import Solutions, column_name
from .sources.triples import SCHEMA, TripleSource, frame, same_value
from .sparql import algebra as A
from .sparql.parser import parse_query, parse_update
from .storage import snapshot
from .terms import IRI, LITERAL, NODE_KIND, BNode, Kind, Literal, Var, box, box_constant, lexical, plain


class TransactionProblem(RuntimeError):
    """A transaction was begun twice, or ended without being begun."""


#: Changes after which a graph's parts are written as one.
MOST_PARTS = 12
#: Triples (about 200 bytes each) of a change up to which it is broadcast to the stored ones.
BROADCAST_TRIPLES = 100_000


def _small(df: DataFrame) -> DataFrame:
    """A written frame, marked for broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_TRIPLES else df


class Graph:
    """Base: queries over a source, with backward rules."""

    def __init__(self, spark: SparkSession, rules: str | list[R.Rule] = "", prefixes: dict[str, str] | None = None):
        self.spark, self.prefixes = spark, dict(prefixes or {})
        #: Whether the planner merges patterns to scans; without, each pattern is a scan and joined.
        self.rewrites = True
        self.rules = R.parse_rules(rules) if isinstance(rules, str) else list(rules)

    def source(self) -> Any:
        raise NotImplementedError

    def compiler(self, trace: list[str] | None = None) -> Compiler:
        return Compiler(self.spark, self.source(), R.by_predicate(self.rules), trace, rewrites=self.rewrites)

    def dataset(self, default: list[str], named: list[str]) -> Any:
        """A source whose default graph is the union of some graphs, with some named graphs."""
        raise ValueError("tables have no graphs that FROM could name")

    def solutions(self, query: A.Query, trace: list[str] | None = None) -> Solutions:
        compiler = self.compiler(trace)
        if query.default or query.named:
            compiler.source = self.dataset(query.default, query.named)
        return compiler.compile(query.pattern)

    def query(self, text: str) -> DataFrame:
        """SELECT: a column a variable, native or as strings. ASK: a row with a boolean ``result``.

        CONSTRUCT and DESCRIBE: distinct triples (subject, predicate, object as strings).
        """
        q = parse_query(text, self.prefixes)
        if q.form == "SELECT":
            found = self.solutions(q)
            return found.df.select(*[plain(*found.typed(v)).alias(v) for v in found.kinds])
        if q.form == "ASK":
            return self.solutions(q).df.limit(1).agg((F.count("*") > 0).alias("result"))
        made = self.construct(text)
        return made.select(F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("o.lex").alias("object"))

    def terms(self, text: str) -> DataFrame:
        """SELECT with every variable as a boxed term."""
        found = self.solutions(parse_query(text, self.prefixes))
        return found.df.select(*[box(*found.typed(v)).alias(v) for v in found.kinds])

    def ask(self, text: str) -> bool:
        return self.query(text).first()["result"]

    def construct(self, text: str) -> DataFrame:
        """CONSTRUCT or DESCRIBE as distinct triples (s, p, o)."""
        q = parse_query(text, self.prefixes)
        if q.form == "DESCRIBE":
            return U.describe(self.compiler(), q)
        return U.instantiate(self.solutions(q), [(None, t) for t in q.template]).select("s", "p", "o").distinct()

    def native(self, text: str) -> DataFrame:
        """A native graph query, with plain columns."""
        from .operators import cypher

        found, names = cypher.run(Compiler(self.spark, self.source()), text)
        return found.df.select(*[plain(*found.typed(v)).alias(v) for v in names])

    def explain(self, text: str) -> str:
        """Algebra, the planner's notes and Spark's plan of a query."""
        q, trace = parse_query(text, self.prefixes), []
        found = self.solutions(q, trace)
        plan = found.df._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return "\n".join(["== Algebra ==", A.show(q.pattern), "== Planner ==", *trace, "== Spark ==", plan])

    def trace(self, text: str) -> dict[str, Any]:
        """Runs a SELECT and tells of it: planner's notes, rows, seconds, scans, exchanges, and whether a filter reached a scan."""
        q, notes = parse_query(text, self.prefixes), []
        begun = time.monotonic()
        found = self.solutions(q, notes).df
        planned = time.monotonic()
        rows = found.count()
        done = time.monotonic()
        plan = found._jdf.queryExecution().executedPlan().toString()
        return {
            "notes": notes, "rows": rows, "planning": planned - begun, "seconds": done - planned, "scans": plan.count("FileScan"), "exchanges": plan.count("Exchange "),
            "pushed": bool(re.search(r"PushedFilters: \[[^\]]", plan)),
        }

    # Triples ----------------------------------------------------------------------------------------
    def find(self, s: A.Term | None = None, p: IRI | None = None, o: A.Term | None = None) -> DataFrame:
        """Triples (s, p, o) that match; None matches all, literals match by value."""
        t = A.Triple(*(given if given is not None else Var(name) for given, name in ((s, "s"), (p, "p"), (o, "o"))))
        found = Compiler(self.spark, self.source()).compile(A.BGP([t]))

        def cell(name: str, term: A.Term | None) -> Typed:
            if name in found.kinds:
                return found.typed(name)
            return (F.lit(term.value if isinstance(term, IRI) else "_:" + term.label), NODE_KIND) if isinstance(term, IRI | BNode) else (box_constant(term), Kind("box"))

        return found.df.select(lexical(*cell("s", s)).alias("s"), lexical(*cell("p", p)).alias("p"), box(*cell("o", o)).alias("o"))

    def contains(self, s: A.Term | None = None, p: IRI | None = None, o: A.Term | None = None) -> bool:
        return not self.find(s, p, o).isEmpty()

    def size(self) -> int:
        return self.find().count()

    def is_empty(self) -> bool:
        return self.find().isEmpty()


class TableGraph(Graph):
    """A read-only graph over tables: see :class:`graphloom.sources.mapping.MappedSource`."""

    def __init__(self, spark: SparkSession, config: dict, frames: dict[str, DataFrame], rules: str | list[R.Rule] = "", prefixes: dict[str, str] | None = None):
        super().__init__(spark, rules, {"": config["base"], **(prefixes or {})})
        self._source = MappedSource.from_config(spark, config, frames)

    def source(self) -> MappedSource:
        return self._source


class TripleGraph(Graph):
    """Stored triples, with updates, transactions and forward rules.

    Stored and derived triples are kept apart, so that derived ones are found anew after deletions. A
    snapshot is written to the shared folder whenever a change is committed.
    """

    def __init__(self, spark: SparkSession, triples: DataFrame | None = None, rules: str | list[R.Rule] = "", prefixes: dict[str, str] | None = None):
        super().__init__(spark, rules, prefixes)
        self.base = (triples if triples is not None else spark.createDataFrame([], SCHEMA)).select("g", "s", "p", "o").distinct()
        self.derived: DataFrame | None = None
        self._staged: list[Callable[[DataFrame], DataFrame]] | None = None
        self._cached: TripleSource | None = None
        self._parts = self._derived_parts = 0
        if any(r.forward for r in self.rules):
            self._infer()

    @classmethod
    def load(cls, spark: SparkSession, path: str, form: str | None = None, **options: Any) -> TripleGraph:
        """Reads files of triples, whose parsed triples are written once."""
        return cls(spark, snapshot(readers.read(spark, path, form).select("g", "s", "p", "o").distinct(), "p", "s"), **options)

    @classmethod
    def parse(cls, spark: SparkSession, text: str, form: str = "turtle", **options: Any) -> TripleGraph:
        return cls(spark, frame(spark, [(None, t) for t in readers.PARSERS[form](text)]), **options)

    def source(self) -> TripleSource:
        if self._cached is None:
            whole = self.base if self.derived is None else self.base.unionByName(self.derived.withColumn("g", F.lit(None).cast("string")))
            self._cached = TripleSource(self.spark, whole)
        return self._cached

    def compiler(self, trace: list[str] | None = None) -> Compiler:
        raw = TripleSource(self.spark, self.base) if self.derived is not None else None
        return Compiler(self.spark, self.source(), R.by_predicate(self.rules), trace, raw=raw)

    def dataset(self, default: list[str], named: list[str]) -> TripleSource:
        merged = self.base.where(F.col("g").isin(default)).withColumn("g", F.lit(None).cast("string")).distinct()
        return TripleSource(self.spark, merged.unionByName(self.base.where(F.col("g").isin(named))))

    def _infer(self) -> None:
        own = self.base.where("g is null").select("s", "p", "o")
        self.derived = R.forward(own, self.rules)
        self._cached = None

    # Changes ----------------------------------------------------------------------------------------
    def apply(self, change: U.Change | Callable[[DataFrame], DataFrame]) -> None:
        """Changes the stored triples, now or at the end of the transaction."""
        if self._staged is not None:
            self._staged.append(change)
        else:
            self._commit([change])

    def _commit(self, changes: list[U.Change | Callable[[DataFrame], DataFrame]]) -> None:
        """Lays changes over the stored triples: only what goes and what comes is written.

        What goes is taken out when triples are read. After ``MOST_PARTS`` such layers all are written as one.
        """
        changes = [x for c in changes for x in ([U.Change(gone=c.gone), U.Change(more=c.more)] if isinstance(c, U.Change) else [c])]
        base, parts = self.base, self._parts
        added: list[DataFrame] | None = []  # as long as changes only add
        for c in changes:
            if not isinstance(c, U.Change):
                added, base, parts = None, c(base), parts + 1
            elif c.gone is not None:
                gone = snapshot(c.gone.select("g", "s", "p", "o").distinct())
                added, base, parts = None, U.without(base, _small(gone)), parts + 1
            elif c.more is not None:
                more = snapshot(c.more.select("g", "s", "p", "o").distinct())
                # The stored triples are read once, to find those that come again; none is written.
                new = snapshot(U.without(more, U.among(base, _small(more))), "p", "s")
                if not new.isEmpty():
                    base, parts = base.unionByName(new), parts + 1
                    added = None if added is None else [*added, new]
        self.base, self._parts, self._cached = (snapshot(base, "p", "s"), 0, None) if parts >= MOST_PARTS else (base, parts, None)
        if any(r.forward for r in self.rules):
            if added is None or self.derived is None:
                self._infer()
            else:
                for new in added:
                    self._derive(new)

    def _derive(self, new: DataFrame) -> None:
        """Adds what follows from new triples."""
        known = self.base.where("g is null").select("s", "p", "o").unionByName(self.derived)
        self.derived = self.derived.unionByName(R.forward(known, self.rules, newest=new.where("g is null").select("s", "p", "o")))
        self._derived_parts += 1
        if self._derived_parts >= MOST_PARTS:
            self.derived, self._derived_parts = snapshot(self.derived, "p", "s"), 0

    def begin(self) -> None:
        if self._staged is not None:
            raise TransactionProblem("a transaction is open already")
        self._staged = []

    def commit(self) -> None:
        if self._staged is None:
            raise TransactionProblem("no transaction is open")
        changes, self._staged = self._staged, None
        if changes:
            self._commit(changes)

    def abort(self) -> None:
        if self._staged is None:
            raise TransactionProblem("no transaction is open")
        self._staged = None

    @contextmanager
    def transaction(self) -> Iterator[TripleGraph]:
        """Commits at the end, or aborts if an exception leaves the block."""
        self.begin()
        try:
            yield self
        except BaseException:
            self.abort()
            raise
        self.commit()

    def execute(self, action: Callable[[TripleGraph], Any]) -> Any:
        """Runs an action in a transaction and returns what it returns."""
        with self.transaction():
            return action(self)

    def add(self, *triples: A.Triple, graph: str | None = None) -> None:
        self.apply(U.Change(more=frame(self.spark, [(graph, t) for t in triples])))

    def extend(self, triples: DataFrame) -> None:
        """Adds a frame of (g, s, p, o) at once, and derives only what follows from what is new in it."""
        self.add_all(triples)

    def add_all(self, triples: DataFrame) -> None:
        """Adds a frame of (g, s, p, o)."""
        self.apply(U.Change(more=triples))

    def remove(self, s: A.Term | None = None, p: IRI | None = None, o: A.Term | None = None, graph: str | None = None) -> None:
        """Removes the triples that match; a literal by its value and datatype, so that others of the subject stay."""
        test = F.col("g").isNull() if graph is None else F.col("g") == graph
        for given, col in ((s, F.col("s")), (p, F.col("p"))):
            if given is not None:
                test = test & (col == (given.value if isinstance(given, IRI) else "_:" + given.label))
        if isinstance(o, Literal):
            test = test & (F.col("o.kind") == LITERAL) & same_value(F.col("o"), o)
        elif o is not None:
            test = test & (F.col("o") == box_constant(o))
        self.apply(lambda df: df.where(~F.coalesce(test, F.lit(False))))

    def clear(self) -> None:
        self.apply(lambda df: df.where(F.lit(False)))

    def update(self, text: str) -> None:
        """Runs SPARQL updates in turn; each sees what those before it did, but in a transaction only what was committed."""
        for u in parse_update(text, self.prefixes):
            U.run(self, u)

    def dump(self, path: str, form: str = "nt") -> None:
        """Writes the graph to a folder, as N-Triples (``nt``) or Turtle (``ttl``) files."""
        writers = {"nt": readers.write_ntriples, "ttl": readers.write_turtle}
        writers[form](self.find(), path)

    def turtle(self) -> str:
        """The graph as Turtle text, for graphs that fit the driver."""
        return readers.turtle(self.find().collect())


__all__ = ["Graph", "TableGraph", "TransactionProblem", "TripleGraph", "column_name"]
