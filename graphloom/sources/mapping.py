"""Tables as a virtual graph.

A table's rows are subjects of one class. Their IRIs are a template with the key column; columns are
predicates with literal objects, or, as foreign keys, with objects under another table's template.
Patterns with one subject become a single scan of the tables that can answer all of them; keys are
joined raw, and IRIs are made only for output, so filters and columns reach the file scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import Typed, equal
from ..sparql import algebra as A
from ..terms import BOX_KIND, INTEGER, IRI, TYPE, Kind, Literal, Var, box, kind_of_type, spark_literal
from .solutions import Solutions, column_name, empty, union


#: Bits of the magnitude of Spark's integers.
BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


class NotStable(ValueError):
    """Rows without a key were to be matched across scans."""


@dataclass
class Property:
    column: Column
    kind: Kind
    #: For an edge that always has its target in the graph.
    complete: bool = False


@dataclass
class Table:
    name: str
    df: DataFrame
    cls: str
    prefix: str
    key: str | None
    properties: dict[str, Property] = field(default_factory=dict)

    def subject(self) -> Typed:
        if self.key is None:  # each scan numbers its rows anew: see NotStable
            return F.monotonically_increasing_id(), Kind("node", prefix=f"_:row-{self.name}-")
        return F.col(f"`{self.key}`"), Kind("node", prefix=self.prefix)


class MappedSource:
    """A virtual graph over tables."""

    def __init__(self, spark: SparkSession, tables: list[Table]):
        self.spark, self.tables = spark, tables

    @classmethod
    def from_config(cls, spark: SparkSession, config: dict, frames: dict[str, DataFrame]) -> MappedSource:
        """From a mapping: {base, tables: {name: {class, key, columns?, edges: {predicate: {column, to, complete}}, computed: {predicate: sql}}}}.

        Tables that ``frames`` lacks are left out.
        """
        base, tables = config["base"], []
        prefix = {name: f"{base}{name}/" for name in config["tables"]}
        for name, spec in config["tables"].items():
            if name not in frames:
                continue
            df = frames[name]
            properties = {}
            for f in df.schema.fields:
                simple = f.dataType.simpleString()
                if (spec.get("columns") is None or f.name in spec["columns"]) and not simple.startswith(("array", "map", "struct", "binary")):
                    col = F.col(f"`{f.name}`").cast("bigint") if kind_of_type(simple) == INTEGER else F.col(f"`{f.name}`")
                    properties[base + f.name] = Property(col, kind_of_type(simple))
            for predicate, sql in (spec.get("computed") or {}).items():
                dt = sql.get("datatype") if isinstance(sql, dict) else None
                text = sql["sql"] if isinstance(sql, dict) else sql
                kind = Kind("literal", dt) if dt else kind_of_type(df.select(F.expr(text)).schema[0].dataType.simpleString())
                properties[base + predicate] = Property(F.expr(text), kind)
            for predicate, edge in (spec.get("edges") or {}).items():
                properties[base + predicate] = Property(F.col(f"`{edge['column']}`"), Kind("node", prefix=prefix[edge["to"]]), edge.get("complete", False))
            tables.append(Table(name, df, base + spec["class"], prefix[name], spec.get("key"), properties))
        return cls(spark, tables)

    # What the planner asks --------------------------------------------------------------------------
    def predicates(self) -> set[str]:
        return {TYPE, *(p for t in self.tables for p in t.properties)}

    def implied(self, triple: A.Triple, others: list[A.Triple]) -> bool:
        """Whether a type pattern adds nothing: its subject is the target of a complete edge into that class."""
        if triple.p != IRI(TYPE) or not isinstance(triple.o, IRI) or not isinstance(triple.s, Var):
            return False
        for t in others:
            if t.o == triple.s and isinstance(t.p, IRI) and t is not triple:
                owners = [x for x in self.tables if t.p.value in x.properties]
                if owners and all(x.properties[t.p.value].complete and self._class_of(x.properties[t.p.value].kind.prefix) == triple.o.value for x in owners):
                    return True
        return False

    def _class_of(self, prefix: str | None) -> str | None:
        return next((t.cls for t in self.tables if t.prefix == prefix), None)

    def targets(self, predicate: str) -> set[str] | None:
        """The templates that a predicate's objects can have; None if they can be other nodes too."""
        kinds = [t.properties[predicate].kind for t in self.tables if predicate in t.properties]
        return {k.prefix for k in kinds} if all(k.form == "node" and k.prefix is not None for k in kinds) else None

    def star(self, subject: A.Term, triples: list[A.Triple], columns: list[A.Triple] = (), prefixes: set[str] | None = None) -> Solutions:
        """Solutions of patterns that share a subject: one scan of each table that can answer them all.

        ``prefixes`` are the only templates that the subject can have, if that is known. ``columns`` are patterns of the subject that need not match; a row is a subject, so they add no rows.
        """
        own = [t for t in self.tables if prefixes is None or t.prefix in prefixes]
        parts = [s for t in own if (s := self._scan(t, subject, triples, columns)) is not None]
        names = {x.name: BOX_KIND for t in [*triples, *columns] for x in (subject, t.p, t.o) if isinstance(x, Var)}
        if not parts:
            return empty(self.spark, names)
        out = union(parts)
        for t in columns:
            if t.o.name not in out.kinds:  # no table has it
                out = out.extend(t.o.name, (F.lit(None).cast("string"), Kind("node", maybe=True)))
        return out

    def _scan(self, table: Table, subject: A.Term, triples: list[A.Triple], columns: list[A.Triple] = ()) -> Solutions | None:
        own, kind = table.subject()
        conditions: list[Column] = []
        bound: dict[str, Typed] = {}
        if isinstance(subject, IRI):
            key = self._key(table, subject.value)
            if key is None:
                return None
            conditions.append(own == key)
        elif isinstance(subject, Var):
            bound[subject.name] = (own, kind)
        else:
            return None

        def match(obj: A.Term, value: Typed) -> bool:
            col, k = value
            if isinstance(obj, Var):
                if obj.name in bound:
                    conditions.append(equal(bound[obj.name], value))
                else:
                    bound[obj.name] = value
                return True
            if isinstance(obj, IRI):
                if k.form != "node" or (k.prefix is not None and not obj.value.startswith(k.prefix)):
                    return False
                key = obj.value[len(k.prefix) :] if k.prefix else obj.value
                target = next((t for t in self.tables if t.prefix == k.prefix), None)
                typed = self._key(target, obj.value) if target else F.lit(key)
                if typed is None:
                    return False
                conditions.append(col == typed)
                return True
            if isinstance(obj, Literal):
                if k.form != "literal":
                    return False
                conditions.append(equal(value, spark_literal(obj)))
                return True
            return False

        unknown = []
        for t in triples:
            if isinstance(t.p, Var):
                unknown.append(t)
            elif t.p.value == TYPE:
                if isinstance(t.o, IRI):
                    if t.o.value != table.cls:
                        return None
                elif not match(t.o, (F.lit(table.cls), Kind("node"))):
                    return None
            else:
                prop = table.properties.get(t.p.value)
                if prop is None or not match(t.o, (prop.column, prop.kind)):
                    return None
                conditions.append(prop.column.isNotNull())
        for t in columns:
            prop = table.properties.get(t.p.value)
            if prop:
                bound[t.o.name] = (prop.column, prop.kind.may_lack())
        df = table.df
        if conditions:
            condition = conditions[0]
            for c in conditions[1:]:
                condition = condition & c
            df = df.where(condition)
        out = Solutions(df, {}).select(bound) if bound and not unknown else None
        if unknown:
            # Rows of (predicate, object) for each column, made in the same scan.
            everything = [(F.lit(TYPE), box(F.lit(table.cls), Kind("node")))] + [(F.lit(p), box(x.column, x.kind)) for p, x in table.properties.items()]
            names = [f"_po{i}" for i in range(len(unknown))]
            df = df.select(*[c.alias(column_name(v)) for v, (c, _) in bound.items()], F.array(*[F.struct(p.alias("p"), o.alias("o")) for p, o in everything]).alias("_all"))
            out = Solutions(df, {v: k for v, (_, k) in bound.items()})
            for name, t in zip(names, unknown, strict=True):
                df = out.df.withColumn(name, F.explode("_all")).where(F.col(f"{name}.o").isNotNull())
                out = Solutions(df, out.kinds)
                for term, col, k in ((t.p, F.col(f"{name}.p"), Kind("node")), (t.o, F.col(f"{name}.o"), BOX_KIND)):
                    if isinstance(term, Var) and term.name not in out.kinds:
                        out = out.extend(term.name, (col, k))
                    elif isinstance(term, Var):
                        out = out.where(equal(out.typed(term.name), (col, k)))
                    elif isinstance(term, IRI):
                        out = out.where(equal((col, k), (F.lit(term.value), Kind("node"))))
                    else:
                        out = out.where(equal((col, k), spark_literal(term)))
            out = out.select(out.columns())
        return out if out is not None else Solutions(df.select(), {})

    @staticmethod
    def _key(table: Table, iri: str) -> Column | None:
        """The key of an IRI as a literal of the key's type; None if it is not one of the table's."""
        if table.key is None or not iri.startswith(table.prefix):
            return None
        text, name = iri[len(table.prefix) :], table.df.schema[table.key].dataType.simpleString()
        if name in BITS:  # only the key's own spelling is the IRI that the template makes
            return F.lit(int(text)).cast(name) if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", text, re.ASCII) and -(1 << BITS[name]) <= int(text) < 1 << BITS[name] else None
        return F.lit(text)

    def nodes(self) -> DataFrame:
        """All subjects and node objects, as strings in column ``node``, each once."""
        parts = []
        for t in self.tables:
            if t.key is not None:
                parts.append(t.df.select(F.concat(F.lit(t.prefix), F.col(f"`{t.key}`").cast("string")).alias("node")))
            parts += [t.df.select(F.concat(F.lit(p.kind.prefix), p.column.cast("string")).alias("node")).where("node is not null") for p in t.properties.values() if p.kind.form == "node"]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out.distinct()

    def same_names(self, predicate: IRI | None) -> bool:
        """Whether each scan names the subjects of a predicate's edges (None: of all edges) alike: rows without a key are numbered anew."""
        return all(t.key is not None or not any(x.kind.form == "node" and predicate in (None, IRI(p)) for p, x in t.properties.items()) for t in self.tables)

    def graph(self, name: str) -> MappedSource:
        return MappedSource(self.spark, [])

    def graphs(self, variable: str) -> None:
        """Tables have no named graphs."""
        return None

    def blank_objects(self) -> bool:
        """Objects of edges are under templates, so none is a blank node."""
        return False


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
