"""Algebra nodes, paths and expressions, as the parsers make them and the compiler reads them."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from ..terms import IRI, BNode, Literal, Var

Term = Var | IRI | Literal | BNode


# Paths ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Seq:
    left: Any
    right: Any


@dataclass(frozen=True)
class Alt:
    left: Any
    right: Any


@dataclass(frozen=True)
class Inverse:
    path: Any


@dataclass(frozen=True)
class Closure:
    """Repetition with distinct ends: from ``least`` (0 or 1) to one (``?``) or to no bound (``*``, ``+``)."""

    path: Any
    least: int
    bound: bool


@dataclass(frozen=True)
class Hops:
    """Repetition of one relationship type (or any, if None) from low to high times (None: without end), one row a path in which no edge repeats."""

    predicate: IRI | None
    low: int
    high: int | None
    reverse: bool = False
    length: Var | None = None
    both: bool = False


@dataclass(frozen=True)
class NotIn:
    """Any predicate but those; inverse: any but those, read backwards."""

    forward: tuple[IRI, ...]
    inverse: tuple[IRI, ...]


# Expressions ---------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Call:
    """name: an operator sign, a built-in's name in capitals, or a function's IRI."""

    name: str
    args: tuple = ()


@dataclass(frozen=True)
class Aggregate:
    name: str
    arg: Any  # None for COUNT(*)
    distinct: bool = False
    separator: str = " "


@dataclass(frozen=True)
class Exists:
    pattern: Any
    negated: bool


# Operators -----------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Triple:
    s: Term
    p: Any
    o: Term


@dataclass
class BGP:
    triples: list[Triple] = field(default_factory=list)
    #: Patterns (variable, predicate, fresh variable) that the planner reads as columns that may be null.
    columns: list[Triple] = field(default_factory=list)


@dataclass
class Join:
    left: Any
    right: Any


@dataclass
class LeftJoin:
    left: Any
    right: Any
    condition: Any = None


@dataclass
class Filter:
    condition: Any
    child: Any


@dataclass
class Union:
    left: Any
    right: Any
    distinct: bool = False


@dataclass
class Minus:
    left: Any
    right: Any


@dataclass
class Extend:
    child: Any
    var: Var
    value: Any


@dataclass
class Values:
    vars: list[Var]
    rows: list[tuple]


@dataclass
class Unwind:
    child: Any
    values: Any
    var: Var


@dataclass
class Graph:
    name: Term
    child: Any


@dataclass
class Native:
    """A native graph query used as a table: its columns are bound to the variables by name, else by position."""

    vars: list[Var]
    text: str


@dataclass
class Group:
    child: Any
    keys: list[tuple[Var, Any]]
    aggregates: list[tuple[Var, Aggregate]]


@dataclass
class Project:
    child: Any
    vars: list[Var] | None  # None: all visible


@dataclass
class Distinct:
    child: Any


@dataclass
class OrderBy:
    child: Any
    keys: list[tuple[Any, bool]]  # (expression, ascending)


@dataclass
class Slice:
    child: Any
    offset: int
    limit: int | None


# Query forms ---------------------------------------------------------------------------------------
@dataclass
class Query:
    form: str  # SELECT, ASK, CONSTRUCT, DESCRIBE
    pattern: Any
    template: list[Triple] = field(default_factory=list)
    describe: list[Term] = field(default_factory=list)
    #: Graphs that make up the default graph, and the named graphs; both empty: all as stored.
    default: list[str] = field(default_factory=list)
    named: list[str] = field(default_factory=list)


@dataclass
class Update:
    """One update operation. kind: DATA, MODIFY, CLEAR, COPY, MOVE, ADD, LOAD or CREATE."""

    kind: str
    delete: list[tuple[Term | None, Triple]] = field(default_factory=list)
    insert: list[tuple[Term | None, Triple]] = field(default_factory=list)
    pattern: Any = None
    source: str | None = None
    target: str | None = None
    default: list[str] = field(default_factory=list)
    named: list[str] = field(default_factory=list)


def children(node: Any) -> list[Any]:
    return [getattr(node, f) for f in ("child", "left", "right") if hasattr(node, f)]


def show(node: Any, depth: int = 0) -> str:
    """The algebra as an indented tree."""
    pad = "  " * depth
    if isinstance(node, BGP):
        return pad + "BGP" + "".join(f"\n{pad}  {text(t.s)} {text(t.p)} {text(t.o)}" for t in node.triples) + "".join(f"\n{pad}  ({text(t.s)} {text(t.p)} {text(t.o)})" for t in node.columns)
    rest = {k: v for k, v in vars(node).items() if k not in ("child", "left", "right")}
    line = pad + type(node).__name__ + (" " + ", ".join(f"{k}={text(v)}" for k, v in rest.items()) if rest else "")
    return "\n".join([line, *(show(c, depth + 1) for c in children(node))])


def text(x: Any) -> str:
    if isinstance(x, Var):
        return "?" + x.name
    if isinstance(x, IRI):
        return f"<{x.value}>"
    if isinstance(x, Literal):
        return f'"{x.lex}"'
    if isinstance(x, Call):
        return f"{x.name}({', '.join(map(text, x.args))})"
    if isinstance(x, list | tuple):
        return "[" + ", ".join(map(text, x)) + "]"
    return str(x)
