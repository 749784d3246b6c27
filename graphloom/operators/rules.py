"""Inference rules ``[name: body -> head]`` (forward) and ``[name: head <- body]`` (backward).

Backward rules are rewritten into queries where their predicate is asked for. Forward rules are run to
a fixpoint, semi-naively: in each round every rule is evaluated once for each body pattern, with that
pattern over the newest triples only, and what is known already is dropped by an anti-join.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.solutions import Solutions, column_name, union
from ..sources.triples import TripleSource
from ..sparql import algebra as A
from ..sparql.parser import Reader, SyntaxProblem
from ..storage import snapshot
from ..terms import IRI, OWL, RDFS, TYPE, Kind, Var, box, box_constant, lexical

if TYPE_CHECKING:
    from ..plans.compiler import Compiler


@dataclass(frozen=True)
class Rule:
    name: str
    body: tuple[A.Triple, ...]
    head: tuple[A.Triple, ...]
    forward: bool
    #: Pairs of terms that must differ.
    differ: tuple[tuple[A.Term, A.Term], ...] = ()


def parse_rules(text: str) -> list[Rule]:
    """Rules of a file: ``@prefix`` lines, ``@include <...>`` of a built-in set, comments, and rules in brackets."""
    prefixes = {"rdf": TYPE[: -len("type")], "rdfs": RDFS, "owl": OWL, "xsd": "http://www.w3.org/2001/XMLSchema#"}
    rules: list[Rule] = []
    bare = re.sub(r"(?m)^\s*(?:#|//).*$", "", text)
    for name, iri in re.findall(r"@prefix\s+([\w-]*):\s*<([^>]*)>", bare):
        prefixes[name] = iri
    for wanted in re.findall(r"@include\s+<([^>]*)>", bare):
        rules += INCLUDED.get(wanted.lower(), lambda: [])()
    bare = re.sub(r"@(?:prefix\s+[\w-]*:|include)\s*<[^>]*>\s*\.?", "", bare)
    for body in re.findall(r"\[((?:[^\[\]\"]|\"[^\"]*\")*)\]", bare):
        name, _, rest = body.partition(":") if re.match(r"\s*[\w-]+\s*:(?!\S*//)", body) else ("", "", body)
        arrow = "->" if "->" in rest else "<-"
        if arrow not in rest:
            raise SyntaxProblem(f"a rule needs -> or <-: {body.strip()!r}")
        left, right = rest.split(arrow, 1)
        (l_triples, l_differ), (r_triples, r_differ) = _clauses(left, prefixes), _clauses(right, prefixes)
        if arrow == "->":
            rules.append(Rule(name.strip(), tuple(l_triples), tuple(r_triples), True, tuple(l_differ)))
        else:
            rules.append(Rule(name.strip(), tuple(r_triples), tuple(l_triples), False, tuple(r_differ)))
    return rules


def _clauses(text: str, prefixes: dict[str, str]) -> tuple[list[A.Triple], list]:
    r = Reader(text, prefixes)
    triples, differ = [], []
    while r.kind != "end":
        if r.accept(","):
            continue
        if r.kind == "word" and r.text in ("notEqual",):
            r.at += 1
            r.expect("(")
            a = r.term()
            r.accept(",")
            differ.append((a, r.term()))
        else:
            r.expect("(")
            s, p = r.term(), (IRI(TYPE) if r.kind == "word" and r.text == "a" and r.expect("A") else r.term())
            triples.append(A.Triple(s, p, r.term()))
        r.expect(")")
    return triples, differ


def owl_rules() -> list[Rule]:
    """Subclasses, subproperties, domains, ranges, inverse, symmetric and transitive properties."""
    x, y, z, p, q, c, d = (Var(n) for n in "xyzpqcd")
    t, sub, subp = IRI(TYPE), IRI(RDFS + "subClassOf"), IRI(RDFS + "subPropertyOf")
    T = A.Triple
    made = [
        ("subclass", [T(x, t, c), T(c, sub, d)], [T(x, t, d)]),
        ("subclass-chain", [T(c, sub, d), T(d, sub, x)], [T(c, sub, x)]),
        ("subproperty", [T(x, p, y), T(p, subp, q)], [T(x, q, y)]),
        ("subproperty-chain", [T(p, subp, q), T(q, subp, x)], [T(p, subp, x)]),
        ("domain", [T(x, p, y), T(p, IRI(RDFS + "domain"), c)], [T(x, t, c)]),
        ("range", [T(x, p, y), T(p, IRI(RDFS + "range"), c)], [T(y, t, c)]),
        ("inverse", [T(x, p, y), T(p, IRI(OWL + "inverseOf"), q)], [T(y, q, x)]),
        ("inverse-back", [T(x, q, y), T(p, IRI(OWL + "inverseOf"), q)], [T(y, p, x)]),
        ("symmetric", [T(x, p, y), T(p, t, IRI(OWL + "SymmetricProperty"))], [T(y, p, x)]),
        ("transitive", [T(x, p, y), T(y, p, z), T(p, t, IRI(OWL + "TransitiveProperty"))], [T(x, p, z)]),
    ]
    return [Rule(n, tuple(b), tuple(h), True) for n, b, h in made]


INCLUDED = {"owlmicro": owl_rules, "owl": owl_rules, "rdfs": owl_rules}


def by_predicate(rules: list[Rule]) -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for r in rules:
        for t in r.head:
            if not r.forward and isinstance(t.p, IRI):
                out.setdefault(t.p.value, []).append(r)
    return out


def _substituted(rule: Rule, head: A.Triple, goal: A.Triple, tag: str) -> tuple[list[A.Triple], list, dict[str, A.Term]]:
    """The body with its variables renamed apart and the goal's constants put in."""
    names: dict[Var, A.Term] = {}
    for part, wanted in ((head.s, goal.s), (head.o, goal.o)):
        if isinstance(part, Var) and not isinstance(wanted, Var):
            names[part] = wanted
    rename = lambda x: names.setdefault(x, Var(f"_{tag}{x.name}")) if isinstance(x, Var) else x
    body = [A.Triple(rename(t.s), rename(t.p), rename(t.o)) for t in rule.body]
    return body, [(rename(a), rename(b)) for a, b in rule.differ], {"s": rename(head.s), "o": rename(head.o)}


def backward(c: Compiler, goal: A.Triple) -> Solutions:
    """Stored triples of the goal's predicate and those that rules derive, as a set."""
    key = goal.p.value
    recursive = any(isinstance(t.p, IRI) and t.p.value == key for r in c.rules[key] for t in r.body)
    outer, c.expanding = c.expanding, c.expanding | {key}
    try:
        parts = [c.compile(A.BGP([goal]))]
        for n, rule in enumerate(c.rules[key]):
            for head in rule.head:
                if head.p != goal.p:
                    continue
                body, differ, ends = _substituted(rule, head, goal, f"r{len(outer)}{n}")
                if recursive:
                    continue
                if any(not isinstance(w, Var) and not isinstance(e, Var) and w != e for w, e in ((goal.s, ends["s"]), (goal.o, ends["o"]))):
                    continue
                pattern = A.BGP(body)
                for a, b in differ:
                    pattern = A.Filter(A.Call("!", (A.Call("SAMETERM", (a, b)),)), pattern)
                parts.append(_heads(c, c.compile(pattern), goal, ends))
        if recursive:
            return _fixpoint(c, goal)
    finally:
        c.expanding = outer
    names = [x.name for x in (goal.s, goal.o) if isinstance(x, Var)]
    out = union([p.select({v: p.typed(v) for v in dict.fromkeys(names)}) if names else p for p in parts])
    return Solutions(out.df.distinct(), out.kinds)


def _heads(c: Compiler, found: Solutions, goal: A.Triple, ends: dict[str, A.Term]) -> Solutions:
    bound = {}
    for term, end in ((goal.s, ends["s"]), (goal.o, ends["o"])):
        if isinstance(term, Var):
            value = found.typed(end.name) if isinstance(end, Var) else (F.lit(end.value), Kind("node")) if isinstance(end, IRI) else (box_constant(end), Kind("box"))
            if term.name in bound:
                found = found.where(lexical(*bound[term.name]) == lexical(*value))
            bound[term.name] = value
    return found.select(bound) if bound else Solutions(found.df.select().limit(1), {})


def _fixpoint(c: Compiler, goal: A.Triple) -> Solutions:
    """A recursive backward predicate, by running its rules forward over the triples that they read."""
    from ..plans.compiler import Compiler

    rules = [Rule(r.name, r.body, r.head, True, r.differ) for r in c.rules[goal.p.value]]
    wanted = {t.p.value for r in rules for t in (*r.body, *r.head) if isinstance(t.p, IRI)}
    stored = triples_of(Compiler(c.spark, c.source), sorted(wanted))
    derived = forward(stored, rules)
    source = TripleSource(c.spark, stored.unionByName(derived).withColumn("g", F.lit(None).cast("string")))
    return Compiler(c.spark, source, trace=c.trace).compile(A.BGP([goal]))


def triples_of(c: Compiler, predicates: list[str]) -> DataFrame:
    """Triples (s, p, o) of some predicates from any source, boxed."""
    out = None
    for p in predicates:
        found = c.compile(A.BGP([A.Triple(Var("s"), IRI(p), Var("o"))]))
        part = found.df.select(lexical(*found.typed("s")).alias("s"), F.lit(p).alias("p"), box(*found.typed("o")).alias("o"))
        out = part if out is None else out.unionByName(part)
    return out


def derive(rule: Rule, newest: DataFrame, known: DataFrame) -> DataFrame | None:
    """Triples that a rule derives from ``known`` with at least one pattern over ``newest``, with repeats."""
    from ..plans.compiler import Compiler, union as all_of

    spark = known.sparkSession
    none = F.lit(None).cast("string")
    sources = [TripleSource(spark, x.withColumn("g", none)) for x in (newest, known)]
    for s in sources:
        s.catalogue = None  # no statistics of frames that live for one round
    parts = []
    for i in range(len(rule.body)):
        parts_of = [Compiler(spark, sources[0 if j == i else 1]).compile(A.BGP([t])) for j, t in enumerate(rule.body)]
        found = Compiler(spark, sources[1])._connected(parts_of)
        for a, b in rule.differ:
            x, y = (found.typed(e.name) if isinstance(e, Var) else (box_constant(e), Kind("box")) for e in (a, b))
            found = found.where(box(*x) != box(*y))
        parts.append(found)
    found = all_of(parts)
    out = None
    for t in rule.head:
        cell = lambda e: found.typed(e.name) if isinstance(e, Var) else ((F.lit(e.value), Kind("node")) if isinstance(e, IRI) else (box_constant(e), Kind("box")))
        made = found.df.select(lexical(*cell(t.s)).alias("s"), lexical(*cell(t.p)).alias("p"), box(*cell(t.o)).alias("o"))
        out = made if out is None else out.unionByName(made)
    return out


def forward(known: DataFrame, rules: list[Rule], newest: DataFrame | None = None) -> DataFrame:
    """What rules derive from triples (s, p, o) and is not among them; with ``newest``, from those on."""
    rules = [r for r in rules if r.forward]
    if newest is None:
        newest = known = snapshot(known.select("s", "p", "o").distinct(), "p", "s")
    else:
        newest = newest.select("s", "p", "o").distinct()
    derived = known.limit(0)
    while rules:
        made = None
        for r in rules:
            part = derive(r, newest, known)
            made = part if made is None else made.unionByName(part)
        newest = snapshot(made.where("s is not null and o is not null").distinct().join(known, ["s", "p", "o"], "left_anti").select("s", "p", "o"), "p", "s")
        if newest.isEmpty():
            break
        known, derived = known.unionByName(newest), derived.unionByName(newest)
    return derived


__all__ = ["Rule", "backward", "by_predicate", "column_name", "forward", "parse_rules"]
