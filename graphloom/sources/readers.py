"""Readers and writers of RDF files.

N-Triples and N-Quads are read line by line. Turtle, RDF/XML and JSON-LD have state that runs through
the file, so a file is parsed whole, each in the task that reads it. Writers stream sorted partitions.
"""

from __future__ import annotations

import itertools
import json
import uuid
import xml.etree.ElementTree as ElementTree
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sparql import algebra as A
from ..sparql.parser import Reader, SyntaxProblem
from ..terms import BOX, IRI, LANG_STRING, RDF, TYPE, XSD, BNode, Literal
from .triples import SCHEMA, row

_documents = itertools.count()
_LINE = r'^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+(<[^>]*>|_:[^\s]+|"(?:[^"\\]|\\.)*"(?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?)\s*(<[^>]*>|_:\S+)?\s*\.\s*(?:#.*)?$'


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples or N-Quads as (g, s, p, o); lines that are neither, but for comments, fail the read."""
    return parse_lines(spark.read.text(path)).distinct()


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines (column ``value``, of a table or a stream) of N-Triples or N-Quads as (g, s, p, o)."""
    lines = lines.where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    part = lambda n: F.regexp_extract("value", _LINE, n)

    def unescaped(c):
        marked = F.regexp_replace(c, r"\\\\", "\u0001")
        for a, b in ((r"\\n", "\n"), (r"\\t", "\t"), (r"\\r", "\r"), (r'\\"', '"'), (r"\\b", "\b"), (r"\\f", "\f"), (r"\\'", "'")):
            marked = F.regexp_replace(marked, a, b)
        coded = F.transform(
            F.split(F.regexp_replace(marked, r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})", "\u0002$1$2\u0002"), "\u0002"),
            lambda x, i: F.when(i % 2 == 1, F.decode(F.unhex(F.lpad(x, 8, "0")), "UTF-32")).otherwise(x),
        )
        marked = F.when(marked.contains("\\u") | marked.contains("\\U"), F.array_join(coded, "")).otherwise(marked)
        return F.replace(marked, F.lit("\u0001"), F.lit("\\"))

    def node(c):
        return F.when(c.startswith("<"), unescaped(F.substr(c, F.lit(2), F.length(c) - 2))).otherwise(c)

    raw = lines.select(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"), part(4).alias("g"), "value")
    raw = raw.withColumn("s", F.when(F.col("s") == "", F.raise_error(F.concat(F.lit("not a triple: "), "value"))).otherwise(F.col("s")))
    body = unescaped(F.regexp_extract("o", r'^"((?:[^"\\]|\\.)*)"', 1))
    lang = F.nullif(F.lower(F.regexp_extract("o", r'"@([A-Za-z0-9-]+)$', 1)), F.lit(""))
    dt = F.nullif(F.regexp_extract("o", r'"\^\^<([^>]*)>$', 1), F.lit(""))
    kind = F.when(F.col("o").startswith("<"), 2).when(F.col("o").startswith("_:"), 1).otherwise(3)
    term = F.struct(
        kind.cast("tinyint").alias("kind"),
        F.when(kind == 3, body).otherwise(node(F.col("o"))).alias("lex"),
        F.when(kind == 3, F.coalesce(dt, F.when(lang.isNotNull(), LANG_STRING), F.lit(XSD + "string"))).alias("dt"),
        F.when(kind == 3, lang).alias("lang"),
    ).cast(BOX)
    return raw.select(F.nullif(node(F.col("g")), F.lit("")).alias("g"), node(F.col("s")).alias("s"), node(F.col("p")).alias("p"), term.alias("o"))


def write_ntriples(df: DataFrame, path: str) -> None:
    """Triples (s, p, o) as N-Triples files in the folder ``path``."""
    df.select(line().alias("value")).write.text(path)


def line():
    escaped = F.col("o.lex")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    node = lambda c: F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    tag = F.when(F.col("o.lang").isNotNull(), F.concat(F.lit("@"), "o.lang")).when(F.col("o.dt") != XSD + "string", F.concat(F.lit("^^<"), "o.dt", F.lit(">"))).otherwise("")
    obj = F.when(F.col("o.kind") == 3, F.concat(F.lit('"'), escaped, F.lit('"'), tag)).otherwise(node(F.col("o.lex")))
    return F.concat_ws(" ", node(F.col("s")), node(F.col("p")), obj, F.lit("."))


def _new_tag() -> str:
    """What the blank nodes of a document begin with."""
    return f"d{next(_documents)}"


class TurtleReader(Reader):
    """Turtle, with blank nodes whose labels are unique to the document."""

    def __init__(self, source: str, base: str = "", tag: str | None = None):
        super().__init__(source, base=base)
        self.tag = tag or _new_tag()

    def blank(self, label: str) -> A.Term:
        return BNode(f"{self.tag}-{label}")

    def new_blank(self) -> A.Term:
        return BNode(f"{self.tag}x{next(self.fresh)}")

    def read(self) -> list[A.Triple]:
        out: list[A.Triple] = []
        while self.kind != "end":
            if (self.kind == "lang" and self.text.lower() in ("@prefix", "@base")) or self.is_("PREFIX", "BASE"):
                word, dotted = self.text.lower().lstrip("@"), self.kind == "lang"
                self.at += 1
                if word == "prefix":
                    name = self.take("pname")
                    self.prefixes[name.rpartition(":")[0]] = self.resolve(self.take("iri")[1:-1]).value
                else:
                    self.base = self.resolve(self.take("iri")[1:-1]).value
                if dotted:
                    self.expect(".")
                continue
            block: list[A.Triple] = []
            subject = self.node(block)
            if not (self.is_(".") and block):
                self.properties(subject, block)
            self.expect(".")
            out += block
        return out


def parse_turtle(text: str, base: str = "", tag: str | None = None) -> list[A.Triple]:
    return TurtleReader(text, base, tag).read()


def parse_rdfxml(text: str, base: str = "", tag: str | None = None) -> list[A.Triple]:
    """RDF/XML: descriptions, typed nodes, property attributes, nested nodes, parse types Resource, Literal and Collection."""
    out: list[A.Triple] = []
    tag, fresh = tag or _new_tag(), itertools.count()
    rdf = lambda name: f"{{{RDF}}}{name}"
    xml = "{http://www.w3.org/XML/1998/namespace}"
    iri = lambda name: IRI(name[1:].replace("}", "", 1))
    resolve = lambda ref: IRI(ref if ":" in ref.split("/")[0] else base + ref)
    skip = {rdf(x) for x in ("about", "ID", "nodeID", "resource", "parseType", "datatype")} | {xml + "lang", xml + "base"}

    def node(e: Any, lang: str | None) -> A.Term:
        lang = e.get(xml + "lang", lang)
        if e.get(rdf("about")) is not None:
            s: A.Term = resolve(e.get(rdf("about")))
        elif e.get(rdf("ID")) is not None:
            s = IRI(f"{base}#{e.get(rdf('ID'))}")
        else:
            s = BNode(f"{tag}-{e.get(rdf('nodeID'))}" if e.get(rdf("nodeID")) else f"{tag}x{next(fresh)}")
        if e.tag != rdf("Description"):
            out.append(A.Triple(s, IRI(TYPE), iri(e.tag)))
        properties(s, e, lang)
        return s

    def properties(s: A.Term, e: Any, lang: str | None) -> None:
        for k, v in e.attrib.items():
            if k not in skip and k.startswith("{"):
                out.append(A.Triple(s, iri(k), IRI(v) if k == rdf("type") else Literal(v, LANG_STRING if lang else XSD + "string", lang)))
        for p in e:
            name = IRI(RDF + f"_{next(fresh)}") if p.tag == rdf("li") else iri(p.tag)
            own = p.get(xml + "lang", lang)
            kind = p.get(rdf("parseType"))
            if p.get(rdf("resource")) is not None:
                o: A.Term = resolve(p.get(rdf("resource")))
            elif p.get(rdf("nodeID")):
                o = BNode(f"{tag}-{p.get(rdf('nodeID'))}")
            elif kind == "Resource":
                o = BNode(f"{tag}x{next(fresh)}")
                properties(o, p, own)
            elif kind == "Literal":
                o = Literal((p.text or "") + "".join(ElementTree.tostring(x, encoding="unicode") for x in p), RDF + "XMLLiteral")
            elif kind == "Collection":
                o = IRI(RDF + "nil")
                for item in reversed([node(x, own) for x in p]):
                    cell = BNode(f"{tag}x{next(fresh)}")
                    out.extend([A.Triple(cell, IRI(RDF + "first"), item), A.Triple(cell, IRI(RDF + "rest"), o)])
                    o = cell
            elif len(p):
                o = node(p[0], own)
            elif p.get(rdf("datatype")):
                o = Literal(p.text or "", p.get(rdf("datatype")))
            else:
                o = Literal(p.text or "", LANG_STRING if own else XSD + "string", own.lower() if own else None)
            out.append(A.Triple(s, name, o))

    root = ElementTree.fromstring(text)
    for e in root if root.tag == rdf("RDF") else [root]:
        node(e, root.get(xml + "lang"))
    return out


def parse_jsonld(text: str, base: str = "", tag: str | None = None) -> list[A.Triple]:
    """JSON-LD with an inline context: terms, prefixes, ``@vocab``, ``@id``, ``@type``, ``@value``, ``@list``, ``@graph`` and nesting."""
    out: list[A.Triple] = []
    tag, fresh = tag or _new_tag(), itertools.count()

    def expand(name: str, context: dict, vocab: bool = True) -> str:
        if name in context and vocab:
            d = context[name]
            name = d["@id"] if isinstance(d, dict) else d
        prefix, colon, local = name.partition(":")
        if colon and prefix in context and not local.startswith("//"):
            d = context[prefix]
            return (d["@id"] if isinstance(d, dict) else d) + local
        return name if colon or not vocab else context.get("@vocab", "") + name

    def ref(name: str, context: dict) -> A.Term:
        return BNode(f"{tag}-{name[2:]}") if name.startswith("_:") else IRI(expand(name, context, False) if ":" in name else context.get("@base", "") + name)

    def value(v: Any, context: dict, how: dict) -> A.Term:
        if isinstance(v, dict):
            if "@value" in v:
                if "@language" in v:
                    return Literal(str(v["@value"]), LANG_STRING, v["@language"].lower())
                return value(v["@value"], context, {"@type": v["@type"]} if "@type" in v else {})
            if "@list" in v:
                tail: A.Term = IRI(RDF + "nil")
                for item in reversed([value(x, context, how) for x in v["@list"]]):
                    cell = BNode(f"{tag}x{next(fresh)}")
                    out.extend([A.Triple(cell, IRI(RDF + "first"), item), A.Triple(cell, IRI(RDF + "rest"), tail)])
                    tail = cell
                return tail
            return node(v, context)
        if how.get("@type") in ("@id", "@vocab"):
            return ref(v, context)
        if isinstance(v, bool):
            return Literal(str(v).lower(), XSD + "boolean")
        if isinstance(v, int | float):
            return Literal(str(v), expand(how["@type"], context) if "@type" in how else XSD + ("integer" if isinstance(v, int) else "double"))
        lang = how.get("@language", context.get("@language"))
        return Literal(v, expand(how["@type"], context)) if "@type" in how else Literal(v, LANG_STRING if lang else XSD + "string", lang)

    def node(d: dict, context: dict) -> A.Term:
        context = merge(context, d.get("@context"))
        s = ref(d["@id"], context) if "@id" in d else BNode(f"{tag}x{next(fresh)}")
        for k, v in d.items():
            if k == "@type":
                out.extend(A.Triple(s, IRI(TYPE), IRI(expand(t, context))) for t in (v if isinstance(v, list) else [v]))
            elif k == "@graph":
                for x in v:
                    node(x, context)
            elif not k.startswith("@"):
                how = context.get(k) if isinstance(context.get(k), dict) else {}
                for x in v if isinstance(v, list) else [v]:
                    if x is not None:
                        out.append(A.Triple(s, IRI(expand(k, context)), value(x, context, how)))
        return s

    def merge(context: dict, more: Any) -> dict:
        for m in more if isinstance(more, list) else [more]:
            context = context | (m if isinstance(m, dict) else {})
        return context

    data = json.loads(text)
    for d in data if isinstance(data, list) else [data]:
        node(d, {})
    return out


PARSERS = {"turtle": parse_turtle, "ttl": parse_turtle, "rdfxml": parse_rdfxml, "rdf": parse_rdfxml, "xml": parse_rdfxml, "jsonld": parse_jsonld, "json": parse_jsonld}


def read(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """A file as (g, s, p, o). The format is the ending's unless it is named."""
    form = (form or path.rsplit(".", 1)[-1]).lower()
    if form in ("nt", "nq", "ntriples", "nquads"):
        return read_ntriples(spark, path)
    if form not in PARSERS:
        raise SyntaxProblem(f"unknown format {form!r}")
    # Blank nodes are the file's own, and this read's.
    tag = F.concat(F.lit(f"f{uuid.uuid4().hex[:8]}"), F.substring(F.md5(F.input_file_name()), 1, 16))
    return spark.read.text(path, wholetext=True).select("value", tag.alias("tag")).mapInArrow(_parsed(form), SCHEMA)


#: Triples in a batch that a parser or writer sends.
_BATCH = 10_000


def _parsed(form: str):
    """Rows (text, tag) as triples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("g", pa.string()), ("s", pa.string()), ("p", pa.string()), ("o", pa.struct([("kind", pa.int8()), ("lex", pa.string()), ("dt", pa.string()), ("lang", pa.string())]))])
        for batch in batches:
            for text, tag in zip(batch.column(0), batch.column(1), strict=True):
                rows = [row(None, t) for t in PARSERS[form](text.as_py(), tag=tag.as_py())]
                for lo in range(0, len(rows), _BATCH):
                    columns = list(zip(*rows[lo : lo + _BATCH], strict=True))
                    terms = [dict(zip(("kind", "lex", "dt", "lang"), o, strict=True)) for o in columns[3]]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(terms, schema.field("o").type)], schema=schema)

    return run


def write_turtle(df: DataFrame, path: str) -> None:
    """Triples (s, p, o) as Turtle files in the folder ``path``: a subject is a paragraph, or one in each of two files and more if it is large."""
    parts = df.select("s", "p", "o").repartitionByRange("s", "p", "o.lex").sortWithinPartitions("s", "p", "o.lex")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            lines = []
            for r in batch.to_pylist():
                end = "" if last is None else " ;" if r["s"] == last else " ."
                if last is not None:
                    lines[-1:] = [lines[-1] + end] if lines else [end]
                lines.append(("    " if r["s"] == last else f"{_node(r['s'])} ") + _pair(r))
                last = r["s"]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([" ."], pa.string())], names=["value"])

    parts.mapInArrow(run, "value string").write.text(path)


def _node(s: str) -> str:
    return s if s.startswith("_:") else f"<{s}>"


def _pair(r: Any) -> str:
    """Predicate and object of a triple."""
    o = r["o"]
    if o["kind"] != 3:
        term = _node(o["lex"])
    else:
        body = json.dumps(o["lex"], ensure_ascii=False)
        term = body + (f"@{o['lang']}" if o["lang"] else "" if o["dt"] == XSD + "string" else f"^^<{o['dt']}>")
    return f"{'a' if r['p'] == TYPE else _node(r['p'])} {term}"


def turtle(rows: list) -> str:
    """Triples (rows of s, p, o) as Turtle, a subject a paragraph."""
    out = []
    for s, own in itertools.groupby(sorted(rows, key=lambda r: (r["s"], r["p"], r["o"]["lex"])), key=lambda r: r["s"]):
        pairs = [_pair(r) for r in own]
        out.append(f"{_node(s)} " + " ;\n    ".join(pairs) + " .")
    return "\n".join(out) + "\n"
