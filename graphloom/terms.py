"""RDF terms, and the columns that hold them.

A solution column is *native* where its term type is known while planning (a Spark value of an XSD
datatype, or the key of an IRI template) and *boxed* (a struct of kind, lexical form, datatype and
language) where it is not. Blank nodes are node strings that begin with ``_:``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
TYPE = RDF + "type"
LANG_STRING = RDF + "langString"
WKT = "http://www.opengis.net/ont/geosparql#wktLiteral"

#: Kinds of boxed terms, in the order that SPARQL sorts them.
BNODE, NODE, LITERAL = 1, 2, 3
BOX = "struct<kind:tinyint,lex:string,dt:string,lang:string>"

#: Spark types of native literals by datatype.
SPARK_TYPES = {
    XSD + "integer": "bigint", XSD + "decimal": "decimal(38,18)", XSD + "double": "double", XSD + "float": "float",
    XSD + "boolean": "boolean", XSD + "string": "string", XSD + "dateTime": "timestamp", XSD + "date": "date",
}
#: Datatypes derived from xsd:integer, which are read as it.
INTEGERS = frozenset(XSD + x for x in "int long short byte nonNegativeInteger positiveInteger negativeInteger nonPositiveInteger unsignedInt unsignedLong unsignedShort unsignedByte".split())
NUMERIC = (XSD + "integer", XSD + "decimal", XSD + "float", XSD + "double")
TEXTS = (XSD + "string", LANG_STRING)


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class IRI:
    value: str


@dataclass(frozen=True)
class BNode:
    label: str


@dataclass(frozen=True)
class Literal:
    lex: str
    dt: str = XSD + "string"
    lang: str | None = None


@dataclass(frozen=True)
class Kind:
    """What a solution column holds.

    form: ``node`` (an IRI or blank node: a string, or with ``prefix`` the key that follows it),
    ``literal`` (a Spark value of datatype ``dt``) or ``box``. maybe: rows may be unbound (null).
    """

    form: str
    dt: str | None = None
    prefix: str | None = None
    maybe: bool = False

    def may_lack(self, maybe: bool = True) -> Kind:
        return replace(self, maybe=maybe or self.maybe)


NODE_KIND, BOX_KIND = Kind("node"), Kind("box")
INTEGER, DECIMAL, DOUBLE, BOOLEAN, STRING, DATETIME, DATE = (
    Kind("literal", XSD + x) for x in ("integer", "decimal", "double", "boolean", "string", "dateTime", "date")
)


def literal_kind(dt: str) -> Kind:
    return Kind("literal", XSD + "integer" if dt in INTEGERS else dt)


def kind_of_type(spark_type: str) -> Kind:
    """The literal kind of a Spark column type."""
    if spark_type in ("tinyint", "smallint", "int", "bigint"):
        return INTEGER
    if spark_type.startswith("decimal"):
        return DECIMAL
    for dt, name in SPARK_TYPES.items():
        if name == spark_type:
            return Kind("literal", dt)
    if spark_type == "timestamp_ntz":
        return DATETIME
    return STRING


def is_numeric(kind: Kind) -> bool:
    return kind.form == "literal" and kind.dt in NUMERIC


def is_text(kind: Kind) -> bool:
    return kind.form == "literal" and (kind.dt in TEXTS or kind.dt not in SPARK_TYPES)


def spark_literal(term: Literal) -> tuple[Column, Kind]:
    """A constant as a native column; malformed numbers and dates stay strings of their datatype."""
    kind = literal_kind(term.dt)
    if term.lang:
        return box(F.lit(term.lex), Kind("literal", LANG_STRING), term.lang), BOX_KIND
    name = SPARK_TYPES.get(kind.dt)
    if name is None or name == "string":
        return F.lit(term.lex), kind
    if kind.dt == XSD + "integer":
        return F.lit(int(term.lex)).cast("bigint"), kind
    if kind.dt == XSD + "boolean":
        return F.lit(term.lex in ("true", "1")), kind
    if kind.dt == XSD + "decimal":  # a constant of few digits compares with doubles as a double
        return F.lit(term.lex).cast("decimal(38,18)"), kind
    return F.lit(term.lex).try_cast(name), kind


def lexical(col: Column, kind: Kind) -> Column:
    """The lexical form, which for nodes is the IRI."""
    if kind.form == "box":
        return col["lex"]
    if kind.form == "node":
        return F.concat(F.lit(kind.prefix), col.cast("string")) if kind.prefix is not None else col
    if kind.dt == XSD + "decimal":
        plain = F.regexp_replace(F.regexp_replace(col.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        return plain
    if kind.dt == XSD + "dateTime":
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    return col.cast("string")


def box(col: Column, kind: Kind, lang: str | None = None) -> Column:
    """The boxed form of a column; null stays null."""
    if kind.form == "box":
        return col
    lex = lexical(col, kind)
    if kind.form == "node":
        which = F.when(lex.startswith("_:"), F.lit(BNODE)).otherwise(F.lit(NODE)) if kind.prefix is None else F.lit(NODE)
        made = F.struct(which.cast("tinyint").alias("kind"), lex.alias("lex"), F.lit(None).cast("string").alias("dt"), F.lit(None).cast("string").alias("lang"))
    else:
        made = F.struct(F.lit(LITERAL).cast("tinyint").alias("kind"), lex.alias("lex"), F.lit(kind.dt).alias("dt"), F.lit(lang).cast("string").alias("lang"))
    return F.when(lex.isNotNull(), made).cast(BOX)


def box_constant(term: IRI | Literal | BNode) -> Column:
    if isinstance(term, Literal):
        return box(F.lit(term.lex), Kind("literal", LANG_STRING if term.lang else term.dt), term.lang)
    return box(F.lit(term.value if isinstance(term, IRI) else "_:" + term.label), NODE_KIND)


def number(col: Column, kind: Kind) -> Column:
    """The numeric value; null if there is none."""
    if kind.form == "literal":
        return col if kind.dt in NUMERIC else F.lit(None).cast("double")
    if kind.form == "node":
        return F.lit(None).cast("double")
    numeric = col["dt"].isin(*NUMERIC, *sorted(INTEGERS))
    return F.when((col["kind"] == LITERAL) & numeric, col["lex"].try_cast("double"))


def plain(col: Column, kind: Kind) -> Column:
    """What a result column shows: native values, IRIs and lexical forms as strings."""
    return lexical(col, kind) if kind.form != "literal" else col
