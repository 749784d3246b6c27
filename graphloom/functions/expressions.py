"""SPARQL expressions as columns.

An error is null, as is an unbound variable; a filter keeps rows whose condition is true. Spark's
three-valued logic is then SPARQL's. Operands of known types give native operations that reach the
scan; boxed operands are compared by value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sparql import algebra as A
from ..terms import (
    BNODE, BOOLEAN, BOX_KIND, DATE, DATETIME, DECIMAL, DOUBLE, INTEGER, INTEGERS, IRI, LANG_STRING, LITERAL, NODE, NODE_KIND, NUMERIC, SPARK_TYPES, STRING, TEXTS, WKT, XSD, BNode, Kind,
    Literal, Var, box, box_constant, is_numeric, is_text, lexical, number, spark_literal,
)
from . import geo

Typed = tuple[Column, Kind]
#: Functions that users add, by IRI: they take and return typed columns.
EXTENSIONS: dict[str, Callable[..., Typed]] = {}



class Unsupported(ValueError):
    """An expression that has no column form here."""


class Scope:
    """Typed columns of the variables that an expression sees."""

    def __init__(self, columns: Mapping[str, Typed], exists: Callable[[A.Exists], Column] | None = None):
        self.columns, self.exists = columns, exists

    def value(self, e: Any) -> Typed:
        if isinstance(e, Var):
            return self.columns.get(e.name, (F.lit(None).cast("string"), STRING.may_lack()))
        if isinstance(e, IRI):
            return F.lit(e.value), Kind("node")
        if isinstance(e, Literal):
            return spark_literal(e)
        if isinstance(e, BNode):
            return F.lit("_:" + e.label), NODE_KIND
        if isinstance(e, A.Exists):
            if self.exists is None:
                raise Unsupported("EXISTS can't stand here")
            return self.exists(e), BOOLEAN
        if isinstance(e, A.Call):
            return self._call(e)
        raise Unsupported(f"no such expression: {e}")

    def truth(self, e: Any) -> Column:
        """The effective boolean value; null if there is none."""
        col, kind = self.value(e)
        if kind.form == "literal":
            if kind.dt == XSD + "boolean":
                return col
            if kind.dt in NUMERIC:
                return (col != 0) & ~F.isnan(col.cast("double"))
            if kind.dt in TEXTS:
                return F.length(col) > 0
            return F.lit(None).cast("boolean")
        if kind.form == "node":
            return F.lit(None).cast("boolean")
        literal = col["kind"] == LITERAL
        return (
            F.when(literal & (col["dt"] == XSD + "boolean"), col["lex"].isin("true", "1"))
            .when(literal & col["dt"].isin(*TEXTS), F.length(col["lex"]) > 0)
            .when(number(col, kind).isNotNull(), (number(col, kind) != 0) & ~F.isnan(number(col, kind)))
        )

    def text(self, e: Any) -> Column:
        """The lexical form of a string literal; null for other terms."""
        col, kind = self.value(e)
        if kind.form == "box":
            return F.when((col["kind"] == LITERAL) & col["dt"].isin(*TEXTS), col["lex"])
        return col if is_text(kind) else F.lit(None).cast("string")

    def wkt(self, e: Any) -> Column:
        col, kind = self.value(e)
        if kind.form == "box":
            return F.when(col["kind"] == LITERAL, col["lex"])
        return col if is_text(kind) else F.lit(None).cast("string")

    def number(self, e: Any) -> Typed:
        col, kind = self.value(e)
        if kind.form == "literal" and kind.dt in NUMERIC:
            return col, kind
        return number(col, kind), DOUBLE

    def moment(self, e: Any) -> Column:
        col, kind = self.value(e)
        if kind.form == "literal" and kind.dt in (XSD + "dateTime", XSD + "date"):
            return col.cast("timestamp")
        if kind.form == "box":
            return F.when(col["dt"].isin(XSD + "dateTime", XSD + "date"), col["lex"].try_cast("timestamp"))
        return F.lit(None).cast("timestamp")

    # Operators --------------------------------------------------------------------------------------
    def _call(self, e: A.Call) -> Typed:
        name, args = e.name, e.args
        if name in ("&&", "||"):
            a, b = self.truth(args[0]), self.truth(args[1])
            return (a & b if name == "&&" else a | b), BOOLEAN
        if name == "!":
            return ~self.truth(args[0]), BOOLEAN
        if name in ("=", "!="):
            same = equal(self.value(args[0]), self.value(args[1]))
            return (same if name == "=" else ~same), BOOLEAN
        if name in ("<", "<=", ">", ">="):
            return less(name, self.value(args[0]), self.value(args[1])), BOOLEAN
        if name in ("IN", "NOT IN"):
            hits = [equal(self.value(args[0]), self.value(x)) for x in args[1:]]
            found = F.lit(False)
            for h in hits:
                found = found | h
            return (found if name == "IN" else ~found), BOOLEAN
        if name in ("+", "-", "*", "/"):
            return arithmetic(name, self.number(args[0]), self.number(args[1]))
        if name == "NEG":
            return arithmetic("-", (F.lit(0), INTEGER), self.number(args[0]))
        if name.startswith(geo.GEOF):
            return self._geo(name[len(geo.GEOF) :], args)
        if name.startswith(XSD):
            return self._cast(name, args[0])
        if name in EXTENSIONS:
            return EXTENSIONS[name](*map(self.value, args))
        method = getattr(self, "f_" + name.lower(), None)
        if method is None:
            raise Unsupported(f"unknown function {name}")
        return method(*args)

    @staticmethod
    def _texts(args: tuple) -> tuple[str | None, str | None]:
        """The first two arguments where they are constants."""
        return tuple(a.lex if isinstance(a, Literal) else None for a in args[:2])

    def _geo(self, name: str, args: tuple) -> Typed:
        if name == "distance":
            if len(args) < 2:
                return F.lit(None).cast("double"), DOUBLE
            unit = args[2].value if len(args) > 2 and isinstance(args[2], IRI) else "metre"
            return geo.in_unit(geo.by_constant(name, self.wkt(args[0]), self.wkt(args[1]), self._texts(args)), unit), DOUBLE
        if name in geo.PREDICATES:
            if len(args) < 2:
                return F.lit(None).cast("boolean"), BOOLEAN
            return geo.by_constant(name, self.wkt(args[0]), self.wkt(args[1]), self._texts(args)), BOOLEAN
        if name == "envelope":
            return geo.envelope(self.wkt(args[0])), Kind("literal", WKT)
        if name == "buffer":
            unit = args[2].value.rsplit("/", 1)[-1].lower() if len(args) > 2 else "metre"
            if unit not in geo.UNITS:
                raise Unsupported(f"unknown unit {unit}")
            return geo.buffer(self.wkt(args[0]), self.number(args[1])[0].cast("double") * geo.UNITS[unit]), Kind("literal", WKT)
        if name in ("latitude", "longitude"):
            return getattr(geo, name)(self.wkt(args[0])), DOUBLE
        raise Unsupported(f"unknown spatial function {name}")

    def _cast(self, dt: str, arg: Any) -> Typed:
        col, kind = self.value(arg)
        dt = XSD + "integer" if dt in INTEGERS else dt
        if dt == XSD + "string":
            return lexical(col, kind), STRING
        if dt not in SPARK_TYPES:
            raise Unsupported(f"no cast to {dt}")
        if kind.form == "node":
            return F.lit(None).cast(SPARK_TYPES[dt]), Kind("literal", dt)
        if kind.form == "literal" and kind.dt in NUMERIC and dt in NUMERIC:
            return col.try_cast(SPARK_TYPES[dt]), Kind("literal", dt)
        lex = lexical(col, kind)
        if dt == XSD + "integer":  # 7.9 is cut to 7 as a number, but is no integer as a string
            cut = number(col, kind).try_cast("bigint") if kind.form == "box" else F.lit(None).cast("bigint")
            return F.coalesce(F.when(lex.rlike(r"^\s*[+-]?[0-9]+\s*$"), lex.try_cast("bigint")), cut), INTEGER
        if dt == XSD + "boolean":
            by_number = number(col, kind) != 0 if kind.form == "box" or is_numeric(kind) else F.lit(None).cast("boolean")
            return F.when(lex.isin("true", "1"), True).when(lex.isin("false", "0"), False).otherwise(by_number), BOOLEAN
        return lex.try_cast(SPARK_TYPES[dt]), Kind("literal", dt)

    # Terms ------------------------------------------------------------------------------------------
    def f_bound(self, v: Any) -> Typed:
        return self.value(v)[0].isNotNull(), BOOLEAN

    def _kind_is(self, e: Any, test: Callable[[Column, Kind], Column]) -> Typed:
        col, kind = self.value(e)
        return F.when(col.isNotNull(), test(col, kind)), BOOLEAN

    def f_isiri(self, e: Any) -> Typed:
        return self._kind_is(e, lambda c, k: c["kind"] == NODE if k.form == "box" else ~lexical(c, k).startswith("_:") if k.form == "node" else F.lit(False))

    f_isuri = f_isiri

    def f_isblank(self, e: Any) -> Typed:
        return self._kind_is(e, lambda c, k: c["kind"] == BNODE if k.form == "box" else lexical(c, k).startswith("_:") if k.form == "node" else F.lit(False))

    def f_isliteral(self, e: Any) -> Typed:
        return self._kind_is(e, lambda c, k: c["kind"] == LITERAL if k.form == "box" else F.lit(k.form == "literal"))

    def f_isnumeric(self, e: Any) -> Typed:
        return self._kind_is(e, lambda c, k: number(c, k).isNotNull() if k.form == "box" else F.lit(is_numeric(k)))

    def f_str(self, e: Any) -> Typed:
        return lexical(*self.value(e)), STRING

    def f_lang(self, e: Any) -> Typed:
        col, kind = self.value(e)
        if kind.form == "box":
            return F.when(col["kind"] == LITERAL, F.coalesce(col["lang"], F.lit(""))), STRING
        return (F.when(col.isNotNull(), "") if kind.form == "literal" else F.lit(None).cast("string")), STRING

    def f_langmatches(self, lang: Any, wanted: Any) -> Typed:
        a, b = F.lower(self.text(lang)), F.lower(self.text(wanted))
        return F.when(b == "*", F.length(a) > 0).otherwise((a == b) | a.startswith(F.concat(b, F.lit("-")))), BOOLEAN

    def f_datatype(self, e: Any) -> Typed:
        col, kind = self.value(e)
        if kind.form == "box":
            return F.when(col["kind"] == LITERAL, col["dt"]), NODE_KIND
        return (F.when(col.isNotNull(), kind.dt) if kind.form == "literal" else F.lit(None).cast("string")), NODE_KIND

    def f_iri(self, e: Any) -> Typed:
        col, kind = self.value(e)
        return (lexical(col, kind) if kind.form != "literal" or is_text(kind) else F.lit(None).cast("string")), NODE_KIND

    f_uri = f_iri

    def f_bnode(self, *args: Any) -> Typed:
        return F.concat(F.lit("_:"), self.text(args[0]) if args else F.regexp_replace(F.uuid(), "-", "")), NODE_KIND

    def f_strdt(self, e: Any, dt: Any) -> Typed:
        if isinstance(dt, IRI):
            if dt.value in SPARK_TYPES or dt.value in INTEGERS:
                return self._cast(dt.value, A.Call("STR", (e,)))
            return self.text(e), Kind("literal", dt.value)
        lex = self.text(e)
        made = F.struct(F.lit(LITERAL).cast("tinyint").alias("kind"), lex.alias("lex"), lexical(*self.value(dt)).alias("dt"), F.lit(None).cast("string").alias("lang"))
        return F.when(lex.isNotNull(), made), BOX_KIND

    def f_strlang(self, e: Any, lang: Any) -> Typed:
        lex = self.text(e)
        made = F.struct(F.lit(LITERAL).cast("tinyint").alias("kind"), lex.alias("lex"), F.lit(LANG_STRING).alias("dt"), F.lower(self.text(lang)).alias("lang"))
        return F.when(lex.isNotNull(), made), BOX_KIND

    def f_sameterm(self, a: Any, b: Any) -> Typed:
        return box(*self.value(a)) == box(*self.value(b)), BOOLEAN

    def f_uuid(self) -> Typed:
        return F.concat(F.lit("urn:uuid:"), F.uuid()), NODE_KIND

    def f_struuid(self) -> Typed:
        return F.uuid(), STRING

    # Conditionals -----------------------------------------------------------------------------------
    def f_if(self, test: Any, a: Any, b: Any) -> Typed:
        truth = self.truth(test)
        x, y, kind = common(self.value(a), self.value(b))
        return F.when(truth, x).when(~truth, y), kind

    def f_coalesce(self, *args: Any) -> Typed:
        values = [v for a in args if not (isinstance(a, Var) and a.name not in self.columns) for v in [self.value(a)]]
        if not values:
            return F.lit(None).cast("string"), STRING.may_lack()
        out, kind = values[0]
        for v in values[1:]:
            x, y, kind = common((out, kind), v)
            out = F.coalesce(x, y)
        return out, kind

    # Strings ----------------------------------------------------------------------------------------
    def _keep_lang(self, e: Any, col: Column) -> Typed:
        """A string made from a literal, with its language if it may have one."""
        whole, kind = self.value(e)
        if kind.form != "box":
            return col, STRING
        made = F.struct(F.lit(LITERAL).cast("tinyint").alias("kind"), col.alias("lex"), whole["dt"].alias("dt"), whole["lang"].alias("lang"))
        return F.when(col.isNotNull(), made), BOX_KIND

    def f_strlen(self, e: Any) -> Typed:
        return F.length(self.text(e)).cast("bigint"), INTEGER

    def f_ucase(self, e: Any) -> Typed:
        return self._keep_lang(e, F.upper(self.text(e)))

    def f_lcase(self, e: Any) -> Typed:
        return self._keep_lang(e, F.lower(self.text(e)))

    def f_contains(self, a: Any, b: Any) -> Typed:
        return F.contains(self.text(a), self.text(b)), BOOLEAN

    def f_strstarts(self, a: Any, b: Any) -> Typed:
        return F.startswith(self.text(a), self.text(b)), BOOLEAN

    def f_strends(self, a: Any, b: Any) -> Typed:
        return F.endswith(self.text(a), self.text(b)), BOOLEAN

    def f_strbefore(self, a: Any, b: Any) -> Typed:
        s, t = self.text(a), self.text(b)
        return F.when(F.position(t, s) > 0, F.substr(s, F.lit(1), F.position(t, s) - 1)).when(s.isNotNull() & t.isNotNull(), ""), STRING

    def f_strafter(self, a: Any, b: Any) -> Typed:
        s, t = self.text(a), self.text(b)
        return F.when(F.position(t, s) > 0, F.substr(s, F.position(t, s) + F.length(t))).when(s.isNotNull() & t.isNotNull(), ""), STRING

    def f_concat(self, *args: Any) -> Typed:
        return F.concat(F.lit(""), *map(self.text, args)), STRING

    def f_substr(self, e: Any, start: Any, length: Any = None) -> Typed:
        s, first = self.text(e), self.number(start)[0].cast("int")
        if length is None:
            return self._keep_lang(e, F.substr(s, F.greatest(first, F.lit(1))))
        n = self.number(length)[0].cast("int")
        last = first + n  # positions before the first count against the length
        return self._keep_lang(e, F.substr(s, F.greatest(first, F.lit(1)), F.greatest(last - F.greatest(first, F.lit(1)), F.lit(0))))

    def f_encode_for_uri(self, e: Any) -> Typed:
        plain = F.url_encode(self.text(e))
        for a, b in (("\\+", "%20"), ("\\*", "%2A"), ("%7E", "~")):
            plain = F.regexp_replace(plain, a, b)
        return plain, STRING

    def _pattern(self, pattern: Any, flags: Any) -> Column:
        p = self.text(pattern)
        if flags is None:
            return p
        if isinstance(flags, Literal):
            known = "".join(f for f in flags.lex if f in "ismx")
            p = F.concat(F.lit("\\Q"), p, F.lit("\\E")) if "q" in flags.lex else p
            return F.concat(F.lit(f"(?{known})"), p) if known else p
        return F.concat(F.lit("(?"), self.text(flags), F.lit(")"), p)

    def f_regex(self, e: Any, pattern: Any, flags: Any = None) -> Typed:
        return F.regexp_like(self.text(e), self._pattern(pattern, flags)), BOOLEAN

    def f_replace(self, e: Any, pattern: Any, by: Any, flags: Any = None) -> Typed:
        return self._keep_lang(e, F.regexp_replace(self.text(e), self._pattern(pattern, flags), self.text(by)))

    # Numbers ----------------------------------------------------------------------------------------
    def f_abs(self, e: Any) -> Typed:
        col, kind = self.number(e)
        return F.abs(col), kind

    def _whole(self, e: Any, f: Callable[[Column], Column]) -> Typed:
        col, kind = self.number(e)
        return (col, kind) if kind == INTEGER else (f(col).cast(SPARK_TYPES[kind.dt]), kind)

    def f_ceil(self, e: Any) -> Typed:
        return self._whole(e, F.ceil)

    def f_floor(self, e: Any) -> Typed:
        return self._whole(e, F.floor)

    def f_round(self, e: Any) -> Typed:
        return self._whole(e, lambda c: F.floor(c + F.lit(0.5).cast("decimal(2,1)")))  # halves go up

    def f_rand(self) -> Typed:
        return F.rand(), DOUBLE

    # Dates ------------------------------------------------------------------------------------------
    def f_now(self) -> Typed:
        return F.current_timestamp(), DATETIME

    def f_year(self, e: Any) -> Typed:
        return F.year(self.moment(e)).cast("bigint"), INTEGER

    def f_month(self, e: Any) -> Typed:
        return F.month(self.moment(e)).cast("bigint"), INTEGER

    def f_day(self, e: Any) -> Typed:
        return F.dayofmonth(self.moment(e)).cast("bigint"), INTEGER

    def f_hours(self, e: Any) -> Typed:
        return F.hour(self.moment(e)).cast("bigint"), INTEGER

    def f_minutes(self, e: Any) -> Typed:
        return F.minute(self.moment(e)).cast("bigint"), INTEGER

    def f_seconds(self, e: Any) -> Typed:
        return F.extract(F.lit("SECOND"), self.moment(e)).cast("decimal(38,18)"), DECIMAL

    def f_tz(self, e: Any) -> Typed:
        col, kind = self.value(e)
        return F.coalesce(F.nullif(F.regexp_extract(lexical(col, kind), r"(Z|[+-][0-9]{2}:[0-9]{2})$", 1), F.lit("")), F.when(col.isNotNull(), "")), STRING

    def f_timezone(self, e: Any) -> Typed:
        tz = self.f_tz(e)[0]
        hours, minutes = F.regexp_extract(tz, r"([0-9]{2}):", 1).try_cast("int"), F.regexp_extract(tz, r":([0-9]{2})", 1).try_cast("int")
        sign = F.when(tz.startswith("-"), "-").otherwise("")
        span = F.concat(sign, F.lit("PT"), F.when(hours > 0, F.concat(hours.cast("string"), F.lit("H"))).otherwise(""), F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("M"))).otherwise(""))
        return F.when(tz == "Z", "PT0S").when(tz != "", F.when(span.endswith("PT"), "PT0S").otherwise(span)), Kind("literal", XSD + "dayTimeDuration")

    # Digests ----------------------------------------------------------------------------------------
    def f_md5(self, e: Any) -> Typed:
        return F.md5(self.text(e)), STRING

    def f_sha1(self, e: Any) -> Typed:
        return F.sha1(self.text(e)), STRING

    def f_sha256(self, e: Any) -> Typed:
        return F.sha2(self.text(e), 256), STRING

    def f_sha384(self, e: Any) -> Typed:
        return F.sha2(self.text(e), 384), STRING

    def f_sha512(self, e: Any) -> Typed:
        return F.sha2(self.text(e), 512), STRING


def same_node(a: Typed, b: Typed) -> Column:
    """Equality of nodes; templates are compared by key."""
    (x, k), (y, m) = a, b
    if k.prefix is not None and k.prefix == m.prefix:
        return x == y
    if k.prefix is not None and m.prefix is None:
        return F.when(F.startswith(y, F.lit(k.prefix)), x.cast("string") == F.substr(y, F.lit(len(k.prefix) + 1))).when(x.isNotNull() & y.isNotNull(), False)
    if m.prefix is not None and k.prefix is None:
        return same_node(b, a)
    return lexical(x, k) == lexical(y, m)


def equal(a: Typed, b: Typed) -> Column:
    """SPARQL's ``=``; null where the operands can't be compared."""
    (x, k), (y, m) = a, b
    if k.form == m.form == "node":
        return same_node(a, b)
    if k.form == m.form == "literal":
        if is_numeric(k) and is_numeric(m):
            return x == y
        if k.dt == m.dt or (is_text(k) and is_text(m) and k.dt == m.dt):
            return x == y
        if {k.dt, m.dt} == {XSD + "date", XSD + "dateTime"}:
            return x.cast("timestamp") == y.cast("timestamp")
        return F.when(x.isNotNull() & y.isNotNull(), F.lit(None).cast("boolean"))
    if "box" not in (k.form, m.form):  # a node and a literal
        return F.when(x.isNotNull() & y.isNotNull(), False)
    p, q = box(x, k), box(y, m)
    by_number = number(x, k).cast("double") == number(y, m).cast("double")
    moment = F.when(p["dt"].isin(XSD + "dateTime", XSD + "date") & (p["dt"] == q["dt"]), p["lex"].try_cast("timestamp") == q["lex"].try_cast("timestamp"))
    literals = (p["kind"] == LITERAL) & (q["kind"] == LITERAL)
    texts = p["dt"].isin(*TEXTS) & q["dt"].isin(*TEXTS)
    return F.when(F.coalesce(number(x, k).isNotNull() & number(y, m).isNotNull(), F.lit(False)), by_number).when(moment.isNotNull(), moment).when(literals & ~texts & (p["dt"] != q["dt"]), F.lit(None).cast("boolean")).otherwise(p == q)


def less(sign: str, a: Typed, b: Typed) -> Column:
    (x, k), (y, m) = a, b
    compare = {"<": lambda p, q: p < q, "<=": lambda p, q: p <= q, ">": lambda p, q: p > q, ">=": lambda p, q: p >= q}[sign]
    if k.form == m.form == "literal":
        if (is_numeric(k) and is_numeric(m)) or k.dt == m.dt:
            return compare(x, y)
        if {k.dt, m.dt} == {XSD + "date", XSD + "dateTime"}:
            return compare(x.cast("timestamp"), y.cast("timestamp"))
        return F.when(x.isNotNull() & y.isNotNull(), F.lit(None).cast("boolean"))
    if k.form == "node" or m.form == "node":
        return F.when(x.isNotNull() & y.isNotNull(), F.lit(None).cast("boolean"))
    p, q = box(x, k), box(y, m)
    numbers = number(x, k).isNotNull() & number(y, m).isNotNull()
    texts = p["dt"].isin(*TEXTS) & q["dt"].isin(*TEXTS)
    moments = p["dt"].isin(XSD + "dateTime", XSD + "date") & q["dt"].isin(XSD + "dateTime", XSD + "date")
    return (
        F.when(F.coalesce(numbers, F.lit(False)), compare(number(x, k).cast("double"), number(y, m).cast("double")))
        .when(texts, compare(p["lex"], q["lex"]))
        .when(moments, compare(p["lex"].try_cast("timestamp"), q["lex"].try_cast("timestamp")))
        .when((p["dt"] == XSD + "boolean") & (q["dt"] == XSD + "boolean"), compare(p["lex"], q["lex"]))
    )


def arithmetic(sign: str, a: Typed, b: Typed) -> Typed:
    (x, k), (y, m) = a, b
    floating = {k.dt, m.dt} & {XSD + "double", XSD + "float"}
    if sign == "/":
        return F.try_divide(x.cast("double"), y.cast("double")), DOUBLE
    f = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply}[sign]
    if floating:
        return f(x.cast("double"), y.cast("double")), DOUBLE
    if k == m == INTEGER:
        return f(x.cast("bigint"), y.cast("bigint")), INTEGER
    return f(x, y).try_cast("decimal(38,18)"), DECIMAL


def common(a: Typed, b: Typed) -> tuple[Column, Column, Kind]:
    """Two columns as one kind that holds both."""
    (x, k), (y, m) = a, b
    maybe = k.maybe or m.maybe
    if k.form == m.form and k.dt == m.dt and k.prefix == m.prefix:
        return x, y, k.may_lack(maybe)
    if is_numeric(k) and is_numeric(m):
        kind = DECIMAL if {k.dt, m.dt} == {INTEGER.dt, DECIMAL.dt} else DOUBLE
        return x.cast(SPARK_TYPES[kind.dt]), y.cast(SPARK_TYPES[kind.dt]), kind.may_lack(maybe)
    if k.form == m.form == "node":
        return lexical(x, k), lexical(y, m), NODE_KIND.may_lack(maybe)
    return box(x, k), box(y, m), BOX_KIND.may_lack(maybe)


__all__ = ["EXTENSIONS", "DATE", "Scope", "Typed", "Unsupported", "arithmetic", "box_constant", "common", "equal", "less", "same_node"]
