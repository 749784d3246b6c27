"""GeoSPARQL functions over WKT, as columns; coordinates are longitude and latitude in degrees.

A geometry is a struct of its kind and its rings or paths (arrays of points). Regions follow the
even-odd rule over all rings, which covers holes and multi-polygons; borders belong to a geometry.
All of it runs in the JVM: parsing splits strings, predicates are higher-order array functions, and a
test of bounding boxes comes first, since it is cheap and settles most pairs. Where one side is a constant
point or polygon, rows that are points are tested by plain arithmetic with its numbers.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOF = "http://www.opengis.net/def/function/geosparql/"
#: Mean radius of the earth in metres.
RADIUS = 6_371_000.0
#: Metres, or for angles radians, in a unit of measure.
UNITS = {"metre": 1.0, "meter": 1.0, "kilometre": 1000.0, "kilometer": 1000.0, "mile": 1609.344, "foot": 0.3048, "yard": 0.9144, "nauticalmile": 1852.0}
_POINT = "struct<x:double,y:double>"
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def geometry(wkt: Column) -> Column:
    """struct<kind, rings>; null if the text is no geometry that is known here."""
    bare = F.trim(F.regexp_replace(wkt, r"^\s*<[^>]*>\s*", ""))
    kind = F.upper(F.regexp_extract(bare, r"^([A-Za-z]+)", 1))
    body = F.regexp_extract(bare, r"(?s)^[A-Za-z]+\s*(?:[zZmM]{1,2}\s*)?\((.*)\)\s*$", 1)
    # Inner parentheses end rings; those around the single points of a multi-point only separate them.
    flat = F.when(kind == "MULTIPOINT", F.regexp_replace(body, r"[()]", " ")).otherwise(body)
    parts = F.when(kind.isin("POINT", "LINESTRING", "MULTIPOINT"), F.array(flat)).otherwise(F.split(F.regexp_replace(flat, r"^[\s(]+|[\s)]+$", ""), r"\)[\s,()]*\("))

    def point(p: Column) -> Column:
        xy = F.regexp_extract_all(p, F.lit(f"({_NUMBER})"), F.lit(1))
        return F.when(F.size(xy) >= 2, F.struct(xy[0].try_cast("double").alias("x"), xy[1].try_cast("double").alias("y")).cast(_POINT))

    rings = F.transform(parts, lambda ring: F.filter(F.transform(F.split(ring, ","), point), lambda p: p.isNotNull()))
    rings = F.filter(rings, lambda r: F.size(r) > 0)
    known = kind.isin("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON") & (F.size(rings) > 0)
    return F.when(known, F.struct(kind.alias("kind"), rings.alias("rings")))


def points(g: Column) -> Column:
    return F.flatten(g["rings"])


def bounds(g: Column) -> Column:
    """struct<minx, maxx, miny, maxy>."""
    xs, ys = F.transform(points(g), lambda p: p["x"]), F.transform(points(g), lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_max(xs).alias("maxx"), F.array_min(ys).alias("miny"), F.array_max(ys).alias("maxy"))


def centre(g: Column) -> Column:
    """The point itself, or the centre of the bounding box."""
    return let(bounds(g), lambda b: F.struct(((b["minx"] + b["maxx"]) / 2).alias("x"), ((b["miny"] + b["maxy"]) / 2).alias("y")))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points on the sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS * let(a, lambda x: F.asin(F.sqrt(F.when(x > 1, F.lit(1.0)).otherwise(x))))


def distance(a: Column, b: Column) -> Column:
    """Metres between the centres of two geometries."""
    return let(centre(geometry(a)), lambda p: let(centre(geometry(b)), lambda q: haversine(p["y"], p["x"], q["y"], q["x"])))


def in_unit(metres: Column, unit: str) -> Column:
    name = unit.rstrip("/>").rsplit("/", 1)[-1].lower()
    if name == "radian":
        return metres / RADIUS
    if name == "degree":
        return F.degrees(metres / RADIUS)
    if name not in UNITS:
        return F.lit(None).cast("double")
    return metres / UNITS[name]


def _edges(g: Column) -> Column:
    """struct<p, q> of consecutive points in each ring."""
    pairs = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(F.get(r, i - 1).alias("p"), F.get(r, i).alias("q")))
    return F.flatten(F.transform(F.filter(g["rings"], lambda r: F.size(r) > 1), pairs))


def _edges_of(g: Column) -> Column:
    return F.when(g["kind"].isin("POINT", "MULTIPOINT"), F.slice(F.array(F.struct(F.get(points(g), 0).alias("p"), F.get(points(g), 0).alias("q"))), 1, 0)).otherwise(_edges(g))


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def _on(e: Column, p: Column) -> Column:
    a, b = e["p"], e["q"]
    return (
        (F.abs(_cross(a, b, p)) < 1e-12)
        & (p["x"] >= F.least(a["x"], b["x"]) - 1e-12) & (p["x"] <= F.greatest(a["x"], b["x"]) + 1e-12)
        & (p["y"] >= F.least(a["y"], b["y"]) - 1e-12) & (p["y"] <= F.greatest(a["y"], b["y"]) + 1e-12)
    )


def _inside(edges: Column, p: Column) -> Column:
    """Even-odd rule; the border is undecided."""

    def crosses(e: Column) -> Column:
        a, b = e["p"], e["q"]
        spans = (a["y"] > p["y"]) != (b["y"] > p["y"])
        return spans & (p["x"] < (b["x"] - a["x"]) * F.try_divide(p["y"] - a["y"], b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(edges, crosses)) % 2 == 1


def _is_region(g: Column) -> Column:
    return g["kind"].isin("POLYGON", "MULTIPOLYGON")


def _covers(g: Column, edges: Column, p: Column) -> Column:
    """Whether a point is in a geometry or on its border."""
    at_point = F.exists(points(g), lambda q: (F.abs(q["x"] - p["x"]) < 1e-12) & (F.abs(q["y"] - p["y"]) < 1e-12))
    return at_point | F.exists(edges, lambda e: _on(e, p)) | (_is_region(g) & _inside(edges, p))


def _interior(g: Column, edges: Column, p: Column) -> Column:
    return _is_region(g) & ~F.exists(edges, lambda e: _on(e, p)) & _inside(edges, p)


def _proper(e: Column, f: Column) -> Column:
    """Whether two edges cross at inner points of both."""
    d1, d2 = _cross(e["p"], e["q"], f["p"]), _cross(e["p"], e["q"], f["q"])
    d3, d4 = _cross(f["p"], f["q"], e["p"]), _cross(f["p"], f["q"], e["q"])
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def _with(a: Column, b: Column, use) -> Column:
    """``use(g, edges of g, h, edges of h)`` for the geometries of two texts; null if either is none."""

    def both(x: Column) -> Column:
        return let(F.struct(_edges_of(x["g"]).alias("e"), _edges_of(x["h"]).alias("f")), lambda y: use(x["g"], y["e"], x["h"], y["f"]))

    pair = F.struct(geometry(a).alias("g"), geometry(b).alias("h"))
    return let(pair, lambda x: F.when(x["g"].isNotNull() & x["h"].isNotNull(), both(x)))


def _boxes_meet(g: Column, h: Column) -> Column:
    return let(
        F.struct(bounds(g).alias("a"), bounds(h).alias("b")),
        lambda x: (x["a"]["minx"] <= x["b"]["maxx"]) & (x["b"]["minx"] <= x["a"]["maxx"]) & (x["a"]["miny"] <= x["b"]["maxy"]) & (x["b"]["miny"] <= x["a"]["maxy"]),
    )


def _any_proper(e: Column, f: Column) -> Column:
    return F.exists(e, lambda x: F.exists(f, lambda y: _proper(x, y)))


def _meet(g: Column, e: Column, h: Column, f: Column) -> Column:
    return _boxes_meet(g, h) & (F.exists(points(h), lambda p: _covers(g, e, p)) | F.exists(points(g), lambda p: _covers(h, f, p)) | _any_proper(e, f))


def _all_covered(g: Column, e: Column, h: Column, f: Column) -> Column:
    """Whether g covers h: all its points and the middles of its edges, with no edges that cross."""
    middles = F.transform(f, lambda x: F.struct(((x["p"]["x"] + x["q"]["x"]) / 2).alias("x"), ((x["p"]["y"] + x["q"]["y"]) / 2).alias("y")))
    return _boxes_meet(g, h) & F.forall(points(h), lambda p: _covers(g, e, p)) & F.forall(middles, lambda p: _covers(g, e, p)) & ~_any_proper(e, f)


def _interiors_meet(g: Column, e: Column, h: Column, f: Column) -> Column:
    middle = lambda es: F.transform(es, lambda x: F.struct(((x["p"]["x"] + x["q"]["x"]) / 2).alias("x"), ((x["p"]["y"] + x["q"]["y"]) / 2).alias("y")))
    return (
        _any_proper(e, f)
        | F.exists(F.concat(points(h), middle(f), F.array(centre(h))), lambda p: _interior(g, e, p) & _covers(h, f, p))
        | F.exists(F.concat(points(g), middle(e), F.array(centre(g))), lambda p: _interior(h, f, p) & _covers(g, e, p))
    )


def _dimension(g: Column) -> Column:
    return F.when(_is_region(g), 2).when(g["kind"].isin("LINESTRING", "MULTILINESTRING"), 1).otherwise(0)


PREDICATES = {
    "sfIntersects": _meet,
    "sfDisjoint": lambda g, e, h, f: ~_meet(g, e, h, f),
    "sfContains": _all_covered,
    "sfWithin": lambda g, e, h, f: _all_covered(h, f, g, e),
    "sfEquals": lambda g, e, h, f: _all_covered(g, e, h, f) & _all_covered(h, f, g, e),
    "sfTouches": lambda g, e, h, f: _meet(g, e, h, f) & ~_interiors_meet(g, e, h, f) & ((_dimension(g) + _dimension(h)) > 0),
    "sfOverlaps": lambda g, e, h, f: (_dimension(g) == _dimension(h)) & _meet(g, e, h, f) & _interiors_meet(g, e, h, f) & ~_all_covered(g, e, h, f) & ~_all_covered(h, f, g, e),
    "sfCrosses": lambda g, e, h, f: (_dimension(g) + _dimension(h) < 4) & _meet(g, e, h, f) & (_any_proper(e, f) | _interiors_meet(g, e, h, f)) & ~_all_covered(g, e, h, f) & ~_all_covered(h, f, g, e),
}


def predicate(name: str, a: Column, b: Column) -> Column:
    return _with(a, b, PREDICATES[name])


#: Corners of a constant polygon up to which points are tested against its numbers.
MOST_CORNERS = 200
_CRS = r"\s*(?:<[^>]*>\s*)?"
_ONE_POINT = rf"(?i)^{_CRS}POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)\s*$"


def _corners(text: str) -> list[tuple[float, float]] | None:
    """The points of a constant point or of a polygon with one ring."""
    found = re.fullmatch(rf"(?is){_CRS}(?:POINT\s*\(([^()]*)\)|POLYGON\s*\(\s*\(([^()]*)\)\s*\))\s*", text)
    if not found:
        return None
    pairs = [p.split() for p in (found[1] or found[2] or "").split(",")]
    if not all(len(p) == 2 and all(re.fullmatch(_NUMBER, n) for n in p) for p in pairs):
        return None
    out = [(float(x), float(y)) for x, y in pairs]
    return out if (found[1] and len(out) == 1) or (found[2] and 4 <= len(out) <= MOST_CORNERS and out[0] == out[-1]) else None


def _coordinate(wkt: Column, n: int) -> Column:
    return F.regexp_extract(wkt, _ONE_POINT, n).try_cast("double")


def _holds(corners: list[tuple[float, float]], x: Column, y: Column) -> Column:
    """Whether a polygon with these corners holds a point, on its border too."""
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    near = 1e-12
    box = (x >= min(xs) - near) & (x <= max(xs) + near) & (y >= min(ys) - near) & (y <= max(ys) + near)
    border, crossed = F.lit(False), []
    for (ax, ay), (bx, by) in zip(corners, corners[1:], strict=False):
        on = F.abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) < near
        on = on & (x >= min(ax, bx) - near) & (x <= max(ax, bx) + near) & (y >= min(ay, by) - near) & (y <= max(ay, by) + near)
        border = border | on
        if ay != by:
            crossed.append((((y < ay) != (y < by)) & (x < (bx - ax) * ((y - ay) / (by - ay)) + ax)).cast("int"))
    return box & (border | (reduce(lambda p, q: p + q, crossed, F.lit(0)) % 2 == 1))


def by_constant(name: str, a: Column, b: Column, known: tuple[str | None, str | None]) -> Column:
    """A predicate or the distance in metres of two texts, of which those in ``known`` are constants."""
    plain = distance(a, b) if name == "distance" else predicate(name, a, b)
    # Which side may be the point: for the distance and for what is symmetrical, either.
    for constant, other, side in ((known[1], a, "sfWithin"), (known[0], b, "sfContains")):
        corners = _corners(constant) if constant else None
        if corners is None or name not in ("distance", side, "sfIntersects", "sfDisjoint") or (len(corners) == 1) != (name == "distance"):
            continue
        x, y = _coordinate(other, 1), _coordinate(other, 2)
        if name == "distance":
            (cx, cy), = corners
            part = F.pow(F.sin(F.radians(cy - y) / 2), 2) + F.cos(F.radians(y)) * F.cos(F.radians(F.lit(cy))) * F.pow(F.sin(F.radians(cx - x) / 2), 2)
            fast = 2 * RADIUS * F.asin(F.sqrt(F.least(F.lit(1.0), part)))
        else:
            fast = _holds(corners, x, y)
            fast = ~fast if name == "sfDisjoint" else fast
        return F.when(x.isNotNull() & y.isNotNull(), fast).otherwise(plain)
    return plain


def envelope(a: Column) -> Column:
    """The bounding box as a WKT polygon."""
    n = lambda c: F.format_string("%s", c.cast("string"))

    def polygon(b: Column) -> Column:
        corner = lambda x, y: F.concat(n(b[x]), F.lit(" "), n(b[y]))
        ring = [corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"), corner("minx", "miny")]
        return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *ring), F.lit("))"))

    return let(geometry(a), lambda g: F.when(g.isNotNull(), let(bounds(g), polygon)))


def buffer(a: Column, metres: Column, sides: int = 32) -> Column:
    """A polygon of ``sides`` corners around the centre, at a distance of ``metres``."""

    def ring(p: Column) -> Column:
        corners = []
        for i in range(sides + 1):
            turn = F.lit(2 * 3.141592653589793 * (i % sides) / sides)
            dx = F.degrees(metres * F.cos(turn) / RADIUS / F.cos(F.radians(p["y"])))
            corners.append(F.concat((p["x"] + dx).cast("string"), F.lit(" "), (p["y"] + F.degrees(metres * F.sin(turn) / RADIUS)).cast("string")))
        return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *corners), F.lit("))"))

    return let(geometry(a), lambda g: F.when(g.isNotNull(), let(centre(g), ring)))


def latitude(a: Column) -> Column:
    return centre(geometry(a))["y"]


def longitude(a: Column) -> Column:
    return centre(geometry(a))["x"]
