"""Files, geometry, configuration and streams."""

import json

import pytest
from graphloom.__main__ import main
from graphloom.config import Builder, ConfigProblem, open_graph
from graphloom.functions import geo
from graphloom.graph import TripleGraph
from graphloom.sources import readers
from graphloom.streaming import incremental
from graphloom.terms import IRI, XSD
from pyspark.sql import functions as F

TURTLE = """@base <urn:x:> . @prefix : <urn:e:> .
# a comment
:a a :T ; :p 1 , 2.50, 3e1, -4, true, "q\\"\\n\\u00e9", '''long 'text' ''', "x"@en-GB, "1"^^<urn:dt> ; :b [ :c ( 1 "two" ) ] .
<rel> :q _:n . _:n :r <urn:other> .
"""


def triples(df):
    return {(r["s"], r["p"], (r["o"]["kind"], r["o"]["lex"], r["o"]["dt"], r["o"]["lang"])) for r in df.select("s", "p", "o").collect()}


def test_turtle_and_ntriples_round_trip(spark, tmp_path):
    g = TripleGraph.parse(spark, TURTLE)
    found = triples(g.find())
    assert ("urn:e:a", "urn:e:p", (3, 'q"\né', XSD + "string", None)) in found
    assert ("urn:e:a", "urn:e:p", (3, "x", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString", "en-gb")) in found
    assert any(s == "urn:x:rel" for s, _, _ in found) and len(found) == 18
    path = f"file://{tmp_path}/nt"
    g.dump(path)
    assert triples(readers.read_ntriples(spark, path)) == found
    again = TripleGraph.parse(spark, g.turtle())
    assert again.size() == len(found)


def test_ntriples_odd_lines(spark, tmp_path):
    (tmp_path / "a.nt").write_text('# note\n\n<urn:a> <urn:p> "caf\\u00E9 \\\\n \\"x\\"" .\n<urn:a> <urn:p> "v"@EN <urn:g> . # end\n_:b <urn:p> _:c .\n')
    rows = readers.read(spark, f"file://{tmp_path}/a.nt").collect()
    assert {(r["g"], r["o"]["lex"], r["o"]["lang"]) for r in rows} == {(None, 'café \\n "x"', None), ("urn:g", "v", "en"), (None, "_:c", None)}
    (tmp_path / "b.nt").write_text("this is no triple\n")
    with pytest.raises(Exception, match="not a triple"):
        readers.read(spark, f"file://{tmp_path}/b.nt").collect()


def test_rdfxml():
    text = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="urn:e:">
      <e:Person rdf:about="urn:a" e:nick="al"><e:name xml:lang="DE">A</e:name><e:age rdf:datatype="http://www.w3.org/2001/XMLSchema#integer">3</e:age>
      <e:knows rdf:resource="urn:b"/><e:home rdf:parseType="Resource"><e:city>Ulm</e:city></e:home><e:likes><rdf:Description rdf:about="urn:c"/></e:likes></e:Person></rdf:RDF>"""
    found = readers.parse_rdfxml(text)
    assert len(found) == 8 and any(t.o == IRI("urn:c") for t in found)


def test_jsonld():
    text = {"@context": {"e": "urn:e:", "name": "e:name", "knows": {"@id": "e:knows", "@type": "@id"}}, "@id": "urn:a", "@type": "e:Person", "name": ["A", {"@value": "B", "@language": "de"}], "knows": "urn:b", "e:age": 3, "e:box": {"name": "in"}}
    found = readers.parse_jsonld(json.dumps(text))
    assert len(found) == 7 and any(t.o == IRI("urn:b") and t.p == IRI("urn:e:knows") for t in found)


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name,a,b,want",
    [
        ("sfWithin", "POINT(5 5)", "POLYGON((0 0,10 0,10 10,0 10,0 0))", True), ("sfWithin", "POINT(15 15)", "POLYGON((0 0,10 0,10 10,0 10,0 0))", False),
        ("sfContains", "polygon (( 0 0, 10 0, 10 10, 0 10, 0 0 ), (4 4, 6 4, 6 6, 4 6, 4 4))", "POINT(5 5)", False), ("sfContains", "POLYGON((0 0,10 0,10 10,0 10,0 0))", "LINESTRING(1 1, 9 9)", True),
        ("sfIntersects", "LINESTRING(0 0, 10 10)", "LINESTRING(0 10, 10 0)", True), ("sfIntersects", "POINT(0 0)", "POINT(1 1)", False),
        ("sfDisjoint", "POINT(0 0)", "MULTIPOINT((1 1),(2 2))", True), ("sfEquals", "LINESTRING(0 0, 1 1)", "LINESTRING(1 1, 0 0)", True),
        ("sfTouches", "POLYGON((0 0,1 0,1 1,0 1,0 0))", "POLYGON((1 0,2 0,2 1,1 1,1 0))", True), ("sfOverlaps", "POLYGON((0 0,2 0,2 2,0 2,0 0))", "POLYGON((1 1,3 1,3 3,1 3,1 1))", True),
        ("sfCrosses", "LINESTRING(-1 1, 3 1)", "POLYGON((0 0,2 0,2 2,0 2,0 0))", True), ("sfWithin", "nonsense", "POINT(1 1)", None), ("sfIntersects", "MULTIPOINT(1 1, 2 2)", "POINT(2 2)", True),
        ("sfWithin", "POINT(25 5)", "MULTIPOLYGON(((0 0,10 0,10 10,0 10,0 0)),((20 0,30 0,30 10,20 10,20 0)))", True),
    ],
)
def test_spatial_predicates(spark, name, a, b, want):
    assert value(spark, geo.predicate(name, F.lit(a), F.lit(b))) is want


def test_distances(spark):
    there = value(spark, geo.distance(F.lit("POINT(2.35 48.85)"), F.lit(" Point( 13.40   52.52 ) ")))
    assert 870_000 < there < 885_000
    assert abs(value(spark, geo.in_unit(geo.distance(F.lit("POINT(0 0)"), F.lit("POINT(0 1)")), "http://www.opengis.net/def/uom/OGC/1.0/degree")) - 1) < 1e-9
    assert value(spark, geo.latitude(F.lit("POLYGON((0 0, 4 0, 4 2, 0 2, 0 0))"))) == 1.0
    assert value(spark, geo.distance(F.lit("POINT(x)"), F.lit("POINT(0 0)"))) is None
    assert value(spark, geo.envelope(F.lit("LINESTRING(0 0, 2 3)"))) == "POLYGON((0.0 0.0, 2.0 0.0, 2.0 3.0, 0.0 3.0, 0.0 0.0))"


def test_configuration(spark, tmp_path, capsys):
    (tmp_path / "g.ttl").write_text("@prefix : <urn:e:> . :a :p :b . :b :p :c .")
    config = {"type": "triples", "path": f"file://{tmp_path}/g.ttl", "prefixes": {"": "urn:e:"}, "rules": "@prefix : <urn:e:> . [(?x :p ?y) (?y :p ?z) -> (?x :pp ?z)]"}
    (tmp_path / "g.json").write_text(json.dumps(config))
    g = open_graph(spark, str(tmp_path / "g.json"))
    assert g.ask("ASK { :a :pp :c }")
    assert Builder(spark).triples(config["path"]).prefixes(e="urn:e:").build().ask("ASK { e:a e:p e:b }")
    with pytest.raises(ConfigProblem):
        open_graph(spark, {"type": "nope"})
    with pytest.raises(ConfigProblem):
        open_graph(spark, {"host": "x"})
    (tmp_path / "q.rq").write_text("SELECT ?x WHERE { :a :pp ?x }")
    assert main(["--config", str(tmp_path / "g.json"), str(tmp_path / "q.rq")]) == 0
    assert "urn:e:c" in capsys.readouterr().out


def test_rewrites_do_not_change_results(spark):
    rows = spark.createDataFrame([(1, "a", 2), (2, "b", None)], "id int, name string, boss int")
    mapping = {"base": "urn:e:", "tables": {"p": {"class": "P", "key": "id", "columns": ["name"], "edges": {"boss": {"column": "boss", "to": "p", "complete": True}}}}}
    from graphloom.graph import TableGraph

    for q in ("SELECT ?n ?m WHERE { ?x a :P ; :name ?n ; :boss ?y . ?y a :P ; :name ?m }", "SELECT ?n ?b WHERE { ?x :name ?n OPTIONAL { ?x :boss ?b } }"):
        g = TableGraph(spark, mapping, {"p": rows})
        merged = sorted(map(str, g.query(q).collect()))
        g.rewrites = False
        assert sorted(map(str, g.query(q).collect())) == merged


def test_a_stream_keeps_rules_up_to_date(spark, tmp_path):
    (tmp_path / "in").mkdir()
    g = TripleGraph(spark, rules="@prefix : <urn:e:> . [(?x :p ?y) (?y :p ?z) -> (?x :p ?z)]", prefixes={"": "urn:e:"})
    for n, text in enumerate(("<urn:e:a> <urn:e:p> <urn:e:b> .\n", "<urn:e:b> <urn:e:p> <urn:e:c> .\n<urn:e:c> <urn:e:p> <urn:e:d> .\n")):
        (tmp_path / "in" / f"{n}.nt").write_text(text)
        incremental.follow(g, incremental.read_lines(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/state", once=True).awaitTermination()
        assert g.size() == (1, 6)[n]


def test_files_are_read_and_written_by_tasks(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.ttl").write_text(f'@prefix : <urn:e:> . :s{i} :p "a\\"b\\n", 7, _:x ; a :T . _:x :q :s{i} . ')
    g = TripleGraph.load(spark, f"file://{tmp_path}/*.ttl", "ttl", prefixes={"": "urn:e:"})
    assert g.size() == 15  # blank nodes are a file's own
    g.dump(f"file://{tmp_path}/out", "ttl")
    again = TripleGraph.load(spark, f"file://{tmp_path}/out", "ttl", prefixes={"": "urn:e:"})
    q = "SELECT ?s ?o WHERE { ?s :p ?o FILTER(!isBlank(?o)) }"
    assert again.size() == 15 and sorted(map(str, again.query(q).collect())) == sorted(map(str, g.query(q).collect()))
    assert again.query("SELECT ?s WHERE { ?s :p ?x . ?x :q ?s }").count() in (0, 1, 2, 3)


def test_constant_shapes_give_what_others_do(spark):
    """Points against a constant polygon or point, as constants and as columns of the same text."""
    shapes = ["POLYGON((0 0, 10 0, 10 10, 5 4, 0 10, 0 0))", "POLYGON((-1 -1, 3.5 0, 2 9, -1 -1))", "POINT(3 3)", "<urn:crs> polygon ((0 0, 4 0, 4 4, 0 0))", "POLYGON((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))"]
    points = [f"POINT({x} {y})" for x in (-2, 0, 2, 3, 3.5, 5, 10) for y in (-1, 0, 1, 3, 4, 9, 10)] + ["LINESTRING(0 0, 3 3)", "nonsense", "point( 1  2 )", "POLYGON((1 1, 2 1, 2 2, 1 1))"]
    df = spark.createDataFrame([(p,) for p in points], "w string")
    for shape in shapes:
        for name in ("sfWithin", "sfContains", "sfIntersects", "sfDisjoint", "distance", "sfTouches"):
            for flipped in (False, True):
                a, b = (F.lit(shape), F.col("w")) if flipped else (F.col("w"), F.lit(shape))
                fast = geo.by_constant(name, a, b, (shape, None) if flipped else (None, shape))
                slow = geo.by_constant(name, a, b, (None, None))
                rows = df.select("w", fast.alias("x"), slow.alias("y")).collect()
                assert all(r["x"] == r["y"] or (name == "distance" and r["x"] is not None and abs(r["x"] - r["y"]) < 1e-6) for r in rows), (shape, name, flipped)
