"""Registered queries that go through the graph API: changes, transactions, files, configuration, streams; each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import BASE, MAPPING, graph, stored
from .config import Builder, open_graph
from .graph import TransactionProblem, TripleGraph
from .operators import rules as R
from .sources import readers
from .sparql import algebra as A
from .storage import ensure_folder
from .streaming import incremental
from .terms import IRI, XSD, Literal


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _nation(k: int) -> IRI:
    return IRI(f"{BASE}nation/{k}")


def _rows(g: TripleGraph) -> DataFrame:
    return g.query("SELECT ?s ?p ?o WHERE { ?s ?p ?o }")


def _facts(spark: SparkSession, **facts: bool | int) -> DataFrame:
    """Single values, a row each."""
    return spark.createDataFrame([(k, int(v)) for k, v in facts.items()], "fact string, value bigint")


_NAMES = "SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:n_name' AS p, n_name AS o FROM nation"
_REGIONS = "SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:region' AS p, 'urn:d:region/' || n_regionkey AS o FROM nation"


# Triples and changes --------------------------------------------------------------------------------
def model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["n_name", "region"])
    p = IRI(BASE + "n_name")
    return _facts(spark, size=g.size(), contains=g.contains(_nation(3), p), contains_not=g.contains(_nation(99), p), empty=g.is_empty(), new_empty=TripleGraph(spark).is_empty())


def add_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal, a type and an edge, one at a time, without a transaction."""
    g = stored(spark, sf_dir, ["n_name"])
    x = _nation(99)
    g.add(A.Triple(x, IRI(BASE + "n_name"), Literal("ATLANTIS")))
    g.add(A.Triple(x, IRI(R.TYPE), IRI(BASE + "Nation")))
    g.add(A.Triple(x, IRI(BASE + "region"), IRI(BASE + "region/1")))
    g.add(A.Triple(x, IRI(BASE + "n_name"), Literal("ATLANTIS")))
    return _rows(g)


def delete_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["n_name", "region"])
    g.remove(_nation(3), IRI(BASE + "n_name"))
    g.remove(p=IRI(BASE + "region"), o=IRI(BASE + "region/2"))
    g.remove(_nation(4), IRI(BASE + "n_name"), Literal("not its name"))
    return _rows(g)


def clear_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["n_name"])
    before = g.size()
    g.clear()
    return _facts(spark, before=before, after=g.size())


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """begin, commit, abort, execute, and what is refused."""
    g = stored(spark, sf_dir, ["n_name"])
    p = IRI(BASE + "n_name")
    g.begin()
    g.remove(_nation(1), p)
    unseen = g.contains(_nation(1), p)
    g.commit()
    g.begin()
    g.clear()
    g.abort()
    refused = 0
    for wrong in (g.commit, g.abort):
        try:
            wrong()
        except TransactionProblem:
            refused += 1
    g.execute(lambda x: x.add(A.Triple(_nation(98), p, Literal("MU"))))
    calculated = g.execute(lambda x: x.size())
    facts = _facts(spark, unseen=unseen, refused=refused, calculated=calculated).select(F.lit("fact").alias("s"), F.col("fact").alias("p"), F.col("value").cast("string").alias("o"))
    return _rows(g).union(facts)


def batched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals, types and edges of all nations added in one transaction, and some deleted in another."""
    source = graph(spark, sf_dir)
    made = source.construct("CONSTRUCT { ?n a :Land ; :called ?x ; :partOf ?r } WHERE { ?n :n_name ?x ; :region ?r }").withColumn("g", F.lit(None).cast("string"))
    g = TripleGraph(spark, prefixes={"": BASE})
    with g.transaction():
        g.add_all(made)
    with g.transaction():
        g.remove(p=IRI(BASE + "called"), o=Literal("CANADA"))
        g.remove(_nation(5), IRI(R.TYPE), IRI(BASE + "Land"))
        g.remove(p=IRI(BASE + "partOf"), o=IRI(BASE + "region/0"))
    return _rows(g)


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["n_name", "region"])
    g.update("DELETE WHERE { ?n :region <urn:d:region/3> ; :n_name ?x }")
    return _rows(g)


def graph_management(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOAD, COPY, MOVE, ADD, CLEAR and DROP over named graphs."""
    g = stored(spark, sf_dir, ["n_name", "r_name"])
    path = _folder(spark, "names") + ".nt"
    stored(spark, sf_dir, ["r_name"]).dump(path)
    g.update(
        f"LOAD <{path}> INTO GRAPH <urn:g:1> ; COPY <urn:g:1> TO <urn:g:2> ; MOVE <urn:g:2> TO <urn:g:3> ; ADD DEFAULT TO <urn:g:3> ;"
        " COPY <urn:g:3> TO <urn:g:4> ; DROP GRAPH <urn:g:4> ; CLEAR GRAPH <urn:g:2> ; CLEAR DEFAULT"
    )
    return g.query("SELECT ?g ?s ?o WHERE { GRAPH ?g { ?s ?p ?o } }")


def graph_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One named graph a nation, an OPTIONAL and an aggregate within each."""
    names = R.triples_of(graph(spark, sf_dir).compiler(), [BASE + p for p in ("n_name", "region")])
    g = TripleGraph(spark, names.withColumn("g", F.concat(F.lit("urn:g:"), "s")), prefixes={"": BASE})
    g.remove(p=IRI(BASE + "region"), o=IRI(BASE + "region/1"), graph="urn:g:urn:d:nation/1")
    return g.query("SELECT ?g ?name ?r ?n WHERE { GRAPH ?g { ?x :n_name ?name OPTIONAL { ?x :region ?r } { SELECT (COUNT(?o) AS ?n) ?y WHERE { ?y ?p ?o } GROUP BY ?y } FILTER(?x = ?y) } }")


def graph_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a graph store does: put replaces a graph, post adds to it, get gives it."""
    path = _folder(spark, "put") + ".nt"
    stored(spark, sf_dir, ["r_name"]).dump(path)
    g = stored(spark, sf_dir, ["n_name"])
    g.update(f"CLEAR GRAPH <urn:g:1> ; LOAD <{path}> INTO GRAPH <urn:g:1>")  # put
    g.update("INSERT DATA { GRAPH <urn:g:1> { <urn:d:region/9> :r_name \"ATLANTIS\" } }")  # post
    return g.query("CONSTRUCT { ?s ?p ?o } WHERE { GRAPH <urn:g:1> { ?s ?p ?o } }")  # get


def uri_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subject's triples from a snapshot that is sorted for it."""
    path = _folder(spark, "index") + ".nt"
    stored(spark, sf_dir, ["c_name", "c_acctbal", "nation"]).dump(path)
    found = TripleGraph.load(spark, path).find(IRI(BASE + "customer/7"))
    return found.select("s", "p", F.col("o.lex").alias("o"))


# Files ----------------------------------------------------------------------------------------------
def turtle_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "turtle")
    stored(spark, sf_dir, ["n_name", "region"]).dump(path, "ttl")
    return _rows(TripleGraph.load(spark, path, "ttl", prefixes={"": BASE}))


def _document(spark: SparkSession, text: str, name: str) -> str:
    path = _folder(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def rdfxml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = graph(spark, sf_dir).query("SELECT ?r ?name WHERE { ?r :r_name ?name }").collect()  # five regions
    body = "".join(f'<rdf:Description rdf:about="{r["r"]}"><e:r_name>{r["name"]}</e:r_name><e:in rdf:resource="urn:e:world"/></rdf:Description>' for r in rows)
    path = _document(spark, f'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="{BASE}">{body}</rdf:RDF>', "rdfxml")
    return _rows(TripleGraph.load(spark, path, "rdfxml"))


def jsonld(spark: SparkSession, sf_dir: str) -> DataFrame:
    import json

    rows = graph(spark, sf_dir).query("SELECT ?r ?name WHERE { ?r :r_name ?name }").collect()  # five regions
    text = json.dumps({"@context": {"name": BASE + "r_name"}, "@graph": [{"@id": r["r"], "@type": BASE + "Region", "name": r["name"]} for r in rows]})
    return _rows(TripleGraph.load(spark, _document(spark, text, "jsonld"), "jsonld"))


def language_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["r_name", "r_regionkey"])
    g.update('INSERT { ?r :label ?x } WHERE { ?r :r_name ?n ; :r_regionkey ?k BIND(STRLANG(?n, IF(?k < 2, "en-GB", "de")) AS ?x) }')
    return g.query('SELECT ?k ?l ?m WHERE { ?r :r_regionkey ?k ; :label ?x BIND(LANG(?x) AS ?l) BIND(LANGMATCHES(?l, "EN") AS ?m) FILTER(LANGMATCHES(LANG(?x), "*")) }')


# Rules, native queries, configuration -----------------------------------------------------------------
def rules_included(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = stored(spark, sf_dir, ["r_name"], "@include <OWLMicro>.")
    g.update("PREFIX rdfs: <http://www.w3.org/2000/01/rdf-schema#> INSERT DATA { :Region rdfs:subClassOf :Place . :Place rdfs:subClassOf :Thing } ; INSERT { ?r a :Region } WHERE { ?r :r_name ?n }")
    return g.query("SELECT ?r ?t WHERE { ?r :r_name ?n ; a ?t }")


def native_unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A native query sees the stored triples, not those that rules derive."""
    g = stored(spark, sf_dir, ["n_name", "region"], f"[(?n <{BASE}region> ?r) -> (?n <{BASE}within> ?r)]")
    # A pattern of the derived predicate, beside a native query over stored ones.
    return g.query("SELECT ?name ?r ?k WHERE { (?name ?k) <urn:graphloom:native> 'MATCH (n)-[e]->(r) RETURN n.n_name AS name, count(e) AS k' . ?n :n_name ?name ; :within ?r }")


def native_keys_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph(spark, sf_dir).native("MATCH (n:Nation {n_nationkey: 4})-[e]->(r) RETURN type(e) AS e, labels(r) AS l")


def configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same graph by a builder and by a declarative configuration, with a rule."""
    mapping = MAPPING | {"tables": {n: MAPPING["tables"][n] for n in ("region", "nation")}}
    rule = f"[(?n <{BASE}within> ?r) <- (?n <{BASE}region> ?r)]"
    built = Builder(spark).tables(mapping, sf_dir).rules(rule).build()
    opened = open_graph(spark, {"type": "tables", "path": sf_dir, "mapping": mapping, "rules": rule})
    q = "SELECT ?n ?r WHERE { ?x :within ?y ; :n_name ?n . ?y :r_name ?r }"
    return built.query(q).union(opened.query(q))


def planner_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join without the planner's rewrites has the same rows."""
    mapping = MAPPING | {"tables": {n: MAPPING["tables"][n] for n in ("region", "nation")}}
    plain = open_graph(spark, {"type": "tables", "path": sf_dir, "mapping": mapping, "rewrites": False})
    return plain.query("SELECT ?n ?r WHERE { ?x a :Nation ; :region ?y ; :n_name ?n . ?y a :Region ; :r_name ?r }")


def external_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph whose content is a file that the configuration names."""
    path = _folder(spark, "content")
    stored(spark, sf_dir, ["n_name"]).dump(path)
    return _rows(open_graph(spark, {"type": "triples", "path": path, "format": "nt"}))


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples that arrive as a stream, and what a rule derives of them."""
    folder = _folder(spark, "stream")
    stored(spark, sf_dir, ["nation", "region"]).dump(folder + "/in")
    g = TripleGraph(spark, rules=f"[(?c <{BASE}nation> ?n) (?n <{BASE}region> ?r) -> (?c <{BASE}within> ?r)]", prefixes={"": BASE})
    incremental.follow(g, incremental.read_lines(spark, folder + "/in"), folder + "/state", once=True).awaitTermination()
    return g.query("SELECT ?r (COUNT(?c) AS ?n) WHERE { ?c :within ?r } GROUP BY ?r")


def traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trace says of a query."""
    t = graph(spark, sf_dir).trace("SELECT ?k WHERE { ?c a :Customer ; :c_custkey ?k ; :c_acctbal ?b FILTER(?b > 5000) }")
    return _facts(spark, rows=t["rows"], scans=t["scans"], pushed=t["pushed"])


QUERIES_AND_SQL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "model_tests": (
        model_tests,
        "SELECT 'size' AS fact, 2 * count(*) AS value FROM nation UNION ALL SELECT * FROM (VALUES ('contains', 1::BIGINT), ('contains_not', 0), ('empty', 0), ('new_empty', 1))",
    ),
    "add_triples": (
        add_triples,
        f"{_NAMES} UNION ALL SELECT * FROM (VALUES ('urn:d:nation/99', 'urn:d:n_name', 'ATLANTIS'), ('urn:d:nation/99', '{R.TYPE}', 'urn:d:Nation'), ('urn:d:nation/99', 'urn:d:region', 'urn:d:region/1'))",
    ),
    "delete_triples": (delete_triples, f"{_NAMES} WHERE n_nationkey <> 3 UNION ALL {_REGIONS} WHERE n_regionkey <> 2"),
    "clear_graph": (clear_graph, "SELECT 'before' AS fact, count(*) AS value FROM nation UNION ALL SELECT 'after', 0"),
    "transactions": (
        transactions,
        f"{_NAMES} WHERE n_nationkey <> 1 UNION ALL SELECT 'urn:d:nation/98', 'urn:d:n_name', 'MU' UNION ALL SELECT 'fact', 'unseen', '1' UNION ALL SELECT 'fact', 'refused', '2'"
        " UNION ALL SELECT 'fact', 'calculated', CAST(count(*) AS VARCHAR) FROM nation",
    ),
    "batched_changes": (
        batched_changes,
        f"SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:called' AS p, n_name AS o FROM nation WHERE n_name <> 'CANADA' UNION ALL SELECT 'urn:d:nation/' || n_nationkey, '{R.TYPE}', 'urn:d:Land' FROM nation WHERE n_nationkey <> 5"
        " UNION ALL SELECT 'urn:d:nation/' || n_nationkey, 'urn:d:partOf', 'urn:d:region/' || n_regionkey FROM nation WHERE n_regionkey <> 0",
    ),
    "delete_where": (delete_where, f"{_NAMES} WHERE n_regionkey <> 3 UNION ALL {_REGIONS} WHERE n_regionkey <> 3"),
    "graph_management": (
        graph_management,
        "SELECT g, 'urn:d:region/' || r_regionkey AS s, r_name AS o FROM region, (VALUES ('urn:g:1'), ('urn:g:3')) AS t(g) UNION ALL SELECT 'urn:g:3', 'urn:d:nation/' || n_nationkey, n_name FROM nation",
    ),
    "graph_variable": (
        graph_variable,
        "SELECT 'urn:g:urn:d:nation/' || n_nationkey AS g, n_name AS name, CASE WHEN n_nationkey <> 1 OR n_regionkey <> 1 THEN 'urn:d:region/' || n_regionkey END AS r, CASE WHEN n_nationkey <> 1 OR n_regionkey <> 1 THEN 2 ELSE 1 END::BIGINT AS n FROM nation",
    ),
    "graph_store": (
        graph_store,
        "SELECT 'urn:d:region/' || r_regionkey AS subject, 'urn:d:r_name' AS predicate, r_name AS object FROM region UNION ALL SELECT 'urn:d:region/9', 'urn:d:r_name', 'ATLANTIS'",
    ),
    "uri_index": (
        uri_index,
        "SELECT 'urn:d:customer/7' AS s, unnest(['urn:d:c_name', 'urn:d:c_acctbal', 'urn:d:nation']) AS p, unnest([c_name, CAST(c_acctbal AS VARCHAR), 'urn:d:nation/' || c_nationkey]) AS o FROM customer WHERE c_custkey = 7",
    ),
    "turtle_round_trip": (turtle_round_trip, f"{_NAMES} UNION ALL {_REGIONS}"),
    "rdfxml": (
        rdfxml,
        "SELECT 'urn:d:region/' || r_regionkey AS s, 'urn:d:r_name' AS p, r_name AS o FROM region UNION ALL SELECT 'urn:d:region/' || r_regionkey, 'urn:d:in', 'urn:e:world' FROM region",
    ),
    "jsonld": (
        jsonld,
        f"SELECT 'urn:d:region/' || r_regionkey AS s, 'urn:d:r_name' AS p, r_name AS o FROM region UNION ALL SELECT 'urn:d:region/' || r_regionkey, '{R.TYPE}', 'urn:d:Region' FROM region",
    ),
    "language_tags": (
        language_tags,
        "SELECT CAST(r_regionkey AS BIGINT) AS k, CASE WHEN r_regionkey < 2 THEN 'en-gb' ELSE 'de' END AS l, r_regionkey < 2 AS m FROM region",
    ),
    "rules_included": (rules_included, "SELECT 'urn:d:region/' || r_regionkey AS r, unnest(['urn:d:Region', 'urn:d:Place', 'urn:d:Thing']) AS t FROM region"),
    "native_unwrapped": (native_unwrapped, "SELECT n_name AS name, 'urn:d:region/' || n_regionkey AS r, 1::BIGINT AS k FROM nation"),
    "native_keys_labels": (native_keys_labels, "SELECT 'urn:d:region' AS e, 'urn:d:Region' AS l FROM nation WHERE n_nationkey = 4"),
    "configuration": (
        configuration,
        "SELECT n_name AS n, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey, range(2)",
    ),
    "planner_off": (planner_off, "SELECT n_name AS n, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "external_content": (external_content, _NAMES),
    "stream": (stream, "SELECT 'urn:d:region/' || n_regionkey AS r, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) JOIN nation ON k = n_nationkey GROUP BY n_regionkey"),
    "traced": (traced, "SELECT 'rows' AS fact, count(*) AS value FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT * FROM (VALUES ('scans', 1::BIGINT), ('pushed', 1))"),
}

QUERIES = {n: f for n, (f, _) in QUERIES_AND_SQL.items()}
ORACLE_SQL = {n: s for n, (_, s) in QUERIES_AND_SQL.items()}

__all__ = ["ORACLE_SQL", "QUERIES", "XSD", "readers"]
