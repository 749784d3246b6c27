"""The registered queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import TableGraph, TripleGraph
from .operators import rules as R
from .plans.compiler import Compiler
from .sources.mapping import read_tables
from .terms import WKT, XSD

BASE = "urn:d:"

#: How the tables are a graph. Keys with ``complete`` edges always have their target.
MAPPING = {
    "base": BASE,
    "tables": {
        "region": {"class": "Region", "key": "r_regionkey"},
        "nation": {"class": "Nation", "key": "n_nationkey", "edges": {"region": {"column": "n_regionkey", "to": "region", "complete": True}}},
        "customer": {
            "class": "Customer", "key": "c_custkey", "edges": {"nation": {"column": "c_nationkey", "to": "nation", "complete": True}},
            # A place for each customer, on a grid over the globe.
            "computed": {
                "lon": "cast(c_custkey % 36 * 10 - 175 as double)", "lat": "cast(c_custkey % 17 * 10 - 80 as double)",
                "wkt": {"sql": "concat('POINT(', cast(c_custkey % 36 * 10 - 175 as string), ' ', cast(c_custkey % 17 * 10 - 80 as string), ')')", "datatype": WKT},
            },
        },
        "supplier": {"class": "Supplier", "key": "s_suppkey", "edges": {"nation": {"column": "s_nationkey", "to": "nation", "complete": True}}},
        "part": {"class": "Part", "key": "p_partkey"},
        "orders": {"class": "Order", "key": "o_orderkey", "edges": {"customer": {"column": "o_custkey", "to": "customer", "complete": True}}},
        "lineitem": {
            "class": "LineItem", "key": None,
            "edges": {
                "order": {"column": "l_orderkey", "to": "orders", "complete": True}, "part": {"column": "l_partkey", "to": "part", "complete": True},
                "supplier": {"column": "l_suppkey", "to": "supplier", "complete": True},
            },
        },
        "events": {"class": "Event", "key": "event_id", "edges": {"user": {"column": "user_id", "to": "customer", "complete": True}}},
        "documents": {"class": "Document", "key": "doc_id"},
        "labels": {"class": "Label", "key": None, "columns": ["quality", "toxic"], "edges": {"labels": {"column": "doc_id", "to": "documents", "complete": True}}},
        "pages": {"class": "Page", "key": "page_id"},
        "benchmark": {"class": "Item", "key": "item_id"},
        "conversations": {"class": "Turn", "key": None},
    },
}

_graphs: dict[tuple[str, int, str, str], TableGraph] = {}


def graph(spark: SparkSession, sf_dir: str, rules: str = "") -> TableGraph:
    """The tables of a folder as a graph; schemas are read once a session and folder."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, rules)
    if key not in _graphs:
        if len(_graphs) > 64:
            _graphs.clear()
        _graphs[key] = TableGraph(spark, MAPPING, read_tables(spark, sf_dir, list(MAPPING["tables"])), rules)
    return _graphs[key]


def sparql(text: str, rules: str = "", **casts: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = graph(spark, sf_dir, rules).query(text)
        return out.withColumns({c: F.col(c).cast(t) for c, t in casts.items()}) if casts else out

    return run


def native(text: str, predicates: str = "") -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: graph(spark, sf_dir).native(text)


#: name: (SPARQL, SQL). The default prefix is the base.
SPARQL: dict[str, tuple[str, str]] = {
    # Basic graph patterns
    "bgp_flagship": (
        'SELECT ?c ?name ?bal WHERE { ?c a :Customer ; :c_name ?name ; :c_acctbal ?bal ; :nation ?n . ?n :region ?r . ?r :r_name "ASIA" . FILTER(?bal > 0) }',
        "SELECT 'urn:d:customer/' || c_custkey AS c, c_name AS name, c_acctbal AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND c_acctbal > 0",
    ),
    "bgp_star": (
        "SELECT ?k ?name ?brand ?price WHERE { ?p a :Part ; :p_partkey ?k ; :p_name ?name ; :p_brand ?brand ; :p_retailprice ?price }",
        "SELECT p_partkey AS k, p_name AS name, p_brand AS brand, p_retailprice AS price FROM part",
    ),
    "bgp_chain2": (
        "SELECT ?o ?cust ?nation WHERE { ?x a :Order ; :o_orderkey ?o ; :customer ?c . ?c :c_name ?cust ; :nation ?n . ?n :n_name ?nation }",
        "SELECT o_orderkey AS o, c_name AS cust, n_name AS nation FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    ),
    "bgp_chain3": (
        "SELECT ?qty ?order ?region WHERE { ?l :l_quantity ?qty ; :order ?o . ?o :o_orderkey ?order ; :customer ?c . ?c :nation ?n . ?n :region ?r . ?r :r_name ?region }",
        "SELECT l_quantity AS qty, o_orderkey AS \"order\", r_name AS region FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
    "bgp_cycle": (
        "SELECT ?order ?sup WHERE { ?l :order ?o ; :supplier ?s . ?o :o_orderkey ?order ; :customer ?c . ?c :nation ?n . ?s :nation ?n ; :s_suppkey ?sup }",
        "SELECT o_orderkey AS \"order\", s_suppkey AS sup FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey",
    ),
    "bgp_const_subject": ("SELECT ?name ?n WHERE { <urn:d:customer/7> :c_name ?name ; :nation ?n }", "SELECT c_name AS name, 'urn:d:nation/' || c_nationkey AS n FROM customer WHERE c_custkey = 7"),
    "bgp_const_object": ("SELECT ?c ?name WHERE { ?c :nation <urn:d:nation/3> ; :c_name ?name }", "SELECT 'urn:d:customer/' || c_custkey AS c, c_name AS name FROM customer WHERE c_nationkey = 3"),
    "bgp_const_literal": ('SELECT ?k WHERE { ?c :c_mktsegment "BUILDING" ; :c_custkey ?k ; :c_nationkey 5 }', "SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 5"),
    "bgp_type_join": ("SELECT ?s ?name WHERE { ?s a :Supplier ; :nation ?n . ?n a :Nation ; :n_name ?name }", "SELECT 'urn:d:supplier/' || s_suppkey AS s, n_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    "bgp_cross": ("SELECT ?r ?n WHERE { ?x :r_name ?r . ?y :n_name ?n }", "SELECT r_name AS r, n_name AS n FROM region, nation"),
    "bgp_same_variable": ("SELECT ?k WHERE { ?p :p_size ?k ; :p_partkey ?k }", "SELECT p_partkey AS k FROM part WHERE p_size = p_partkey"),
    "bgp_shared_predicate": ("SELECT ?x ?n WHERE { ?x :nation ?n }", "SELECT 'urn:d:customer/' || c_custkey AS x, 'urn:d:nation/' || c_nationkey AS n FROM customer UNION ALL SELECT 'urn:d:supplier/' || s_suppkey, 'urn:d:nation/' || s_nationkey FROM supplier"),
    # Variable predicates, objects and classes
    "var_object": ("SELECT ?s ?o WHERE { ?s :region ?o }", "SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:region/' || n_regionkey AS o FROM nation"),
    "var_predicate": (
        "SELECT ?p ?o WHERE { <urn:d:nation/4> ?p ?o }",
        "SELECT unnest(['urn:d:n_nationkey', 'urn:d:n_name', 'urn:d:n_regionkey', 'urn:d:region', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type']) AS p, unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), 'urn:d:region/' || n_regionkey, 'urn:d:Nation']) AS o FROM nation WHERE n_nationkey = 4",
    ),
    "var_predicate_literal": ('SELECT ?s ?p WHERE { ?s ?p "ASIA" }', "SELECT 'urn:d:region/' || r_regionkey AS s, 'urn:d:r_name' AS p FROM region WHERE r_name = 'ASIA'"),
    "var_predicate_join": (
        "SELECT ?p ?o ?name WHERE { <urn:d:nation/4> ?p ?o . ?o :r_name ?name }",
        "SELECT 'urn:d:region' AS p, 'urn:d:region/' || n_regionkey AS o, r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 4",
    ),
    "type_variable": ("SELECT ?t (COUNT(?s) AS ?n) WHERE { ?s a ?t . ?s :nation ?x } GROUP BY ?t", "SELECT 'urn:d:Customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'urn:d:Supplier', count(*) FROM supplier"),
    "type_count": (
        "SELECT ?t (COUNT(*) AS ?n) WHERE { ?s a ?t } GROUP BY ?t",
        " UNION ALL ".join(
            f"SELECT 'urn:d:{c}' AS t, count(*) AS n FROM {t}"
            for t, c in (("region", "Region"), ("nation", "Nation"), ("customer", "Customer"), ("supplier", "Supplier"), ("part", "Part"), ("orders", "Order"), ("lineitem", "LineItem"), ("events", "Event"), ("documents", "Document"), ("labels", "Label"), ("pages", "Page"), ("benchmark", "Item"), ("conversations", "Turn"))
        ),
    ),
    # Filters
    "filter_compare": ("SELECT ?k ?b WHERE { ?c :c_custkey ?k ; :c_acctbal ?b FILTER(?b >= 1000.5) }", "SELECT c_custkey AS k, c_acctbal AS b FROM customer WHERE c_acctbal >= 1000.5"),
    "filter_and": ("SELECT ?k WHERE { ?p :p_partkey ?k ; :p_size ?s ; :p_retailprice ?r FILTER(?s > 10 && ?r < 1500) }", "SELECT p_partkey AS k FROM part WHERE p_size > 10 AND p_retailprice < 1500"),
    "filter_or": ('SELECT ?k WHERE { ?c :c_custkey ?k ; :c_mktsegment ?m ; :c_acctbal ?b FILTER(?m = "BUILDING" || ?b < 0) }', "SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0"),
    "filter_not": ('SELECT ?k WHERE { ?c :c_custkey ?k ; :c_mktsegment ?m FILTER(!(?m = "BUILDING")) }', "SELECT c_custkey AS k FROM customer WHERE NOT c_mktsegment = 'BUILDING'"),
    "filter_not_equal": ("SELECT ?a ?b WHERE { ?x :region ?r ; :n_nationkey ?a . ?y :region ?r ; :n_nationkey ?b FILTER(?x != ?y) }", "SELECT CAST(a.n_nationkey AS BIGINT) AS a, CAST(b.n_nationkey AS BIGINT) AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey"),
    "filter_multi": ("SELECT ?k WHERE { ?c :c_custkey ?k ; :lat ?lat ; :lon ?lon FILTER(?lat > 0 && ?lat < 45) FILTER(?lon > -20 && ?lon < 60) }", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 17 * 10 - 80 > 0 AND c_custkey % 17 * 10 - 80 < 45 AND c_custkey % 36 * 10 - 175 > -20 AND c_custkey % 36 * 10 - 175 < 60"),
    "filter_iri": ("SELECT ?k WHERE { ?c :c_custkey ?k ; :nation ?n FILTER(?n = <urn:d:nation/2>) }", "SELECT c_custkey AS k FROM customer WHERE c_nationkey = 2"),
    "filter_in": ("SELECT ?k WHERE { ?n :n_nationkey ?k ; :region ?r FILTER(?r IN (<urn:d:region/0>, <urn:d:region/2>)) }", "SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_regionkey IN (0, 2)"),
    "filter_not_in": ("SELECT ?k WHERE { ?n :n_nationkey ?k ; :n_regionkey ?r FILTER(?r NOT IN (1, 3)) }", "SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_regionkey NOT IN (1, 3)"),
    "filter_date": (
        'PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> SELECT ?k ?d WHERE { ?o :o_orderkey ?k ; :o_orderdate ?d FILTER(?d >= "1995-01-01T00:00:00"^^xsd:dateTime && ?d < "1996-01-01T00:00:00"^^xsd:dateTime) }',
        "SELECT o_orderkey AS k, o_orderdate AS d FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'",
    ),
    "filter_year": ("SELECT ?k WHERE { ?o :o_orderkey ?k ; :o_orderdate ?d FILTER(YEAR(?d) = 1994 && MONTH(?d) <= 6) }", "SELECT o_orderkey AS k FROM orders WHERE year(o_orderdate) = 1994 AND month(o_orderdate) <= 6"),
    "filter_regex": ('SELECT ?k WHERE { ?d :doc_id ?k ; :text ?t FILTER(REGEX(?t, "idiot|moron", "i")) }', "SELECT doc_id AS k FROM documents WHERE regexp_matches(text, 'idiot|moron', 'i')"),
    "filter_contains": ('SELECT ?k WHERE { ?d :doc_id ?k ; :text ?t ; :lang ?l FILTER(CONTAINS(?t, "@") && ?l = "en") }', "SELECT doc_id AS k FROM documents WHERE contains(text, '@') AND lang = 'en'"),
    "filter_strstarts": ('SELECT ?k ?u WHERE { ?p :page_id ?k ; :url ?u FILTER(STRSTARTS(?u, "https://") && !STRENDS(?u, "/")) }', "SELECT page_id AS k, url AS u FROM pages WHERE starts_with(url, 'https://') AND NOT suffix(url, '/')"),
    "filter_bound": ("SELECT ?k WHERE { ?d :doc_id ?k OPTIONAL { ?l :labels ?d ; :toxic ?t } FILTER(!BOUND(?t)) }", "SELECT doc_id AS k FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic IS NOT NULL)"),
    "filter_term_tests": ("SELECT ?p WHERE { <urn:d:customer/3> ?p ?o FILTER(isLiteral(?o) && !isNumeric(?o)) }", "SELECT unnest(['urn:d:c_name', 'urn:d:c_mktsegment', 'urn:d:wkt']) AS p FROM customer WHERE c_custkey = 3"),
    "filter_is_iri": ("SELECT ?p ?o WHERE { <urn:d:customer/3> ?p ?o FILTER(isIRI(?o)) }", "SELECT unnest(['urn:d:nation', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type']) AS p, unnest(['urn:d:nation/' || c_nationkey, 'urn:d:Customer']) AS o FROM customer WHERE c_custkey = 3"),
    "filter_on_union": (
        "SELECT ?x ?b WHERE { { ?x :c_acctbal ?b } UNION { ?x :s_acctbal ?b } FILTER(?b > 9000) }",
        "SELECT 'urn:d:customer/' || c_custkey AS x, c_acctbal AS b FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT 'urn:d:supplier/' || s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 9000",
    ),
    "filter_theta": ("SELECT ?a ?b WHERE { ?x :r_regionkey ?a . ?y :r_regionkey ?b FILTER(?a < ?b) }", "SELECT CAST(a.r_regionkey AS BIGINT) AS a, CAST(b.r_regionkey AS BIGINT) AS b FROM region a, region b WHERE a.r_regionkey < b.r_regionkey"),
    # Bindings and functions
    "bind_arithmetic": ("SELECT ?k ?v WHERE { ?l :l_linenumber ?k ; :l_extendedprice ?p ; :l_discount ?d ; :l_quantity ?q FILTER(?q > 49) BIND(?p * (1 - ?d) AS ?v) }", "SELECT CAST(l_linenumber AS BIGINT) AS k, l_extendedprice * (1 - l_discount) AS v FROM lineitem WHERE l_quantity > 49"),
    "bind_division": ("SELECT ?k ?v WHERE { ?p :p_partkey ?k ; :p_size ?s ; :p_retailprice ?r BIND(?r / (?s - 10) AS ?v) }", "SELECT p_partkey AS k, p_retailprice / nullif(p_size - 10, 0) AS v FROM part"),
    "bind_if": ('SELECT ?k ?v WHERE { ?c :c_custkey ?k ; :c_acctbal ?b BIND(IF(?b < 0, "debt", "credit") AS ?v) }', "SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS v FROM customer"),
    "bind_coalesce": ("SELECT ?k ?v WHERE { ?d :doc_id ?k OPTIONAL { ?l :labels ?d ; :quality ?q } BIND(COALESCE(?q, -1) AS ?v) }", "SELECT d.doc_id AS k, CAST(coalesce(quality, -1) AS BIGINT) AS v FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND quality IS NOT NULL"),
    "bind_strings": (
        'SELECT ?k ?a ?b ?c ?d ?e ?f WHERE { ?n :n_nationkey ?k ; :n_name ?x BIND(LCASE(?x) AS ?a) BIND(STRLEN(?x) AS ?b) BIND(SUBSTR(?x, 2, 3) AS ?c) BIND(CONCAT(?x, "-", STR(?k)) AS ?d) BIND(REPLACE(?x, "[AEIOU]", "_") AS ?e) BIND(STRBEFORE(?x, "A") AS ?f) }',
        "SELECT CAST(n_nationkey AS BIGINT) AS k, lower(n_name) AS a, CAST(length(n_name) AS BIGINT) AS b, substr(n_name, 2, 3) AS c, n_name || '-' || n_nationkey AS d, regexp_replace(n_name, '[AEIOU]', '_', 'g') AS e, CASE WHEN contains(n_name, 'A') THEN split_part(n_name, 'A', 1) ELSE '' END AS f FROM nation",
    ),
    "bind_numbers": ("SELECT ?k ?a ?b ?c ?d WHERE { ?s :s_suppkey ?k ; :s_acctbal ?x BIND(ABS(?x) AS ?a) BIND(CEIL(?x) AS ?b) BIND(FLOOR(?x) AS ?c) BIND(ROUND(?x) AS ?d) }", "SELECT s_suppkey AS k, abs(s_acctbal) AS a, ceil(s_acctbal) AS b, floor(s_acctbal) AS c, floor(s_acctbal + 0.5) AS d FROM supplier"),
    "bind_dates": ("SELECT ?k ?y ?m ?d ?h WHERE { ?e :event_id ?k ; :ts ?t BIND(YEAR(?t) AS ?y) BIND(MONTH(?t) AS ?m) BIND(DAY(?t) AS ?d) BIND(HOURS(?t) AS ?h) }", "SELECT event_id AS k, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h FROM events"),
    "bind_digests": ("SELECT ?k ?a ?b WHERE { ?r :r_regionkey ?k ; :r_name ?x BIND(MD5(?x) AS ?a) BIND(SHA256(?x) AS ?b) }", "SELECT CAST(r_regionkey AS BIGINT) AS k, md5(r_name) AS a, sha256(r_name) AS b FROM region"),
    "bind_casts": ("PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> SELECT ?k ?a ?b WHERE { ?s :s_suppkey ?k ; :s_acctbal ?x BIND(xsd:integer(?x) AS ?a) BIND(xsd:string(?k) AS ?b) }", "SELECT s_suppkey AS k, CAST(trunc(s_acctbal) AS BIGINT) AS a, CAST(s_suppkey AS VARCHAR) AS b FROM supplier"),
    "bind_iri": ("SELECT ?i ?t WHERE { ?r :r_name ?x BIND(STR(?r) AS ?i) BIND(DATATYPE(?x) AS ?t) }", f"SELECT 'urn:d:region/' || r_regionkey AS i, '{XSD}string' AS t FROM region"),
    # Optional
    "optional_basic": ("SELECT ?k ?t WHERE { ?d :doc_id ?k OPTIONAL { ?l :labels ?d ; :toxic ?t } }", "SELECT d.doc_id AS k, CAST(toxic AS BIGINT) AS t FROM documents d LEFT JOIN labels l USING (doc_id)"),
    "optional_filter_inside": ("SELECT ?k ?o WHERE { ?c :c_custkey ?k OPTIONAL { ?x :customer ?c ; :o_orderkey ?o ; :o_totalprice ?p FILTER(?p > 300000) } }", "SELECT c_custkey AS k, o_orderkey AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000"),
    "optional_filter_outer": ("SELECT ?k ?o WHERE { ?c :c_custkey ?k ; :c_acctbal ?b OPTIONAL { ?x :customer ?c ; :o_orderkey ?o ; :o_totalprice ?p FILTER(?p > ?b * 40) } }", "SELECT c_custkey AS k, o_orderkey AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 40"),
    "optional_filter_required": ("SELECT ?k ?t WHERE { ?d :doc_id ?k ; :n_chars ?n FILTER(?n < 500) OPTIONAL { ?l :labels ?d ; :toxic ?t } }", "SELECT d.doc_id AS k, CAST(toxic AS BIGINT) AS t FROM documents d LEFT JOIN labels l USING (doc_id) WHERE n_chars < 500"),
    "optional_nested": (
        "SELECT ?k ?o ?q WHERE { ?c :c_custkey ?k OPTIONAL { ?x :customer ?c ; :o_orderkey ?o ; :o_totalprice ?p FILTER(?p > 250000) OPTIONAL { ?l :order ?x ; :l_quantity ?q FILTER(?q > 48) } } }",
        "SELECT c_custkey AS k, o_orderkey AS o, l_quantity AS q FROM customer LEFT JOIN (SELECT * FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 48 WHERE o_totalprice > 250000) ON o_custkey = c_custkey",
    ),
    "optional_two": (
        "SELECT ?k ?s ?c WHERE { ?n :n_nationkey ?k OPTIONAL { ?x :nation ?n ; :s_suppkey ?s ; :s_acctbal ?b FILTER(?b > 9000) } OPTIONAL { ?y :nation ?n ; :c_custkey ?c ; :c_acctbal ?d FILTER(?d > 9800) } }",
        "SELECT CAST(n_nationkey AS BIGINT) AS k, s_suppkey AS s, c_custkey AS c FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 9000 LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9800",
    ),
    "optional_then_join": (
        "SELECT ?k ?r WHERE { ?c :c_custkey ?k OPTIONAL { ?c :nation ?n ; :c_acctbal ?b FILTER(?b > 5000) } { ?n :region ?x . ?x :r_name ?r FILTER(?r = \"ASIA\") } }",
        "SELECT c_custkey AS k, r_name AS r FROM customer JOIN nation ON (c_acctbal > 5000 AND c_nationkey = n_nationkey) OR c_acctbal <= 5000 JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
    ),
    "optional_var_predicate": (
        "SELECT ?k ?p ?o WHERE { ?r :r_regionkey ?k OPTIONAL { ?r ?p ?o FILTER(isIRI(?o)) } }",
        "SELECT CAST(r_regionkey AS BIGINT) AS k, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, 'urn:d:Region' AS o FROM region",
    ),
    # Unions
    "union_basic": ("SELECT ?n WHERE { { ?x :c_name ?n } UNION { ?x :s_name ?n } }", "SELECT c_name AS n FROM customer UNION ALL SELECT s_name FROM supplier"),
    "union_overlap": ("SELECT ?k WHERE { { ?p :p_partkey ?k ; :p_size ?s FILTER(?s > 20) } UNION { ?p :p_partkey ?k ; :p_size ?s FILTER(?s < 30) } }", "SELECT p_partkey AS k FROM part WHERE p_size > 20 UNION ALL SELECT p_partkey FROM part WHERE p_size < 30"),
    "union_three": ("SELECT ?n WHERE { { ?x :r_name ?n } UNION { ?x :n_name ?n } UNION { ?x :s_name ?n } }", "SELECT r_name AS n FROM region UNION ALL SELECT n_name FROM nation UNION ALL SELECT s_name FROM supplier"),
    "union_distinct": ("SELECT DISTINCT ?n WHERE { { ?x :c_nationkey ?n } UNION { ?x :s_nationkey ?n } }", "SELECT CAST(c_nationkey AS BIGINT) AS n FROM customer UNION SELECT s_nationkey FROM supplier"),
    "union_diff_vars": ("SELECT ?a ?b WHERE { { ?x :r_name ?a } UNION { ?y :n_name ?b } }", "SELECT r_name AS a, NULL::VARCHAR AS b FROM region UNION ALL SELECT NULL, n_name FROM nation"),
    "union_then_join": ("SELECT ?n ?name WHERE { ?x :nation ?y . ?y :n_name ?n { ?x :c_name ?name } UNION { ?x :s_name ?name } }", "SELECT n_name AS n, c_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    "union_var_predicate": ("SELECT ?p ?o WHERE { { <urn:d:region/1> ?p ?o } UNION { <urn:d:region/2> ?p ?o } FILTER(isLiteral(?o)) }", "SELECT unnest(['urn:d:r_regionkey', 'urn:d:r_name']) AS p, unnest([CAST(r_regionkey AS VARCHAR), r_name]) AS o FROM region WHERE r_regionkey IN (1, 2)"),
    # Semi- and anti-joins
    "minus": ("SELECT ?k WHERE { ?d :doc_id ?k MINUS { ?l :labels ?d } }", "SELECT doc_id AS k FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "minus_no_shared": ("SELECT ?k WHERE { ?r :r_regionkey ?k MINUS { ?x :n_name ?y } }", "SELECT CAST(r_regionkey AS BIGINT) AS k FROM region"),
    "not_exists": ("SELECT ?k WHERE { ?c :c_custkey ?k FILTER NOT EXISTS { ?o :customer ?c ; :o_totalprice ?p FILTER(?p > 200000) } }", "SELECT c_custkey AS k FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)"),
    "exists": ("SELECT ?k WHERE { ?c :c_custkey ?k ; :c_acctbal ?b FILTER EXISTS { ?o :customer ?c ; :o_totalprice ?p FILTER(?p > ?b * 50) } }", "SELECT c_custkey AS k FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 50)"),
    "exists_in_expression": ("SELECT ?k WHERE { ?c :c_custkey ?k ; :c_acctbal ?b FILTER(?b < 0 || EXISTS { ?o :customer ?c ; :o_totalprice ?p FILTER(?p > 400000) }) }", "SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0 OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"),
    "values_join": ("SELECT ?k ?n WHERE { VALUES (?k ?w) { (1 \"a\") (5 UNDEF) (9 \"c\") } ?x :n_nationkey ?k ; :n_name ?n }", "SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS n FROM nation WHERE n_nationkey IN (1, 5, 9)"),
    "subquery_agg": ("SELECT ?k ?n WHERE { { SELECT ?c (COUNT(?o) AS ?n) WHERE { ?o :customer ?c } GROUP BY ?c } ?c :c_custkey ?k FILTER(?n > 12) }", "SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12"),
    # Aggregates
    "agg_count": ("SELECT ?n (COUNT(?c) AS ?count) WHERE { ?c a :Customer ; :nation ?x . ?x :n_name ?n } GROUP BY ?n", "SELECT n_name AS n, count(*) AS count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    "agg_sum": ("SELECT ?s (SUM(?q) AS ?total) WHERE { ?l :l_returnflag ?s ; :l_quantity ?q } GROUP BY ?s", "SELECT l_returnflag AS s, sum(l_quantity) AS total FROM lineitem GROUP BY l_returnflag"),
    "agg_avg": ("SELECT ?t (ROUND(AVG(?v) * 1000000) AS ?mean) WHERE { ?e :event_type ?t ; :value ?v } GROUP BY ?t", "SELECT event_type AS t, floor(avg(value) * 1000000 + 0.5) AS mean FROM events GROUP BY event_type"),
    "agg_min_max": ("SELECT ?s (MIN(?d) AS ?first) (MAX(?d) AS ?last) WHERE { ?o :o_orderstatus ?s ; :o_orderdate ?d } GROUP BY ?s", "SELECT o_orderstatus AS s, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY o_orderstatus"),
    "agg_multi": (
        "SELECT (COUNT(?q) AS ?n) (SUM(?q) AS ?sum) (AVG(?q) AS ?avg) (MIN(?q) AS ?min) (MAX(?q) AS ?max) WHERE { ?l :l_quantity ?q }",
        "SELECT count(l_quantity) AS n, sum(l_quantity) AS sum, avg(l_quantity) AS avg, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem",
    ),
    "agg_count_star": ("SELECT (COUNT(*) AS ?n) WHERE { ?o :customer ?c . ?c :c_mktsegment \"MACHINERY\" }", "SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY'"),
    "agg_count_distinct": ("SELECT ?t (COUNT(DISTINCT ?u) AS ?n) WHERE { ?e :event_type ?t ; :user ?u } GROUP BY ?t", "SELECT event_type AS t, count(DISTINCT user_id) AS n FROM events GROUP BY event_type"),
    "agg_sum_distinct": ("SELECT ?b (SUM(DISTINCT ?s) AS ?n) WHERE { ?p :p_brand ?b ; :p_size ?s } GROUP BY ?b", "SELECT p_brand AS b, CAST(sum(DISTINCT p_size) AS BIGINT) AS n FROM part GROUP BY p_brand"),
    "agg_avg_distinct": ("SELECT ?b (AVG(DISTINCT ?s) AS ?n) WHERE { ?p :p_brand ?b ; :p_size ?s } GROUP BY ?b", "SELECT p_brand AS b, avg(DISTINCT p_size) AS n FROM part GROUP BY p_brand"),
    "agg_two_keys": ("SELECT ?f ?s (COUNT(*) AS ?n) (SUM(?q) AS ?t) WHERE { ?l :l_returnflag ?f ; :l_linestatus ?s ; :l_quantity ?q } GROUP BY ?f ?s", "SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n, sum(l_quantity) AS t FROM lineitem GROUP BY l_returnflag, l_linestatus"),
    "agg_filter": ("SELECT ?m (COUNT(?c) AS ?n) WHERE { ?c :c_mktsegment ?m ; :c_acctbal ?b FILTER(?b > 0) } GROUP BY ?m", "SELECT c_mktsegment AS m, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment"),
    "agg_expression": ("SELECT ?f (ROUND(SUM(?p * (1 - ?d))) AS ?v) WHERE { ?l :l_returnflag ?f ; :l_extendedprice ?p ; :l_discount ?d } GROUP BY ?f", "SELECT l_returnflag AS f, floor(sum(l_extendedprice * (1 - l_discount)) + 0.5) AS v FROM lineitem GROUP BY l_returnflag"),
    "agg_group_expression": ("SELECT ?y (COUNT(*) AS ?n) WHERE { ?o :o_orderdate ?d } GROUP BY (YEAR(?d) AS ?y)", "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1"),
    "agg_optional": ("SELECT ?g (COUNT(?t) AS ?n) (COUNT(*) AS ?all) WHERE { ?d :lang ?g OPTIONAL { ?l :labels ?d ; :toxic ?t } } GROUP BY ?g", "SELECT lang AS g, count(toxic) AS n, count(*) AS \"all\" FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang"),
    "agg_union": ("SELECT ?n (COUNT(*) AS ?k) WHERE { { ?x :c_nationkey ?n } UNION { ?x :s_nationkey ?n } } GROUP BY ?n", "SELECT CAST(n AS BIGINT) AS n, count(*) AS k FROM (SELECT c_nationkey AS n FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY n"),
    "having": ("SELECT ?b (COUNT(*) AS ?n) WHERE { ?p :p_brand ?b } GROUP BY ?b HAVING(COUNT(*) > 75 && MIN(?b) != \"Brand#11\")", "SELECT p_brand AS b, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) > 75 AND min(p_brand) <> 'Brand#11'"),
    "agg_empty": ("SELECT (COUNT(?x) AS ?n) (SUM(?b) AS ?s) (AVG(?b) AS ?a) WHERE { ?x :c_acctbal ?b FILTER(?b > 1000000000) }", "SELECT 0::BIGINT AS n, 0.0::DOUBLE AS s, 0.0::DOUBLE AS a"),
    "group_concat": ('SELECT ?r (GROUP_CONCAT(?n; SEPARATOR=", ") AS ?names) WHERE { ?x :n_name ?n ; :region ?y . ?y :r_name ?r } GROUP BY ?r', "SELECT r_name AS r, string_agg(n_name, ', ' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"),
    "sample": ("SELECT ?r (SAMPLE(?k) AS ?s) WHERE { ?n :n_regionkey ?r ; :n_nationkey ?k } GROUP BY ?r", "SELECT CAST(n_regionkey AS BIGINT) AS r, CAST(min(n_nationkey) AS BIGINT) AS s FROM nation GROUP BY n_regionkey"),
    # Modifiers and forms
    "order_limit": ("SELECT ?k ?p WHERE { ?o :o_orderkey ?k ; :o_totalprice ?p } ORDER BY DESC(?p) ?k LIMIT 20", "SELECT o_orderkey AS k, o_totalprice AS p FROM orders ORDER BY p DESC, k LIMIT 20"),
    "order_offset": ("SELECT ?k WHERE { ?p :p_partkey ?k } ORDER BY ?k LIMIT 15 OFFSET 30", "SELECT p_partkey AS k FROM part ORDER BY k LIMIT 15 OFFSET 30"),
    "order_expression": ("SELECT ?k WHERE { ?c :c_custkey ?k ; :c_acctbal ?b } ORDER BY DESC(ABS(?b)) ?k LIMIT 10", "SELECT c_custkey AS k FROM customer ORDER BY abs(c_acctbal) DESC, k LIMIT 10"),
    "distinct": ("SELECT DISTINCT ?b ?s WHERE { ?p :p_brand ?b ; :p_size ?s }", "SELECT DISTINCT p_brand AS b, CAST(p_size AS BIGINT) AS s FROM part"),
    "reduced": ("SELECT REDUCED ?k WHERE { ?r :r_regionkey ?k }", "SELECT CAST(r_regionkey AS BIGINT) AS k FROM region"),
    "select_star": ("SELECT * WHERE { ?r a :Region ; :r_name ?name }", "SELECT 'urn:d:region/' || r_regionkey AS r, r_name AS name FROM region"),
    "ask_true": ('ASK { ?r :r_name "ASIA" }', "SELECT true AS result"),
    "ask_false": ('ASK { ?r :r_name "ATLANTIS" }', "SELECT false AS result"),
    "construct": (
        "CONSTRUCT { ?n :inRegion ?r . ?r :hasNation ?n } WHERE { ?x :region ?y ; :n_name ?n0 . ?y :r_name ?r0 BIND(?x AS ?n) BIND(?y AS ?r) }",
        "SELECT 'urn:d:nation/' || n_nationkey AS subject, 'urn:d:inRegion' AS predicate, 'urn:d:region/' || n_regionkey AS object FROM nation UNION SELECT 'urn:d:region/' || n_regionkey, 'urn:d:hasNation', 'urn:d:nation/' || n_nationkey FROM nation",
    ),
    "describe": (
        "DESCRIBE <urn:d:nation/4>",
        "SELECT 'urn:d:nation/4' AS subject, unnest(['urn:d:n_nationkey', 'urn:d:n_name', 'urn:d:n_regionkey', 'urn:d:region', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type']) AS predicate, unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), 'urn:d:region/' || n_regionkey, 'urn:d:Nation']) AS object FROM nation WHERE n_nationkey = 4",
    ),
    # Property paths
    "path_sequence": ("SELECT ?k ?r WHERE { ?c :c_custkey ?k ; :nation/:region/:r_name ?r }", "SELECT c_custkey AS k, r_name AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"),
    "path_alternative": ("SELECT ?x ?n WHERE { ?x :c_name|:s_name ?n }", "SELECT 'urn:d:customer/' || c_custkey AS x, c_name AS n FROM customer UNION ALL SELECT 'urn:d:supplier/' || s_suppkey, s_name FROM supplier"),
    "path_inverse": ("SELECT ?r ?n WHERE { ?x :r_name ?r ; ^:region/:n_name ?n }", "SELECT r_name AS r, n_name AS n FROM region JOIN nation ON n_regionkey = r_regionkey"),
    "path_negated": ("SELECT ?o WHERE { <urn:d:nation/4> !(:n_name|:region|a) ?o }", "SELECT unnest([CAST(n_nationkey AS VARCHAR), CAST(n_regionkey AS VARCHAR)]) AS o FROM nation WHERE n_nationkey = 4"),
    "path_plus": ("SELECT ?x WHERE { <urn:d:orders/7> (:customer|:nation|:region)+ ?x }", "SELECT unnest(['urn:d:customer/' || c_custkey, 'urn:d:nation/' || n_nationkey, 'urn:d:region/' || n_regionkey]) AS x FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey = 7"),
    "path_plus_all": ("SELECT ?x ?y WHERE { ?x (:nation|:region)+ ?y }", "WITH RECURSIVE e(a, b) AS (SELECT 'urn:d:customer/' || c_custkey, 'urn:d:nation/' || c_nationkey FROM customer UNION SELECT 'urn:d:supplier/' || s_suppkey, 'urn:d:nation/' || s_nationkey FROM supplier UNION SELECT 'urn:d:nation/' || n_nationkey, 'urn:d:region/' || n_regionkey FROM nation), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS x, b AS y FROM r"),
    "path_star": ("SELECT ?x WHERE { ?x (:nation/:region)* <urn:d:region/1> }", "SELECT 'urn:d:customer/' || c_custkey AS x FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 UNION ALL SELECT 'urn:d:supplier/' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1 UNION ALL SELECT 'urn:d:region/1'"),
    "path_optional": ("SELECT ?x WHERE { <urn:d:nation/3> :region? ?x }", "SELECT unnest(['urn:d:nation/3', 'urn:d:region/' || n_regionkey]) AS x FROM nation WHERE n_nationkey = 3"),
    # Geography
    "geo_distance": (
        "PREFIX geof: <http://www.opengis.net/def/function/geosparql/> PREFIX geo: <http://www.opengis.net/ont/geosparql#> SELECT ?k ?m WHERE { ?c :c_custkey ?k ; :wkt ?w BIND(ROUND(geof:distance(?w, \"POINT(13.4 52.5)\"^^geo:wktLiteral)) AS ?m) FILTER(?m < 3000000) }",
        "SELECT * FROM (SELECT c_custkey AS k, floor(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(52.5 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(52.5)) * pow(sin(radians(13.4 - lon) / 2), 2)))) + 0.5) AS m FROM (SELECT c_custkey, CAST(c_custkey % 36 * 10 - 175 AS DOUBLE) AS lon, CAST(c_custkey % 17 * 10 - 80 AS DOUBLE) AS lat FROM customer)) WHERE m < 3000000",
    ),
    "geo_within": (
        "PREFIX geof: <http://www.opengis.net/def/function/geosparql/> PREFIX geo: <http://www.opengis.net/ont/geosparql#> SELECT ?k WHERE { ?c :c_custkey ?k ; :wkt ?w FILTER(geof:sfWithin(?w, \"POLYGON((-30 -12, 42 -12, 42 47, -30 47, -30 -12))\"^^geo:wktLiteral)) }",
        "SELECT c_custkey AS k FROM customer WHERE c_custkey % 36 * 10 - 175 BETWEEN -30 AND 42 AND c_custkey % 17 * 10 - 80 BETWEEN -12 AND 47",
    ),
    "geo_contains_triangle": (
        "PREFIX geof: <http://www.opengis.net/def/function/geosparql/> PREFIX geo: <http://www.opengis.net/ont/geosparql#> SELECT ?k WHERE { ?c :c_custkey ?k ; :wkt ?w FILTER(geof:sfContains(\"POLYGON((0 0, 101 0, 0 101, 0 0))\"^^geo:wktLiteral, ?w)) }",
        "SELECT c_custkey AS k FROM customer WHERE c_custkey % 36 * 10 - 175 >= 0 AND c_custkey % 17 * 10 - 80 >= 0 AND c_custkey % 36 * 10 - 175 + c_custkey % 17 * 10 - 80 <= 101",
    ),
    "geo_intersects": (
        "PREFIX geof: <http://www.opengis.net/def/function/geosparql/> PREFIX geo: <http://www.opengis.net/ont/geosparql#> SELECT ?k WHERE { ?c :c_custkey ?k ; :wkt ?w FILTER(geof:sfIntersects(?w, \"LINESTRING(-175 0, 175 0)\"^^geo:wktLiteral)) }",
        "SELECT c_custkey AS k FROM customer WHERE c_custkey % 17 * 10 - 80 = 0",
    ),
}

_GEO = "PREFIX geof: <http://www.opengis.net/def/function/geosparql/> PREFIX geo: <http://www.opengis.net/ont/geosparql#> PREFIX uom: <http://www.opengis.net/def/uom/OGC/1.0/> "
_LON, _LAT = "(c_custkey % 36 * 10 - 175)", "(c_custkey % 17 * 10 - 80)"
_METRES = f"2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(52.5 - {_LAT}) / 2), 2) + cos(radians({_LAT})) * cos(radians(52.5)) * pow(sin(radians(13.4 - {_LON}) / 2), 2))))"
_SQUARE = "POLYGON((-30 -10, 45 -10, 45 50, -30 50, -30 -10))"


def _spatial(relation: str, shape: str, test: str) -> tuple[str, str]:
    """Customers whose place stands in a relation to a shape."""
    return f'{_GEO} SELECT ?k WHERE {{ ?c :c_custkey ?k ; :wkt ?w FILTER(geof:{relation}(?w, "{shape}"^^geo:wktLiteral)) }}', f"SELECT c_custkey AS k FROM customer WHERE {test}"


def _shapes(relation: str, wanted: tuple[str, ...]) -> tuple[str, str]:
    """Which of given shapes stand in a relation to a square."""
    values = " ".join(f'("{name}" "{wkt}"^^geo:wktLiteral)' for name, wkt in _SHAPES.items())
    rows = ", ".join(f"('{name}')" for name in wanted)
    return f'{_GEO} SELECT ?name WHERE {{ VALUES (?name ?w) {{ {values} }} FILTER(geof:{relation}("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))"^^geo:wktLiteral, ?w)) }}', f"SELECT * FROM (VALUES {rows}) AS t(name)"


_SHAPES = {
    "same": "POLYGON((10 0, 10 10, 0 10, 0 0, 10 0))", "overlapping": "POLYGON((5 5, 15 5, 15 15, 5 15, 5 5))", "beside": "POLYGON((10 0, 20 0, 20 10, 10 10, 10 0))",
    "within": "POLYGON((2 2, 4 2, 4 4, 2 4, 2 2))", "far": "POLYGON((50 50, 60 50, 60 60, 50 60, 50 50))", "line through": "LINESTRING(-5 5, 15 5)", "point": "POINT(3 3)",
}

SPARQL |= {
    # Functions on terms
    "filter_is_blank": ("SELECT (COUNT(?l) AS ?n) WHERE { ?l :labels ?d FILTER(isBlank(?l) && !isBlank(?d)) }", "SELECT count(*) AS n FROM labels WHERE doc_id IS NOT NULL"),
    "filter_same_term": ("SELECT ?a WHERE { ?x :n_nationkey ?a ; :n_regionkey ?b FILTER(sameTerm(?a, ?b)) }", "SELECT CAST(n_nationkey AS BIGINT) AS a FROM nation WHERE n_nationkey = n_regionkey"),
    "bind_bnode": ('SELECT ?k ?b WHERE { ?r :r_regionkey ?k BIND(isBlank(BNODE(CONCAT("r", STR(?k)))) AS ?b) }', "SELECT CAST(r_regionkey AS BIGINT) AS k, true AS b FROM region"),
    "bind_strdt": (
        "PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> SELECT ?k ?v ?t WHERE { ?n :n_nationkey ?k BIND(STRDT(STR(?k), xsd:integer) + 1 AS ?v) BIND(DATATYPE(STRDT(\"x\", <urn:t:x>)) AS ?t) }",
        "SELECT CAST(n_nationkey AS BIGINT) AS k, CAST(n_nationkey + 1 AS BIGINT) AS v, 'urn:t:x' AS t FROM nation",
    ),
    "bind_strlang": ('SELECT ?k ?l ?s WHERE { ?r :r_regionkey ?k ; :r_name ?n BIND(STRLANG(?n, "EN") AS ?x) BIND(LANG(?x) AS ?l) BIND(STR(?x) AS ?s) }', "SELECT CAST(r_regionkey AS BIGINT) AS k, 'en' AS l, r_name AS s FROM region"),
    "bind_strings_more": (
        'SELECT ?k ?a ?b ?c ?d WHERE { ?n :n_nationkey ?k ; :n_name ?x BIND(STRENDS(?x, "A") AS ?a) BIND(STRAFTER(?x, "A") AS ?b) BIND(ENCODE_FOR_URI(CONCAT(?x, "/a b")) AS ?c) BIND(UCASE(LCASE(?x)) AS ?d) }',
        "SELECT CAST(n_nationkey AS BIGINT) AS k, suffix(n_name, 'A') AS a, CASE WHEN contains(n_name, 'A') THEN substr(n_name, strpos(n_name, 'A') + 1) ELSE '' END AS b, url_encode(n_name || '/a b') AS c, n_name AS d FROM nation",
    ),
    "bind_times": (
        "SELECT ?k ?m ?s WHERE { ?e :event_id ?k ; :ts ?t BIND(MINUTES(?t) AS ?m) BIND(FLOOR(SECONDS(?t)) AS ?s) }",
        "SELECT event_id AS k, minute(ts) AS m, CAST(second(ts) AS DECIMAL(38, 18)) AS s FROM events",
    ),
    "bind_timezone": (
        'PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> SELECT ?x ?a ?z WHERE { VALUES ?x { "2020-01-01T10:00:00Z" "2020-01-01T10:00:00+02:00" "2020-01-01T10:00:00-05:30" } BIND(STRDT(?x, <urn:t:moment>) AS ?t) BIND(TZ(?t) AS ?a) BIND(STR(TIMEZONE(?t)) AS ?z) }',
        "SELECT * FROM (VALUES ('2020-01-01T10:00:00Z', 'Z', 'PT0S'), ('2020-01-01T10:00:00+02:00', '+02:00', 'PT2H'), ('2020-01-01T10:00:00-05:30', '-05:30', '-PT5H30M')) AS t(x, a, z)",
    ),
    "bind_digests_more": (
        'SELECT ?k ?a ?b ?c WHERE { ?r :r_regionkey ?k ; :r_name ?x BIND(SHA1(?x) AS ?a) BIND(SHA384("ASIA") AS ?b) BIND(SHA512("ASIA") AS ?c) }',
        f"SELECT CAST(r_regionkey AS BIGINT) AS k, sha1(r_name) AS a, '{hashlib.sha384(b'ASIA').hexdigest()}' AS b, '{hashlib.sha512(b'ASIA').hexdigest()}' AS c FROM region",
    ),
    "bind_uuid": ('SELECT ?k ?a ?b WHERE { ?r :r_regionkey ?k BIND(STRSTARTS(STR(UUID()), "urn:uuid:") AS ?a) BIND(STRLEN(STRUUID()) AS ?b) }', "SELECT CAST(r_regionkey AS BIGINT) AS k, true AS a, 36::BIGINT AS b FROM region"),
    "bind_casts_more": (
        'PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> SELECT ?k ?a ?b ?c ?d WHERE { ?s :s_suppkey ?k ; :s_acctbal ?x BIND(xsd:boolean(?x) AS ?a) BIND(YEAR(xsd:dateTime("2021-03-04T05:06:07")) AS ?b) BIND(xsd:double(STR(?k)) AS ?c) BIND(FLOOR(xsd:decimal("12.75") * 100) AS ?d) }',
        "SELECT s_suppkey AS k, s_acctbal <> 0 AS a, 2021::BIGINT AS b, CAST(s_suppkey AS DOUBLE) AS c, CAST(1275 AS DECIMAL(38, 18)) AS d FROM supplier",
    ),
    # More joins with unbound variables
    "optional_chain": (
        "SELECT ?k ?n ?r WHERE { ?c :c_custkey ?k ; :c_acctbal ?b OPTIONAL { ?c :nation ?n ; :c_mktsegment \"BUILDING\" } OPTIONAL { ?n :region ?y . ?y :r_name ?r FILTER(?r = \"ASIA\" && ?b > 9900) } FILTER(?b > 9000) }",
        """SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN 'urn:d:nation/' || c_nationkey WHEN x.nk IS NOT NULL THEN 'urn:d:nation/' || x.nk END AS n, x.r AS r
           FROM customer LEFT JOIN (SELECT n_nationkey AS nk, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') x
           ON c_acctbal > 9900 AND (c_mktsegment <> 'BUILDING' OR c_nationkey = x.nk) WHERE c_acctbal > 9000""",
    ),
    "minus_optional": (
        "SELECT ?k ?n WHERE { ?c :c_custkey ?k OPTIONAL { ?c :nation ?n ; :c_acctbal ?b FILTER(?b > 5000) } MINUS { ?n :region <urn:d:region/2> } }",
        "SELECT c_custkey AS k, CASE WHEN c_acctbal > 5000 THEN 'urn:d:nation/' || c_nationkey END AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT (c_acctbal > 5000 AND n_regionkey = 2)",
    ),
    "describe_where": (
        "DESCRIBE ?n WHERE { ?n :region <urn:d:region/3> }",
        """SELECT 'urn:d:nation/' || n_nationkey AS subject, unnest(['urn:d:n_nationkey', 'urn:d:n_name', 'urn:d:n_regionkey', 'urn:d:region', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type']) AS predicate,
           unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), 'urn:d:region/' || n_regionkey, 'urn:d:Nation']) AS object FROM nation WHERE n_regionkey = 3""",
    ),
    # Geography
    "geo_coordinates": (f"{_GEO} SELECT ?k ?a ?b WHERE {{ ?c :c_custkey ?k ; :wkt ?w BIND(geof:latitude(?w) AS ?a) BIND(geof:longitude(?w) AS ?b) }}", f"SELECT c_custkey AS k, CAST({_LAT} AS DOUBLE) AS a, CAST({_LON} AS DOUBLE) AS b FROM customer"),
    "geo_distance_unit": (
        f'{_GEO} SELECT ?k WHERE {{ ?c :c_custkey ?k ; :wkt ?w FILTER(geof:distance(?w, "POINT(13.4 52.5)"^^geo:wktLiteral, uom:kilometre) < 4500.5) }}',
        f"SELECT c_custkey AS k FROM customer WHERE {_METRES} < 4500500",
    ),
    "geo_one_argument": (f"{_GEO} SELECT ?k ?x WHERE {{ ?r :r_regionkey ?k BIND(geof:distance(\"POINT(1 1)\"^^geo:wktLiteral) AS ?x) }}", "SELECT CAST(r_regionkey AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS x FROM region"),
    "geo_disjoint": _spatial("sfDisjoint", "POLYGON((-30 -12, 42 -12, 42 47, -30 47, -30 -12))", f"NOT ({_LON} BETWEEN -30 AND 42 AND {_LAT} BETWEEN -12 AND 47)"),
    "geo_touches_border": _spatial("sfTouches", "POLYGON((-35 -10, 45 -10, 45 50, -35 50, -35 -10))", f"({_LON} IN (-35, 45) AND {_LAT} BETWEEN -10 AND 50) OR ({_LAT} IN (-10, 50) AND {_LON} BETWEEN -35 AND 45)"),
    "geo_equals": _shapes("sfEquals", ("same",)),
    "geo_overlaps": _shapes("sfOverlaps", ("overlapping",)),
    "geo_touches": _shapes("sfTouches", ("beside",)),
    "geo_crosses": _shapes("sfCrosses", ("line through",)),
    "geo_contains_shapes": _shapes("sfContains", ("same", "within", "point")),
    "geo_buffer": (
        f'{_GEO} SELECT ?k WHERE {{ ?c :c_custkey ?k ; :wkt ?w FILTER(geof:sfWithin(?w, geof:buffer("POINT(5 0)"^^geo:wktLiteral, 1500, uom:kilometre))) }}',
        f"SELECT c_custkey AS k FROM customer WHERE pow({_LON} - 5, 2) + pow({_LAT}, 2) < 169",
    ),
    "geo_envelope": (f'{_GEO} SELECT ?k WHERE {{ ?c :c_custkey ?k ; :wkt ?w FILTER(geof:sfWithin(?w, geof:envelope("LINESTRING(-30 -12, 42 47)"^^geo:wktLiteral))) }}', f"SELECT c_custkey AS k FROM customer WHERE {_LON} BETWEEN -30 AND 42 AND {_LAT} BETWEEN -12 AND 47"),
}

#: name: (native graph query, SQL).
NATIVE: dict[str, tuple[str, str]] = {
    "native_match": ("MATCH (c:Customer)-[:nation]->(n:Nation) WHERE c.c_acctbal > 9000 RETURN c.c_name AS name, n.n_name AS nation", "SELECT c_name AS name, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000"),
    "native_aggregate": ("MATCH (c:Customer)-[:nation]->(n)-[:region]->(r) RETURN r.r_name AS region, count(c) AS n, max(c.c_acctbal) AS most", "SELECT r_name AS region, count(*) AS n, max(c_acctbal) AS most FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"),
    "native_varlen": ("MATCH (o:Order {o_orderkey: 7})-[*1..3]->(x) RETURN x.uri AS x", "SELECT unnest(['urn:d:customer/' || c_custkey, 'urn:d:nation/' || n_nationkey, 'urn:d:region/' || n_regionkey]) AS x FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey = 7"),
    "native_optional": ("MATCH (n:Nation) OPTIONAL MATCH (s:Supplier)-[:nation]->(n) WHERE s.s_acctbal > 9000 RETURN n.n_name AS n, s.s_name AS s", "SELECT n_name AS n, s_name AS s FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 9000"),
    "native_order": ("MATCH (p:Part) WHERE p.p_size >= 40 RETURN DISTINCT p.p_brand AS b, p.p_size AS s ORDER BY b, s DESC SKIP 5 LIMIT 20", "SELECT DISTINCT p_brand AS b, CAST(p_size AS BIGINT) AS s FROM part WHERE p_size >= 40 ORDER BY b, s DESC LIMIT 20 OFFSET 5"),
    "native_with": ("MATCH (o:Order)-[:customer]->(c) WITH c, count(o) AS n WHERE n > 12 MATCH (c)-[:nation]->(x) RETURN c.c_custkey AS k, n, x.n_name AS nation", "SELECT c_custkey AS k, count(*) AS n, n_name AS nation FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY c_custkey, n_name HAVING count(*) > 12"),
    "native_union": ("MATCH (r:Region) RETURN r.r_name AS name UNION ALL MATCH (n:Nation) RETURN n.n_name AS name", "SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation"),
    "native_unwind": ("UNWIND [1, 5, 9] AS k MATCH (n:Nation) WHERE n.n_nationkey = k RETURN k, n.n_name AS name", "SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS name FROM nation WHERE n_nationkey IN (1, 5, 9)"),
    "native_shortest": ("MATCH p = shortestPath((o:Order {o_orderkey: 7})-[*]->(r:Region)) RETURN r.r_name AS r, length(p) AS n", "SELECT r_name AS r, 3::BIGINT AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey = 7"),
    "native_path_length": (
        "MATCH p = (o:Order {o_orderkey: 7})-[:customer]->(c)-[:nation]->(n) RETURN length(p) AS k, n.n_name AS n",
        "SELECT 2::BIGINT AS k, n_name AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey = 7",
    ),
    "native_unbounded": (
        "MATCH (o:Order {o_orderkey: 7})-[*]->(x) RETURN x.uri AS x",
        "SELECT unnest(['urn:d:customer/' || c_custkey, 'urn:d:nation/' || n_nationkey, 'urn:d:region/' || n_regionkey]) AS x FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey = 7",
    ),
    "native_shortest_to": (
        "MATCH p = shortestPath((s:Supplier)-[*]->(r:Region {r_regionkey: 2})) RETURN s.s_suppkey AS s, length(p) AS n",
        "SELECT s_suppkey AS s, 2::BIGINT AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2",
    ),
}

_RULE_BODY = f"(?c <{BASE}nation> ?n) (?n <{BASE}region> ?r)"
_RULE_SQL = "SELECT 'urn:d:customer/' || c_custkey AS c, r_name AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def stored(spark: SparkSession, sf_dir: str, predicates: list[str], rules: str = "") -> TripleGraph:
    """Some predicates of the tables as stored triples."""
    c = Compiler(spark, graph(spark, sf_dir).source())
    triples = R.triples_of(c, [BASE + p for p in predicates]).withColumn("g", F.lit(None).cast("string"))
    return TripleGraph(spark, triples, rules, {"": BASE})


def native_in_sparql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph(spark, sf_dir).query("SELECT ?n ?k WHERE { (?name ?k) <urn:graphloom:native> 'MATCH (n:Nation) RETURN n.n_name AS name, n.n_nationkey AS k' . ?x :n_nationkey ?k ; :n_name ?n FILTER(?k < 10) }")


def rule_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = f"[in: (?c <{BASE}inRegion> ?r) <- {_RULE_BODY}]"
    return graph(spark, sf_dir, rules).query("SELECT ?c ?r WHERE { ?c :inRegion ?x ; :c_custkey ?k . ?x :r_name ?r }")


def rule_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = stored(spark, sf_dir, ["nation", "region", "c_custkey", "r_name"], f"[in: {_RULE_BODY} -> (?c <{BASE}inRegion> ?r)]")
    return held.query("SELECT ?c ?r WHERE { ?c :inRegion ?x ; :c_custkey ?k . ?x :r_name ?r }")


def rule_transitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = f"[a: (?x <{BASE}nation> ?y) -> (?x <{BASE}within> ?y)] [b: (?x <{BASE}region> ?y) -> (?x <{BASE}within> ?y)] [c: (?x <{BASE}within> ?y) (?y <{BASE}within> ?z) -> (?x <{BASE}within> ?z)]"
    return stored(spark, sf_dir, ["nation", "region"], rules).query("SELECT ?x ?y WHERE { ?x :within ?y }")


def update_insert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = stored(spark, sf_dir, ["n_name", "region", "r_name"])
    held.update(
        'INSERT DATA { <urn:d:nation/99> :n_name "ATLANTIS" ; :region <urn:d:region/1> } ; DELETE DATA { <urn:d:nation/3> :n_name "CANADA" } ;'
        ' DELETE { ?n :n_name ?x } INSERT { ?n :n_name ?y ; :renamed true } WHERE { ?n :region <urn:d:region/2> ; :n_name ?x BIND(CONCAT("NEW ", ?x) AS ?y) } ;'
        " DELETE WHERE { ?n :region <urn:d:region/3> }"
    )
    return held.query("SELECT ?s ?p ?o WHERE { ?s ?p ?o }")


_UPDATE_SQL = """
    SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:n_name' AS p, CASE WHEN n_regionkey = 2 THEN 'NEW ' ELSE '' END || n_name AS o FROM nation WHERE NOT (n_nationkey = 3 AND n_name = 'CANADA')
    UNION SELECT 'urn:d:nation/' || n_nationkey, 'urn:d:region', 'urn:d:region/' || n_regionkey FROM nation WHERE n_regionkey <> 3
    UNION SELECT 'urn:d:nation/' || n_nationkey, 'urn:d:renamed', 'true' FROM nation WHERE n_regionkey = 2 AND NOT (n_nationkey = 3 AND n_name = 'CANADA')
    UNION SELECT 'urn:d:region/' || r_regionkey, 'urn:d:r_name', r_name FROM region
    UNION SELECT * FROM (VALUES ('urn:d:nation/99', 'urn:d:n_name', 'ATLANTIS'), ('urn:d:nation/99', 'urn:d:region', 'urn:d:region/1'))"""


def triples_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, ["c_name", "c_acctbal", "nation", "n_name"]).query('SELECT ?name ?bal ?n WHERE { ?c :c_name ?name ; :c_acctbal ?bal ; :nation ?x . ?x :n_name ?n FILTER(?bal > 5000) }')


def triples_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .terms import IRI

    found = stored(spark, sf_dir, ["n_name", "region"]).find(p=IRI(BASE + "region"))
    return found.select("s", "p", F.col("o.lex").alias("o"))


def named_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = stored(spark, sf_dir, ["region"])
    names = R.triples_of(Compiler(spark, graph(spark, sf_dir).source()), [BASE + "r_name"]).withColumn("g", F.lit("urn:g:names"))
    held.add_all(names)
    return held.query("SELECT ?g ?n ?name WHERE { ?n :region ?r GRAPH ?g { ?r :r_name ?name } }")


def ntriples_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored triples, written as N-Triples, read again and queried."""
    import uuid

    from .sources import readers
    from .storage import ensure_folder

    ensure_folder(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/nt-{uuid.uuid4().hex}"
    stored(spark, sf_dir, ["n_name", "region", "c_acctbal"]).dump(path)
    again = TripleGraph(spark, readers.read_ntriples(spark, path), prefixes={"": BASE})
    return again.query("SELECT ?s ?b WHERE { ?s :c_acctbal ?b FILTER(?b < 0) }")


PROGRAMS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "native_in_sparql": (native_in_sparql, "SELECT n_name AS n, CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_nationkey < 10"),
    "rule_backward": (rule_backward, _RULE_SQL),
    "rule_forward": (rule_forward, _RULE_SQL),
    "rule_transitive": (
        rule_transitive,
        SPARQL["path_plus_all"][1],
    ),
    "update_insert_delete": (update_insert_delete, _UPDATE_SQL),
    "triples_star": (triples_star, "SELECT c_name AS name, c_acctbal AS bal, n_name AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000"),
    "triples_find": (triples_find, "SELECT 'urn:d:nation/' || n_nationkey AS s, 'urn:d:region' AS p, 'urn:d:region/' || n_regionkey AS o FROM nation"),
    "named_graphs": (named_graphs, "SELECT 'urn:g:names' AS g, 'urn:d:nation/' || n_nationkey AS n, r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "ntriples_round_trip": (ntriples_round_trip, "SELECT 'urn:d:customer/' || c_custkey AS s, c_acctbal AS b FROM customer WHERE c_acctbal < 0"),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: sparql(q) for n, (q, _) in SPARQL.items()} | {n: native(q) for n, (q, _) in NATIVE.items()} | {n: f for n, (f, _) in PROGRAMS.items()}
ORACLE_SQL: dict[str, str] = {n: s for group in (SPARQL, NATIVE, PROGRAMS) for n, (_, s) in group.items()}

#: Queries that the benchmark times.
HEADLINE = ("bgp_flagship", "bgp_chain3", "bgp_cycle", "filter_date", "optional_nested", "agg_multi", "agg_two_keys", "subquery_agg", "not_exists", "path_plus", "geo_within", "native_aggregate")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["bgp_flagship"](spark, sf_dir)


__all__ = ["HEADLINE", "MAPPING", "ORACLE_SQL", "QUERIES", "flagship", "graph", "os"]
