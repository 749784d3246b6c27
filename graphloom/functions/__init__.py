"""SPARQL expressions and functions as Spark columns."""
