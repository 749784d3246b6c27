"""SPARQL text to algebra."""
