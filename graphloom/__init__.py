"""graphloom: SPARQL-style graph analytics compiled to Spark DataFrames."""
