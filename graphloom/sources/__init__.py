"""Where triples come from: tables mapped to a virtual graph, stored triples, and files."""
