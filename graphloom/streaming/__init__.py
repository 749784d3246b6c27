"""Graphs that grow: triples from a stream."""
