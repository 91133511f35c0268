"""Inputs: registry documents, landed response pages and the benchmark tables."""
