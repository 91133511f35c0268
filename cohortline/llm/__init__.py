"""Operators that prepare text corpora for language-model training.

Nothing outside this package imports it. Each module holds one operator; the thin
queries that apply them to the benchmark tables are in ``queries``.
"""
