"""Operators for large text and embedding corpora, each a composition of Spark jobs.

Nothing outside this subpackage imports it.
"""
