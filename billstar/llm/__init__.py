"""Operators for preparing training data: quality and toxicity scoring,
near-duplicate search, decontamination, language identification, token
statistics, URL rules, source mixing and WARC derivatives.

Nothing outside this subpackage imports it. Every operator is a function
of DataFrames; the registered queries are in :mod:`billstar.llm.queries`.
"""
