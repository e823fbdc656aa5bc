"""Operators of a training-data pipeline. Nothing outside this folder imports them.

``LLM_QUERIES`` and ``LLM_SQL`` in ``queries`` are what the entry module adds.
"""
