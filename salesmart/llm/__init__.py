"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``/corpus_pipeline.py`` chains five of its operators.
"""
