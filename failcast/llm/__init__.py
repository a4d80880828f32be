"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage, so it can be left out of a
deployment together with ``corpus_pipeline.py`` and ``tests/llm``.
"""
