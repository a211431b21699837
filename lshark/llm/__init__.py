"""Operators of a training-data pipeline.

Thirteen operators over ``documents``, ``benchmark``, ``embeddings`` and ``pages`` plus the shared
helpers they need.  Nothing outside this folder imports it; the queries are in
:mod:`lshark.llm.queries`, the pipeline in ``corpus_pipeline.py``.
"""
