"""Operators of a large-scale training-data pipeline.

One module per operator; `queries` registers one query for each, and
`corpus_pipeline.py` at the top of the repository chains five of them.
Nothing outside this package imports it.
"""
