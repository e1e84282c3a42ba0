"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this folder (but for the entry file and ``corpus_pipeline.py``)
imports it.  Every operator is a function from DataFrames to a DataFrame.
"""
