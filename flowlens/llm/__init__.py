"""Training-data operators: dedup, scoring, fingerprints, tokens, packing.

Each module holds one operator as a Spark job over a DataFrame; ``queries``
holds the registered ``opN_*`` queries and their SQL. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
