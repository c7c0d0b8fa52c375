"""Operators of a training-data pipeline at corpus scale: near-duplicate
joins, substring dedup, fingerprints, tokenisation, classifiers, language
identification, decontamination and archives.

Every operator takes DataFrames and returns DataFrames.  Per-row numpy runs
inside Arrow batches; partitioning, shuffles, joins and aggregates are Spark's.
"""
