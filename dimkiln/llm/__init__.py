"""Operators of a training-data pipeline, each built on Spark DataFrames.

Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__`` and the pipeline at the top of the repository.
"""
