"""Corpus selection and evaluation jobs for Spark.

Everything takes and returns DataFrames, so the pieces compose with
``DataFrame.transform`` and run inside whatever session the caller has.
"""
