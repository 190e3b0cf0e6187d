"""Spark-native curation of large item catalogs.

Every operator is a plain function over DataFrames.  Nothing reads a clock:
operators that depend on "now" take ``as_of``.  Nothing depends on row order:
every ranking ends with a unique key.
"""
