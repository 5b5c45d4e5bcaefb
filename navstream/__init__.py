"""navstream: navigation-edge and edit-stream analytics expressed as Spark DataFrame plans.

Every transform in this package is a lazy ``DataFrame -> DataFrame`` function built only from
``pyspark.sql.functions`` expressions, so Catalyst sees the whole plan (pruning, pushdown,
partial aggregation, top-k pushdown) and the work stays inside whole-stage codegen.
Actions (writes, counts) live only in :mod:`navstream.plans`.
"""

__version__ = "0.1.0"
