"""refinery: two-zone (raw -> curated) batch pipelines expressed as Spark DataFrame functions.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst can push filters, prune columns and
keep the work inside whole-stage codegen.  Column names, clocks and paths
are arguments; nothing reads a global location.
"""

__version__ = "0.1.0"
