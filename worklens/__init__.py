"""worklens: procurement work-queue analytics expressed as Spark DataFrame plans.

Layout
------
context      RunContext: the frozen run parameters (as-of date, windows, thresholds)
session      SparkSession factory for tests / bench, scratch-folder resolution
schemas      explicit StructTypes for every input
sources/     readers, writers and the fixture views over the driver tables
functions/   Column -> Column helpers (bins, ages, weeks, formats, categories)
operators/   generic DataFrame -> DataFrame building blocks
plans/       the report datasets (backlog, worklist, archive, throughput)
streaming/   incremental (Structured Streaming) variants
catalog/     the query registry used by __spark_entry__ and its SQL oracles
"""

from worklens.context import RunContext

__all__ = ["RunContext"]
