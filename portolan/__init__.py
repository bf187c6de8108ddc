"""portolan: a star-schema warehouse for traveller arrivals, built on Spark DataFrames.

Layers
------
``functions``  Column -> Column helpers (casts, day-number dates, title case, ...).
``operators``  DataFrame -> DataFrame building blocks (aggregations, joins, checks).
``sources``    typed reads, partitioned writes, lookups, key/value text extraction.
``plans``      the dimension/fact jobs, the warehouse load and the analytic questions.
``streaming``  incremental ingestion of monthly deliveries (Structured Streaming).
"""

__version__ = "0.1.0"
