"""tidemark: medallion, change-data-capture and slowly-changing-dimension pipelines on Spark.

The layers follow the flow of the data:

``sources``    relational and parquet extraction, watermarks, bronze files, tables
``functions``  column expressions
``operators``  DataFrame -> DataFrame operators (projection, dedupe, joins, quality, SCD)
``streaming``  file-arrival streams into silver tables
``plans``      the ingest loop, the published tables and the full cycle
"""
