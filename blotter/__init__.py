"""blotter: incident analytics and outcome prediction on Spark.

Library functions take DataFrames and return DataFrames; none of them owns a
SparkSession. Layout:

- ``sources``    schema, CSV / Parquet ingest, the derived ``incidents`` view,
                 the synthetic incident table
- ``functions``  column expressions (hash uniforms, time parsing, clamps, bars)
- ``operators``  analytics, sampling, features, models, metrics, reports
- ``plans``      the registered queries, their DuckDB oracles and the batch job
"""

__version__ = "0.1.0"
