"""panelforge: daily asset-panel analytics on Spark DataFrames.

Every operator is a function over DataFrames (or a Column builder); nothing
collects to the driver.  Sub-packages:

- ``functions``  Column builders: guarded rolling aggregates, EWM, null-safe math
- ``operators``  DataFrame -> DataFrame operators: joins (incl. as-of), reshape,
                 signals / scorers / alphas, portfolio combination, data quality
- ``sources``    table store (year-partitioned parquet, upsert/update/delete),
                 archive / text / extract readers
- ``plans``      whole flows (assets panel, signals, combination chain) and the
                 derived test fixtures used by the query registry
- ``streaming``  incremental drop-folder ingest with idempotent merge
"""

__version__ = "0.1.0"
