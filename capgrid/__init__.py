"""capgrid: facility capacity analytics as Spark DataFrame jobs.

Modules:
  sources    -- readers and the partitioned Parquet sink (A*)
  functions  -- column expressions: text, dates, maps, fuel sets (B*, C*, D1)
  operators  -- fuel classes, geometry, placement, imputation, capacity,
                raster, data quality, report tables (D*-J*)
  plans      -- category jobs (P*), test stand-ins and the query registry
  streaming  -- incremental aggregation of newly published plant files
"""

__version__ = "0.1.0"
