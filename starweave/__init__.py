"""Hub-and-spoke star assembly over spatially partitioned parquet catalogs, on Spark."""

__version__ = "0.1.0"
