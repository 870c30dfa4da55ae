"""tallyspark: report ingest, data-quality checks and ad-profit analytics on Spark.

Everything is expressed as DataFrame / SQL operations so Catalyst can push
filters, prune columns and pick join strategies; nothing per-row or per-key is
collected to the driver.
"""

from tallyspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
