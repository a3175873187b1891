"""scoria — Spark-native client feature marts and interpretable WoE scorecards.

Every pass over rows is a DataFrame / SQL / MLlib job.  Only bin tables,
path tables and feature-by-feature matrices ever reach the driver.
"""

from scoria.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
