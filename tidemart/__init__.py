"""tidemart: lifecycle operators for partitioned parquet datamarts on Spark.

Every operator is a DataFrame-in / DataFrame-out function built from public
Spark APIs.  Only the sinks and the partition-maintenance operators have side
effects (they write or delete parquet data under a mart's location).
"""

from tidemart.plans.mart import Mart
from tidemart.plans.refresh import RunSettings, refresh_mart

__all__ = ["Mart", "RunSettings", "refresh_mart"]
