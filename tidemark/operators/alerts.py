"""Alert predicate, shared by batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: an alert is raised strictly below this reserve.
RESERVE_THRESHOLD_MW = 5500


def reserve_alerts(readings: DataFrame, threshold: float = RESERVE_THRESHOLD_MW) -> DataFrame:
    """Readings whose reserve is below the threshold; NULL and NaN never pass."""
    return readings.filter(F.col("reserve_power_mw") < threshold)
