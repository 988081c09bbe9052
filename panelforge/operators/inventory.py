"""Safety stock and total cost: the two formulas that the reference states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Service level, lead time and costs.
Z, LEAD_DAYS, LEAD_STD = 1.645, 7.0, 1.5
HOLDING, PENALTY = 0.05, 2.00


def safety_stock(df: DataFrame, z: float = Z, lead: float = LEAD_DAYS, lead_std: float = LEAD_STD) -> DataFrame:
    """Z * sqrt(L * var(demand) + mean(demand)**2 * var(L)) by series; one day of data has no variance."""
    demand = df.groupBy("id").agg(F.avg("sales").alias("mean_demand"), F.coalesce(F.stddev_samp("sales"), F.lit(0.0)).alias("std_demand"))
    stock = z * F.sqrt(lead * F.col("std_demand") ** 2 + F.col("mean_demand") ** 2 * lead_std**2)
    return demand.withColumn("safety_stock", stock)


def total_cost(level: Column | str, missed: Column | str, holding: float = HOLDING, penalty: float = PENALTY) -> Column:
    """Holding cost times the stock level, and the penalty for missed sales."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return holding * as_column(level) + penalty * as_column(missed)
