"""The flagship query: a year's totals by canonical group and landscape unit.

On the shared tables: line items are the emission records, the part type is the
free-text pollutant label (canonicalised through the label dimension), the supplier's
nation is the landscape unit, the ship date gives the year. One broadcast of the fixed
label dimension, hash joins chosen by the optimizer for the data tables, a partial +
final aggregate, then an ordered report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airledger.operators import metrics
from airledger.plans.table_queries import UNIT_YEAR, unit_totals


def unit_totals_report(spark: SparkSession, sf_dir: str, year: int = UNIT_YEAR) -> DataFrame:
    totals = unit_totals(spark, sf_dir, year)
    totals = totals.withColumn("emision_total", totals["emision_total"].cast("double"))
    return metrics.ordered_report(totals, "contaminante_canon", "emision_total", "unidad_paisaje")
