"""Registry analytics on Spark: clinical studies and drug applications as DataFrames."""

from cohortline.warehouse import Warehouse

__all__ = ["Warehouse"]
