"""Readers of heterogeneous files as DataFrames that keep the physical origin of every row."""

from pyspark.sql import SparkSession


def register_all(spark: SparkSession) -> None:
    """Register every data source of the engine with a session."""
    from . import archives, flat, ooxml

    for module in (ooxml, archives, flat):
        module.register(spark)
