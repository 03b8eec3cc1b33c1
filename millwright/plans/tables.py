"""Table access for registered queries: the fixture views over driver data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sensor_readings(spark, sf_dir)


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.production_events(spark, sf_dir)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.predictions(spark, sf_dir)
