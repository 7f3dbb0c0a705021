"""Lazy access to the driver's parquet tables.

Each table is a plain ``spark.read.parquet`` scan; Catalyst prunes columns and
pushes filters into the scan, so callers select only what they use.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class DriverTables:
    """``tables.orders`` -> DataFrame over ``{sf_dir}/orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")
