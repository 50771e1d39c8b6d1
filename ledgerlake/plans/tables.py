"""Access to the test tables (one Parquet file each) with the role names of the warehouse.

Role map: orders = invoice header, lineitem = invoice line, customer = customer,
supplier = seller, part = article, nation/region = branch, events = approval requests.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
