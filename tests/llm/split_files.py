"""A fixture: one Parquet file that several tasks read."""

import os

import pytest


@pytest.fixture()
def split_file(spark, tmp_dir):
    """Writes rows as one Parquet file that several tasks read: chunks of its rows are split."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")

    def write(df):
        path = os.path.join(tmp_dir, "one_file")
        df.coalesce(1).write.option("parquet.block.size", 30_000).option("compression", "none").parquet(path)
        size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 3))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        out = spark.read.parquet(path)
        assert out.selectExpr("spark_partition_id() AS p").distinct().count() > 1
        return out

    yield write
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)
