"""File-system metadata helpers."""

import os

from mediamart.sources.fs import data_file_count, exists, size_bytes


def test_data_file_count_and_size(spark, tmp):
    path = os.path.join(tmp, "t")
    assert not exists(spark, path) and data_file_count(spark, path) == 0
    spark.range(100).selectExpr("id", "cast(id % 3 AS string) AS c").repartition(2) \
        .write.partitionBy("c").parquet(path)
    files = spark.read.parquet(path).inputFiles()
    assert data_file_count(spark, path) == len(files)              # _SUCCESS and .crc not counted
    assert size_bytes(spark, path) >= sum(os.path.getsize(f.replace("file:", "")) for f in files)
