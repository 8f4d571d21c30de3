import glob
import os

import pytest
from pyspark.sql import functions as F

from odflow.sources.published import publish_result, read_manifest, read_result, retire_versions


def _rows(df):
    return sorted(map(str, df.collect()))


def test_round_trip_and_versions(spark, tmp_path):
    path = str(tmp_path / "r")
    one = spark.createDataFrame([(1, None, "x"), (None, 2, "y"), (None, 2, "y")], "a int, b int, `c d` string")
    two = spark.range(100).withColumn("m", F.create_map(F.lit("k"), F.col("id")))
    first = publish_result(one, path)
    assert (first["version"], first["rows"]) == (1, 3) and _rows(read_result(spark, path, verify=True)) == _rows(one)
    assert publish_result(two, path)["version"] == 2
    assert _rows(read_result(spark, path + "/", verify=True)) == _rows(two)
    assert _rows(read_result(spark, path, version=1, verify=True)) == _rows(one)
    assert retire_versions(spark, path) == [1] and retire_versions(spark, path) == []
    assert _rows(read_result(spark, path)) == _rows(two)
    with pytest.raises(ValueError):
        read_result(spark, path, version=1)


def test_broken_write_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "r")
    publish_result(spark.range(5), path)
    with pytest.raises(Exception):
        publish_result(spark.range(1000).select(F.when(F.col("id") < 999, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id")), path)
    (tmp_path / "r" / "_staged-lost").write_text("{")  # a writer lost before it renamed
    assert read_result(spark, path, verify=True).count() == 5
    assert publish_result(spark.range(7), path)["version"] == 2 and read_result(spark, path).count() == 7


def test_changed_rows_are_found(spark, tmp_path):
    path = str(tmp_path / "r")
    publish_result(spark.range(100).repartition(4), path)
    os.remove(glob.glob(f"{path}/rows-1-*/part-*.parquet")[0])
    with pytest.raises(ValueError, match="not as it was published"):
        read_result(spark, path, verify=True)


def test_checksum_sees_places_of_nulls_not_order(spark, tmp_path):
    sums = []
    for k, rows in enumerate(([(1, None), (2, 3)], [(2, 3), (1, None)], [(None, 1), (2, 3)])):
        sums.append(publish_result(spark.createDataFrame(rows, "a int, b int"), str(tmp_path / str(k)))["checksum"])
    assert sums[0] == sums[1] != sums[2]


def test_empty_result_and_missing_path(spark, tmp_path):
    publish_result(spark.range(0), str(tmp_path / "e"))
    back = read_result(spark, str(tmp_path / "e"), verify=True)
    assert back.columns == ["id"] and back.count() == 0 and read_manifest(spark, str(tmp_path / "e"))["checksum"] == "0"
    with pytest.raises(ValueError):
        read_result(spark, str(tmp_path / "none"))
