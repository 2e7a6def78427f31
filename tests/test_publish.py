import pytest
from pyspark.sql.types import IntegerType, StringType

from ledgerline.sources.sinks import SchemaMismatch, conform, publish, read_published, warehouse_dir


def test_publish_versions_and_read_back(spark, tmp_path):
    base = str(tmp_path / "t")
    df1 = spark.createDataFrame([(1, "a")], "x int, y string")
    publish(df1, base, [("x", IntegerType()), ("y", StringType())], version="0001")
    df2 = spark.createDataFrame([(2, "b"), (3, "c")], "x int, y string")
    publish(df2, base, version="0002")
    publish(df2, base, version="0003", keep=2)
    got = sorted(r.x for r in read_published(spark, base).collect())
    assert got == [2, 3]
    assert sorted(p.name for p in tmp_path.joinpath("t").iterdir()) == ["_commits", "v=0002", "v=0003"]


def test_commit_order_decides_not_the_version_name(spark, tmp_path):
    base = str(tmp_path / "t")
    for version in ("9", "10"):
        path = publish(spark.createDataFrame([(int(version),)], "x int"), base, version=version, keep=1)
        assert path.endswith(f"v={version}") and read_published(spark, base).collect()[0].x == int(version)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["_commits", "v=10"]


def test_reader_ignores_unfinished_versions_and_commits(spark, tmp_path):
    base = str(tmp_path / "t")
    publish(spark.createDataFrame([(1,)], "x int"), base, version="a")
    spark.createDataFrame([(2,)], "x int").write.parquet(f"{base}/v=zz")  # written, not committed
    (tmp_path / "t" / "_commits" / "00000000000000000009").write_text("zz")  # cut short
    assert [r.x for r in read_published(spark, base).collect()] == [1]
    publish(spark.createDataFrame([(3,)], "x int"), base, version="b")
    assert [r.x for r in read_published(spark, base).collect()] == [3]


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def test_conform_orders_and_rejects(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert conform(df, [("y", None), ("x", StringType())]).dtypes == [("y", "string"), ("x", "string")]
    with pytest.raises(SchemaMismatch):
        conform(df, [("x", None)])


def test_published_tables_live_in_the_warehouse(spark):
    assert warehouse_dir(spark, "a") == spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/a"


def test_publish_partitioned_version(spark, tmp_path):
    base = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 202401), (2, 202402)], "x int, m int")
    path = publish(df, base, version="0001", partition_by=["m"])
    assert sorted(p.name for p in (tmp_path / "p" / "v=0001").iterdir() if p.name.startswith("m=")) == ["m=202401", "m=202402"]
    assert read_published(spark, base).filter("m = 202402").collect()[0].x == 2
    assert path.endswith("v=0001")
