import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from frames import rows
from plazaflow.sources.lake import with_provenance


def numbers(spark, n):
    return spark.range(n).toDF("n")


def test_addresses(lake):
    assert lake.path("silver", "t") == f"{lake.root}/silver/t"
    with pytest.raises(ValueError):
        lake.path("platinum", "t")


def test_provenance(spark):
    out = with_provenance(numbers(spark, 1), "real")
    assert out.columns == ["n", "source", "ingest_ts", "ingest_date"]
    with pytest.raises(ValueError):
        with_provenance(numbers(spark, 1), "rumour")


def test_appends_add_up_below_their_date(spark, lake):
    assert lake.append_bronze(numbers(spark, 2), "t", "real") == 2
    assert lake.append_bronze(numbers(spark, 2), "t", "synthetic") == 2
    back = lake.read("bronze", "t")
    assert back.count() == 4
    assert dict(back.dtypes)["ingest_date"] == "date"
    today = back.agg(F.max("ingest_date")).head()[0]
    assert lake.read("bronze", "t", since=today).count() == 4
    assert lake.read("bronze", "t", since=today + dt.timedelta(days=1)).count() == 0


def test_since_prunes_partitions(spark, lake):
    lake.append_bronze(numbers(spark, 2), "t", "real")
    plan = lake.read("bronze", "t", since=dt.date(2026, 1, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_a_snapshot_replaces_rows_and_schema(spark, lake):
    lake.replace_bronze(numbers(spark, 5), "t", "real")
    lake.replace_bronze(numbers(spark, 1).withColumn("new", F.lit("x")), "t", "real")
    assert rows(lake.read("bronze", "t"), "n", "new") == [(0, "x")]


def test_silver_and_gold_are_rebuilt(spark, lake):
    lake.replace(numbers(spark, 3), "gold", "t")
    assert lake.replace(numbers(spark, 2).toDF("m"), "gold", "t") == 2
    assert rows(lake.read("gold", "t")) == [(0,), (1,)]


def test_a_table_can_be_rebuilt_from_itself(spark, lake):
    lake.replace(numbers(spark, 3), "gold", "t")
    assert lake.replace(lake.read("gold", "t").where("n > 0"), "gold", "t") == 2
    assert rows(lake.read("gold", "t")) == [(1,), (2,)]


@pytest.mark.parametrize("write", ["replace", "replace_bronze"])
def test_a_rebuild_that_fails_leaves_the_old_table(spark, lake, write):
    def rebuild(df):
        if write == "replace":
            return lake.replace(df, "bronze", "t")
        return lake.replace_bronze(df, "t", "real")

    rebuild(numbers(spark, 3))
    broken = numbers(spark, 100).select(
        F.when(F.col("n") < 99, F.col("n")).otherwise(F.raise_error(F.lit("no"))).alias("n")
    )
    with pytest.raises(Exception, match="no"):
        rebuild(broken)
    assert rows(lake.read("bronze", "t"), "n") == [(0,), (1,), (2,)]
    assert rebuild(numbers(spark, 1)) == 1
    assert rows(lake.read("bronze", "t"), "n") == [(0,)]


def test_a_first_rebuild_that_fails_is_no_table(spark, lake):
    with pytest.raises(Exception, match="no"):
        lake.replace(spark.range(3).select(F.raise_error(F.lit("no"))), "gold", "t")
    assert lake.find("gold", "t") is None


def test_readers_of_the_last_version_can_finish(spark, lake):
    lake.replace(numbers(spark, 3), "gold", "t")
    reader = lake.read("gold", "t")
    lake.replace(numbers(spark, 1), "gold", "t")
    assert reader.count() == 3


def test_a_broken_table_is_an_error(spark, lake, tmp_path):
    lake.replace(numbers(spark, 3), "gold", "t")
    for part in (tmp_path / "lake/gold/t").rglob("*.parquet"):
        part.write_bytes(b"no parquet")
    with pytest.raises(Exception):
        lake.find("gold", "t").count()


def test_a_repeated_commit_takes_its_own_place(spark, lake):
    lake._append(with_provenance(numbers(spark, 5), "real"), "t", "stream", 3)
    lake._append(with_provenance(numbers(spark, 5), "real"), "t", "stream", 3)
    lake._append(with_provenance(numbers(spark, 2), "real"), "t", "stream", 4)
    assert lake.read("bronze", "t").count() == 7


def test_an_empty_table_can_be_written_and_read(spark, lake):
    assert lake.replace(numbers(spark, 0), "silver", "t") == 0
    assert lake.read("silver", "t").count() == 0


def test_missing_tables_are_none(lake):
    assert lake.find("gold", "t") is None
    assert not lake.exists("gold", "t")


def test_commits_are_counted(spark, lake):
    assert lake.commits().count() == 0
    lake.append_bronze(numbers(spark, 1), "t", "real")
    lake.append_bronze(numbers(spark, 1), "t", "real")
    lake.replace(numbers(spark, 1), "gold", "u")
    assert rows(lake.commits()) == [("bronze", "t", 2), ("gold", "u", 1)]


def test_views(spark, lake):
    lake.replace(numbers(spark, 4), "gold", "some_view")
    lake.register_views("gold", "some_view")
    assert spark.sql("SELECT max(n) FROM some_view").head()[0] == 3


def test_rebuilt_tables_are_packed_and_leave_no_shuffled_rows(spark, lake):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(20_000).repartition(3).select("id", F.lit("the same text").alias("t"))
    assert lake.replace(rows, "silver", "packed") == 20_000
    assert all(f.endswith(".zstd.parquet") for f in lake.read("silver", "packed").inputFiles())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"
