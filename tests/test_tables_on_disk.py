"""Versioned tables, keyed tables, and streams that are compacted."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from basketlens.functions.file_system import FileSystem
from basketlens.sources import keyed_table
from basketlens.sources.versioned_table import VersionedTable
from basketlens.streaming import conversions
from tests.conftest import rows

DDL = "month string, id long, v double"


def made(spark, *triples):
    return spark.createDataFrame(list(triples), DDL)


def test_versions_of_a_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.overwrite(made(spark, ("jan", 1, 1.0), ("feb", 2, 2.0)), ["month"]) == 1
    assert table.append(made(spark, ("feb", 3, 3.0), (None, 4, 4.0))) == 2
    assert table.replace_partitions(made(spark, ("feb", 9, 9.0), ("mar", 5, 5.0)).select("v", "id", "month")) == 3
    assert rows(table.read()) == sorted([("jan", 1, 1.0), (None, 4, 4.0), ("feb", 9, 9.0), ("mar", 5, 5.0)], key=repr)
    assert rows(table.read(1)) == [("feb", 2, 2.0), ("jan", 1, 1.0)] and table.read().columns == ["month", "id", "v"]
    table.vacuum()
    assert table.versions() == [3] and table.read().count() == 4
    with pytest.raises(ValueError):
        table.append(made(spark, ("jan", 1, 1.0)).withColumn("more", F.lit(1)))
    plain = VersionedTable(spark, str(tmp_path / "plain"))
    plain.overwrite(made(spark, ("jan", 1, 1.0)))
    plain.append(made(spark, ("jan", 1, 1.0)))
    assert plain.read().count() == 2
    with pytest.raises(ValueError):
        plain.replace_partitions(made(spark, ("jan", 1, 1.0)))
    plain.overwrite(made(spark, ("jan", 1, 1.0)).limit(0))
    assert plain.read().isEmpty() and plain.read().columns == ["month", "id", "v"]


@pytest.mark.parametrize("lost_at", ["_staged", "_commit"])
def test_a_lost_write_changes_nothing(spark, tmp_path, monkeypatch, lost_at):
    """The job dies halfway through its files, or before its manifest."""
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(made(spark, ("jan", 1, 1.0), ("feb", 2, 2.0)), ["month"])
    before = rows(table.read())

    def die(self, df, *more):
        df.write.partitionBy("month").parquet(f"{self.path}/data/write=half")
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, lost_at, die if lost_at == "_staged" else lambda *a: die(table, made(spark, ("jan", 7, 7.0))))
    for change in (table.append, table.replace_partitions, table.overwrite):
        with pytest.raises(Exception):
            change(made(spark, ("jan", 7, 7.0)))
        assert rows(VersionedTable(spark, table.path).read()) == before
    monkeypatch.undo()
    assert table.replace_partitions(made(spark, ("jan", 7, 7.0))) == 2
    assert rows(table.read()) == [("feb", 2, 2.0), ("jan", 7, 7.0)]
    table.vacuum()
    assert "write=half" not in os.listdir(tmp_path / "t" / "data") and table.read().count() == 2


def test_second_writer_of_a_version_fails(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.overwrite(made(spark, ("jan", 1, 1.0)))
    before = two.manifest()
    one.append(made(spark, ("jan", 2, 2.0)))
    with pytest.raises(FileExistsError):
        two._commit(before, made(spark), (), [])
    assert one.read().count() == 2


def scanned_rows(df):
    """Rows that the files' reader handed on, and how many exchanges there are."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total, plan.toString().count("Exchange")


def test_lookup_reads_few_rows(spark, tmp_path):
    path = str(tmp_path / "keyed")
    people = spark.range(60_000).select(F.concat(F.lit("p"), F.col("id")).alias("who"), F.md5(F.col("id").cast("string")).alias("x"), F.col("id").alias("n"))
    extra = spark.createDataFrame([(None, "null", 1), ("p7", "again", 2)], "who string, x string, n long")
    keyed_table.write_keyed(people.unionByName(extra), path, "who", buckets=8, row_group_bytes=64 << 10)
    asked = spark.createDataFrame([("p7",), ("p7",), ("p59999",), ("nobody",), (None,)], "who string")
    found = keyed_table.read_keyed(spark, path, "who", asked, buckets=8)
    assert [(r["who"], r["n"]) for r in found.orderBy("who", "n").collect()] == [("p59999", 59999), ("p7", 2), ("p7", 7)]
    assert found.columns == ["who", "x", "n"]
    read, exchanges = scanned_rows(keyed_table.read_keyed(spark, path, "who", asked, buckets=8))
    print("rows read:", read)
    assert read < 0.1 * 60_000 and exchanges == 0
    assert keyed_table.read_keyed(spark, path, "who", asked.limit(0), buckets=8).isEmpty()


def test_many_keys_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "PUSHED_KEYS", 3)
    path = str(tmp_path / "keyed")
    keyed_table.write_keyed(spark.range(1000).withColumnRenamed("id", "who").withColumn("n", F.col("who") * 2), path, "who", buckets=4)
    found = keyed_table.read_keyed(spark, path, "who", spark.range(0, 2000, 100).select(F.col("id").cast("int").alias("who")), buckets=4)
    assert rows(found) == sorted(((i, 2 * i) for i in range(0, 1000, 100)), key=repr)


def test_compacted_stream_equals_batch(spark, tmp_path):
    schema = "event_id long, ts timestamp, experiment string, variant string, converted boolean, value double"
    source, path, files = str(tmp_path / "in"), str(tmp_path / "table"), FileSystem(spark, str(tmp_path))
    made, kept = [], []
    for trigger in range(6):
        start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=8 * trigger)
        batch = [(100 * trigger + i, start + dt.timedelta(minutes=50 * i), "e", "ab"[i % 2], i % 3 == 0, float(i)) for i in range(9)]
        made += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        events = conversions.event_stream(spark, source, spark.createDataFrame([], schema).schema)
        results = conversions.windowed_results(events)
        found = conversions.run_to_table(results, path, compact_after=2)
        kept.append(len(files.names(f"{path}/versions")) + len(files.names(f"{path}/base")))
        whole = spark.createDataFrame(made, schema)
        want = whole.groupBy(F.date_trunc("day", "ts"), "experiment", "variant").agg(F.count("*"), F.count_if("converted"), F.sum("value"))
        assert rows(found) == rows(want)
    assert max(kept) <= 3 and files.names(f"{path}/base") != []
    last = rows(found)
    # a base that was not finished does not count
    os.makedirs(f"{path}/base/upto=999")
    assert rows(conversions._latest(conversions._versions(spark, path, results.schema)).select(*conversions.KEYS, "users", "conversions", F.col("total_value").cast("double"))) == last
    assert conversions.compact(spark, path, results.schema) in (None, *range(20))
    assert conversions.compact(spark, path, results.schema) is None
