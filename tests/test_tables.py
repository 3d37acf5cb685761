"""Bucketed tables: what a change writes, versions, batches that come again, writers that meet or die."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from prospectra.operators import crud
from prospectra.sources.tables import BucketTable, VersionConflict, appending, folding

SCHEMA = "k string, v long, _ord long"
FOLD = lambda old, new: crud.merge(old, new, "k")


def rows_of(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def written(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"), F.col("id").alias("_ord"))
    return BucketTable.create(rows, str(tmp_path / "t"), ["k"], 32)


def test_a_change_writes_what_it_touches(spark, table):
    whole = written(table.path)
    before = table.manifest()
    assert table.change(spark.createDataFrame([("k7", -1, 1), ("new", 5, 1)], SCHEMA), FOLD)
    after = table.manifest()
    same = [b for b in before.folders if after.folders.get(b) == before.folders[b]]
    assert len(before.folders) - len(same) <= 2 and written(table.path) - whole < whole / 8
    now = rows_of(table)
    assert len(now) == 20_001 and now["k7"] == -1 and now["new"] == 5 and now["k8"] == 8
    assert rows_of(table, 0)["k7"] == 7 and table.versions() == [0, 1]
    grown = written(table.path)
    table.change(spark.createDataFrame([(f"k{n}", 0, 1) for n in range(400)], SCHEMA), FOLD)
    assert written(table.path) - grown > 5 * (grown - whole)


def test_deletes_and_nulls(spark, tmp_path):
    table = BucketTable.create(spark.createDataFrame([("a", 1, 1), (None, 2, 2)], SCHEMA), str(tmp_path / "t"), ["k"], 4)
    drop = lambda old, gone: old.join(gone.select("k"), "k", "left_anti")
    table.change(spark.createDataFrame([("a", 0, 0)], SCHEMA), drop)
    assert rows_of(table) == {None: 2}
    table.change(spark.createDataFrame([], SCHEMA), drop)
    assert rows_of(table) == {None: 2} and table.versions() == [0, 1, 2]
    empty = BucketTable.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), ["k"], 4)
    assert empty.read().collect() == [] and empty.read().columns == ["k", "v", "_ord"]
    with pytest.raises(ValueError):
        table.read(9)
    with pytest.raises(VersionConflict):
        BucketTable.create(empty.read(), table.path, ["k"], 4)


def test_a_batch_counts_once(spark, table):
    one = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    assert table.append(one, ("s", 0)) and not table.append(one, ("s", 0)) and table.append(one, ("other", 0))
    assert table.append(one, ("s", 1)) and not table.change(one, FOLD, ("s", 1))
    assert table.read().where("k = 'x'").count() == 3


def test_writers_that_meet_or_die(spark, table, monkeypatch):
    one = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    stale = table.manifest()
    table.append(one)
    with monkeypatch.context() as m, pytest.raises(VersionConflict):
        m.setattr(BucketTable, "manifest", lambda self, version=None: stale)
        table.append(one)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(BucketTable, "_commit", lambda self, new: (_ for _ in ()).throw(RuntimeError("died")))
        table.append(one)
    assert table.read().where("k = 'x'").count() == 1


def test_a_stream_that_repeats_its_batch(spark, tmp_path, table):
    """The stream's own record of its last batch is lost, as if it had died after writing: it runs the batch again."""
    source = tmp_path / "in"
    log = BucketTable.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "log"), ["k"], 4)

    def run(sink, name):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()

    def lose_last(name):
        commits = sorted((p for p in (tmp_path / name / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        commits[-1].unlink()
        (tmp_path / name / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)

    for part in range(3):
        spark.createDataFrame([(f"k{n}", 100 * part + n, part) for n in range(5)], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    for name, sink, t in (("a", appending(log, "s"), log), ("f", folding(table, "s", FOLD), table)):
        run(sink, name)
        first = sorted(map(tuple, t.read().collect()))
        versions = t.versions()
        lose_last(name)
        run(sink, name)
        assert sorted(map(tuple, t.read().collect())) == first and t.versions() == versions
    assert log.read().count() == 15 and rows_of(table)["k4"] == 204
