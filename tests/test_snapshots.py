"""Tables replaced as a whole while they are read."""

import os
import time

import pytest
from pyspark.sql import functions as F

from broadsheet.session import remove, scratch
from broadsheet.sources import snapshots
from broadsheet.sources.readers import present, read_silver
from broadsheet.sources.writers import FileWarehouse, JdbcWarehouse, replace_silver, store_counted


def ids(df):
    return sorted(row.id for row in df.collect())


def numbered(spark, low, high):
    return spark.range(low, high).repartition(3)


def test_a_reader_keeps_the_rows_it_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(numbered(spark, 0, 5), path)
    opened = snapshots.read(spark, path)
    snapshots.replace(numbered(spark, 5, 9), path)
    assert ids(opened) == [0, 1, 2, 3, 4]
    assert ids(snapshots.read(spark, path)) == [5, 6, 7, 8]


def test_readers_during_a_rewrite_see_the_old_rows(spark, tmp_path):
    """The new version is read half written: while its rows are computed, readers open the table."""
    path = str(tmp_path / "t")
    snapshots.replace(numbered(spark, 0, 5), path)
    seen = []
    publish = snapshots._publish

    def look_first(*arguments):
        seen.append(ids(snapshots.read(spark, path)))
        publish(*arguments)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(snapshots, "_publish", look_first)
        snapshots.replace(numbered(spark, 5, 9), path)
    assert seen == [[0, 1, 2, 3, 4]] and ids(snapshots.read(spark, path)) == [5, 6, 7, 8]


@pytest.mark.parametrize("where", ["rows", "pointer"])
def test_an_aborted_run_leaves_the_old_rows(spark, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    snapshots.replace(numbered(spark, 0, 5), path)
    before = sorted(os.listdir(path))
    bad = numbered(spark, 5, 9)
    if where == "rows":
        bad = bad.select(F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    else:
        monkeypatch.setattr(snapshots, "_publish", lambda *_: (_ for _ in ()).throw(OSError("stop")))
    with pytest.raises(Exception, match="stop"):
        snapshots.replace(bad, path)
    assert ids(snapshots.read(spark, path)) == [0, 1, 2, 3, 4]
    assert sorted(os.listdir(path)) == before


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        snapshots.replace(numbered(spark, n, n + 1), path)
    names = [name for name in os.listdir(path) if name.startswith(snapshots.VERSION)]
    assert sorted(names) == sorted(snapshots.versions(spark, path)) and len(names) == snapshots.KEPT


def test_what_dead_runs_left_goes_after_a_day(spark, tmp_path):
    path = tmp_path / "t"
    snapshots.replace(numbered(spark, 0, 2), str(path))
    old, new = path / f"{snapshots.VERSION}old", path / f"{snapshots.VERSION}new"
    for folder, age in ((old, 25), (new, 1)):
        folder.mkdir()
        (folder / "part-0.parquet").write_text("")
        moment = time.time() - age * 3600
        os.utime(folder, (moment, moment))
    snapshots.replace(numbered(spark, 2, 4), str(path))
    assert not old.exists() and new.exists()
    assert ids(snapshots.read(spark, str(path))) == [2, 3]


def test_a_table_may_be_made_of_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(numbered(spark, 0, 3), path)
    for _ in range(3):
        stored = snapshots.read(spark, path)
        snapshots.replace(stored.union(stored.select(F.col("id") + 100)), path)
    assert snapshots.read(spark, path).count() == 24


def test_plain_folders_are_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "silver")
    numbered(spark, 0, 3).write.parquet(path)
    assert ids(read_silver(spark, path)) == [0, 1, 2]
    replace_silver(numbered(spark, 3, 5), path)
    assert ids(read_silver(spark, path)) == [3, 4]
    replace_silver(numbered(spark, 5, 6), path)
    assert ids(read_silver(spark, path)) == [5]
    assert not [name for name in os.listdir(path) if not name.startswith(("_", "."))]


def test_missing_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not snapshots.present(spark, path) and present(lambda: read_silver(spark, path)) is None
    snapshots.replace(numbered(spark, 0, 1), path)
    assert snapshots.present(spark, path)


def test_gold_tables_are_snapshots(spark, tmp_path):
    warehouse = FileWarehouse(str(tmp_path))
    assert store_counted(spark.range(4), "gold", warehouse) == 4
    opened = warehouse.load(spark, "gold")
    assert store_counted(spark.range(9), "gold", warehouse) == 9
    assert (opened.count(), warehouse.load(spark, "gold").count()) == (4, 9)


def test_scratch_folders_are_removed(spark, tmp_path):
    with pytest.raises(ValueError), scratch(spark, "x") as path:
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
        raise ValueError
    assert not os.path.exists(path)
    remove(spark, path)


def test_a_failed_database_write_leaves_no_copy(spark, monkeypatch):
    """No driver is on the class path; the counted copy is removed all the same."""
    made = []
    from broadsheet.sources import writers

    monkeypatch.setattr(writers, "scratch", lambda *a: made.append(scratch(*a)) or made[-1])
    with pytest.raises(Exception, match="(?i)driver"):
        store_counted(spark.range(2), "t", JdbcWarehouse("jdbc:postgresql://db.invalid/x"))
    assert len(made) == 1


def test_database_writes_are_counted(spark, monkeypatch):
    stored = {}
    monkeypatch.setattr(JdbcWarehouse, "store", lambda self, df, table: stored.update({table: ids(df)}))
    assert store_counted(spark.range(5), "t", JdbcWarehouse("jdbc:none")) == 5
    assert stored == {"t": [0, 1, 2, 3, 4]}
