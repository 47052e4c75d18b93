import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from broadsheet.operators.quality import quality_report
from broadsheet.schema import ARTICLE, ARTICLE_FIELDS
from broadsheet.session import scratch_path, spread
from broadsheet.sources import readers
from broadsheet.sources.writers import (
    FileWarehouse,
    JdbcWarehouse,
    append_bronze,
    messages,
    publish,
    replace_silver,
    store_counted,
)


def record(n, **changes):
    return {**{name: f"{name}{n}" for name in ARTICLE_FIELDS}, "content": "c" * 40, **changes}


def test_bronze_union_missing_fields_and_broken_lines(spark, tmp_path):
    full, partial = record(1, title="Été مرحبا"), record(2)
    del partial["country"], partial["category"]
    (tmp_path / "a_1.json").write_text(json.dumps(full, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "notes.txt").write_text("{}")
    (tmp_path / "b_2.json").write_text(json.dumps({**partial, "extra": 1}) + "\n" + '{"id": "x", "title": ', encoding="utf-8")
    df = readers.read_bronze(spark, str(tmp_path))
    assert df.schema == ARTICLE
    rows = {row.id: row.asDict() for row in df.collect()}
    assert rows["id1"] == full
    assert rows["id2"] == {**partial, "country": None, "category": None}
    assert rows[None] == dict.fromkeys(ARTICLE_FIELDS)
    assert quality_report(df).first().asDict() == {"loaded": 3, "accepted": 2, "rejected": 1}


def test_append_bronze_adds(spark, tmp_path):
    path = str(tmp_path / "bronze")
    one = spark.createDataFrame([record(1, title="Été")], ARTICLE)
    append_bronze(one, path)
    append_bronze(one, path)
    assert readers.read_bronze(spark, path).count() == 2
    assert all("Été" in row.value for row in spark.read.text(path).collect())


def test_missing_path_is_no_data_other_errors_raise(spark, tmp_path):
    assert readers.present(lambda: readers.read_bronze(spark, f"{tmp_path}/none")) is None
    assert readers.present(lambda: readers.read_silver(spark, f"{tmp_path}/none")) is None
    empty = tmp_path / "empty"
    empty.mkdir()
    assert readers.present(lambda: readers.read_silver(spark, str(empty))) is None
    (empty / "notes.txt").write_text("no article")
    assert readers.present(lambda: readers.read_bronze(spark, str(empty))) is None
    with pytest.raises(AnalysisException):
        readers.present(lambda: spark.range(1).select("absent"))
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="bad.parquet"):
        readers.present(lambda: readers.read_silver(spark, f"{tmp_path}/bad.parquet"))


def test_replace_silver_replaces(spark, tmp_path):
    path = str(tmp_path / "silver")
    for n in (1, 2):
        replace_silver(spark.createDataFrame([record(n)], ARTICLE), path)
    assert [row.id for row in readers.read_silver(spark, path).collect()] == ["id2"]


def test_pages_reader_prunes(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", "<p>", "x")], "page_id long, url string, html string, other string").write.parquet(path)
    assert readers.read_pages(spark, path).columns == ["page_id", "url", "html"]


def test_messages_roundtrip(spark):
    df = spark.createDataFrame([record(1, title='Été "x"\n'), record(2, country=None)], ARTICLE)
    sent = messages(df)
    assert sent.columns == ["value"]
    value = sent.first().value
    assert json.loads(value) == record(1, title='Été "x"\n') and "Été" in value
    assert readers.decode_messages(sent).collect() == df.collect()
    assert readers.decode_messages(sent.select(F.col("value").cast("binary"))).collect() == df.collect()
    broken = spark.createDataFrame([("{oops",)], "value string")
    assert readers.decode_messages(broken).first().asDict() == dict.fromkeys(ARTICLE_FIELDS)


def test_topics_need_the_connector_and_say_so(spark):
    df = spark.createDataFrame([record(1)], ARTICLE)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish(df, "broker.invalid:9092", "news_events")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        readers.stream_topic(spark, "broker.invalid:9092", "news_events")


def test_file_warehouse_counts_and_replaces(spark, tmp_path):
    warehouse = FileWarehouse(str(tmp_path))
    assert store_counted(spark.range(5), "t", warehouse) == 5
    assert store_counted(spark.range(2), "t", warehouse) == 2
    assert store_counted(spark.range(0), "t", warehouse) == 0
    assert warehouse.load(spark, "t").count() == 0


def test_failed_table_write_raises(spark):
    """No driver for this address is on the class path, so nothing is connected to."""
    warehouse = JdbcWarehouse("jdbc:postgresql://db.invalid/news", {"user": "u", "password": "secret"})
    assert "secret" not in repr(warehouse)
    with pytest.raises(Exception, match="(?i)driver"):
        store_counted(spark.range(1), "gold_articles_per_day", warehouse)


def test_scratch_paths_are_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert base is None or first.startswith(base.rstrip("/"))


def test_spread_moves_small_inputs_only(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 1)
    assert spread(wide) is wide
