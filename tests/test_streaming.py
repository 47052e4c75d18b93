import pytest
from pyspark.sql import functions as F

from broadsheet.functions import html
from broadsheet.functions.language import load_model
from broadsheet.operators.extract import STREAM_RULES, read_items, to_articles
from broadsheet.operators.profiles import train_profiles
from broadsheet.operators.silver import to_silver
from broadsheet.plans.medallion import run_clean
from broadsheet.schema import ARTICLE, PAGE
from broadsheet.sources import readers, snapshots
from broadsheet.sources.writers import append_bronze
from broadsheet.streaming import flows
from broadsheet.streaming.progress import CycleLog, read_cycles


@pytest.fixture(scope="module")
def model(spark):
    labelled = spark.createDataFrame([("en", "the town and the river"), ("fr", "la ville et la rivière")], "lang string, text string")
    return load_model(train_profiles(labelled))


def articles(spark, numbers):
    return spark.range(1).select(F.explode(F.array(*map(F.lit, numbers))).alias("n")).select(
        F.col("n").cast("string").alias("id"),
        F.concat(F.lit("<b>Title "), "n", F.lit("</b>")).alias("title"),
        F.lit("a").alias("author"),
        F.when(F.col("n") % 5 != 0, "2024-01-01T00:00:00").alias("published_date"),
        F.lit("News").alias("category"),
        F.concat(F.lit("The town and the river of story number "), "n").alias("content"),
        F.lit("s").alias("source"),
        F.when(F.col("n") % 2 == 0, "MA").alias("country"),
        F.lit("").alias("url"),
    )


def stable(df):
    return sorted(map(tuple, df.drop("processed_at").collect()))


def test_stream_equals_batch_over_two_cycles(spark, model, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / name) for name in ("bronze", "silver", "checkpoint"))
    for numbers in (range(1, 11), range(11, 21)):
        append_bronze(articles(spark, numbers), bronze)
        stream = readers.stream_bronze(spark, bronze)
        flows.start_cleaning(stream, model, silver, checkpoint, once=True).awaitTermination()
    batch = to_silver(readers.read_bronze(spark, bronze), model)
    streamed = readers.read_silver(spark, silver)
    assert stable(streamed) == stable(batch) and streamed.count() == 16


def test_a_restart_sends_nothing_twice(spark, model, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / name) for name in ("bronze", "silver", "checkpoint"))
    append_bronze(articles(spark, range(1, 5)), bronze)
    for _ in range(2):
        flows.start_cleaning(readers.stream_bronze(spark, bronze), model, silver, checkpoint, once=True).awaitTermination()
    assert readers.read_silver(spark, silver).count() == 4


def test_pages_to_messages(spark, tmp_path):
    pages_path, topic, checkpoint = (str(tmp_path / name) for name in ("pages", "topic", "checkpoint"))
    html_cards = "".join(f"<div class='card'><h3>T{i}</h3><a href='/{i}'>m</a></div>" for i in range(5))
    pages = spark.createDataFrame(
        [
            (1, "https://en.hespress.com/", html_cards),
            (2, "https://www.akhbarona.com/", "<h2><a href='/x'>A</a></h2><h2></h2>"),
            (3, "https://www.akhbarona.com/broken", None),
        ],
        PAGE,
    )
    pages.write.parquet(pages_path)
    query = flows.start_publishing(
        flows.ingest(readers.stream_pages(spark, pages_path)), checkpoint, path=topic, once=True
    )
    query.awaitTermination()
    metrics = next(progress.observedMetrics["ingest"] for progress in query.recentProgress if progress.numInputRows)
    assert (metrics.sent, metrics.failed_pages) == (6, 0)
    received = readers.decode_messages(spark.read.text(topic))
    assert received.schema == ARTICLE
    batch = to_articles(read_items(pages, STREAM_RULES))
    shown = ["title", "author", "category", "content", "source", "country", "url"]
    assert sorted(map(tuple, received.select(shown).collect())) == sorted(map(tuple, batch.select(shown).collect()))


def test_the_continuous_form_runs_a_cycle_every_minute(spark, model, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / name) for name in ("bronze", "silver", "checkpoint"))
    append_bronze(articles(spark, range(1, 4)), bronze)
    query = flows.start_cleaning(readers.stream_bronze(spark, bronze), model, silver, checkpoint)
    try:
        query.processAllAvailable()
        assert query.isActive
        assert readers.read_silver(spark, silver).count() == 3
    finally:
        query.stop()
    assert flows.CYCLE == "60 seconds"


def test_batch_and_stream_refuse_to_share_a_silver_folder(spark, model, tmp_path):
    bronze, silver, other, checkpoint = (str(tmp_path / name) for name in ("bronze", "silver", "other", "checkpoint"))
    append_bronze(articles(spark, range(1, 4)), bronze)

    def follow(path):
        flows.start_cleaning(readers.stream_bronze(spark, bronze), model, path, checkpoint, once=True).awaitTermination()

    follow(silver)
    with pytest.raises(ValueError, match="stream job"):
        run_clean(spark, bronze, silver, model)
    append_bronze(articles(spark, range(4, 6)), bronze)
    follow(silver)
    run_clean(spark, bronze, other, model)
    followed = {row.id for row in readers.read_silver(spark, silver).collect()}
    assert followed == {row.id for row in readers.read_silver(spark, other).collect()} != set()
    run_clean(spark, bronze, other, model)
    with pytest.raises(ValueError, match="batch job"):
        follow(other)
    assert readers.read_silver(spark, other).count() == len(followed)


POISON = "<h2>poison</h2>"


def poisoned(monkeypatch):
    """Pages with the poison cannot be read, here and in the workers."""
    read = html._read_items

    def fail(page, rule):
        if POISON in page:
            raise ValueError("cannot be read")
        return read(page, rule)

    monkeypatch.setattr(html, "_read_items", fail)


def arriving(spark, path, numbers):
    pages = [(n, "https://www.akhbarona.com/", f"<h2>Story {n}</h2>") for n in numbers]
    pages += [(n + 100, "https://www.akhbarona.com/bad", f"{POISON}<h2>Lost {n}</h2>") for n in numbers if n % 2]
    pages += [(n + 200, "https://stray.example/" if n % 3 else None, "<h2>x</h2>") for n in numbers]
    spark.createDataFrame(pages, PAGE).coalesce(1).write.mode("append").parquet(path)


def outputs(spark, at):
    sent = sorted(row.title for row in readers.decode_messages(spark.read.text(f"{at}/topic")).collect())
    failed = sorted((row.page_id, row.html, row.error) for row in spark.read.parquet(f"{at}/letters/failed").collect())
    unmatched = spark.read.parquet(f"{at}/letters/unmatched").groupBy("host").agg(F.sum("pages").alias("n")).collect()
    return sent, failed, {row.host: row.n for row in unmatched}


def expected_outputs(numbers):
    failed = [(n + 100, f"{POISON}<h2>Lost {n}</h2>", "ValueError: cannot be read") for n in numbers if n % 2]
    hosts = {"stray.example": sum(n % 3 > 0 for n in numbers), None: sum(n % 3 == 0 for n in numbers)}
    return sorted(f"Story {n}" for n in numbers), failed, {host: n for host, n in hosts.items() if n}


def test_failed_and_unmatched_pages_are_stored_and_counted(spark, tmp_path, monkeypatch):
    poisoned(monkeypatch)
    at, pages = str(tmp_path), str(tmp_path / "pages")
    totals = {"sent": 0, "failed_pages": 0, "unmatched_pages": 0}
    for numbers in (range(1, 6), range(6, 8)):
        arriving(spark, pages, numbers)
        query = flows.start_ingest(readers.stream_pages(spark, pages), f"{at}/offsets", f"{at}/letters", f"{at}/topic", once=True)
        query.awaitTermination()
        metrics = next(p.observedMetrics["ingest"].asDict() for p in query.recentProgress if p.numInputRows)
        totals = {name: totals[name] + metrics[name] for name in totals}
    assert outputs(spark, at) == expected_outputs(range(1, 8))
    assert totals == {"sent": 7, "failed_pages": 4, "unmatched_pages": 7}


@pytest.mark.parametrize("stop_at", [0, 1, 2])
def test_a_cycle_stopped_between_its_writes_is_run_again_whole(spark, tmp_path, monkeypatch, stop_at):
    poisoned(monkeypatch)
    at, pages = str(tmp_path), str(tmp_path / "pages")
    arriving(spark, pages, range(1, 5))
    write, written = flows.replace_cycle, []

    def stopping(df, path, cycle, *form):
        write(df, path, cycle, *form)
        written.append(path)
        if len(written) == stop_at + 1:
            raise OSError("stopped here")

    def run():
        flows.start_ingest(readers.stream_pages(spark, pages), f"{at}/offsets", f"{at}/letters", f"{at}/topic", once=True).awaitTermination()

    monkeypatch.setattr(flows, "replace_cycle", stopping)
    with pytest.raises(Exception, match="stopped here"):
        run()
    monkeypatch.setattr(flows, "replace_cycle", write)
    arriving(spark, pages, range(5, 8))
    run()
    assert outputs(spark, at) == expected_outputs(range(1, 8))


def test_a_backlog_is_worked_off_in_bounded_cycles(spark, tmp_path):
    at, bronze = str(tmp_path), str(tmp_path / "bronze")
    for n in range(6):
        append_bronze(articles(spark, range(10 * n, 10 * n + 5)).coalesce(1), bronze)
    model_free = readers.stream_bronze(spark, bronze, files_per_cycle=2)
    with CycleLog(spark, f"{at}/cycles"):
        flows.start_publishing(model_free, f"{at}/offsets", path=f"{at}/topic", once=True).awaitTermination()
    cycles = read_cycles(spark, f"{at}/cycles").collect()
    assert sorted((row.cycle, row.rows) for row in cycles) == [(0, 10), (1, 10), (2, 10)]
    assert spark.read.text(f"{at}/topic").count() == 30


def test_cycles_are_stored_once_each(spark, tmp_path):
    at, pages = str(tmp_path), str(tmp_path / "pages")
    arriving(spark, pages, range(1, 5))
    log = CycleLog(spark, f"{at}/cycles")
    with log:
        flows.start_publishing(flows.ingest(readers.stream_pages(spark, pages)), f"{at}/offsets", path=f"{at}/topic", once=True).awaitTermination()
    rows = read_cycles(spark, f"{at}/cycles").collect()
    assert len(rows) == 1 and rows[0].rows == 10
    assert rows[0].counts == {"sent": 8, "failed_pages": 0, "unmatched_pages": 4}


def day_of(spark, path, days):
    rows = [tuple({"id": str(i), "published_date": day and f"{day}T09:00:00"}.get(name) for name in ARTICLE.fieldNames()) for i, day in enumerate(days)]
    append_bronze(spark.createDataFrame(rows, ARTICLE).coalesce(1), path)


def test_daily_counts_equal_the_batch_and_late_articles_are_counted(spark, tmp_path):
    at, bronze = str(tmp_path), str(tmp_path / "bronze")
    cycles = [
        ["2024-01-01", "2024-01-01", "2024-01-02", None, "garbage"],
        ["2024-01-02", "2024-01-05", None],
        ["2024-01-05", "2024-01-04", "2024-01-01", "2024-01-02"],  # the last two lie behind 5 January less two days
    ]
    with CycleLog(spark, f"{at}/cycles"):
        for days in cycles:
            day_of(spark, bronze, days)
            stream = readers.stream_bronze(spark, bronze)
            flows.start_daily_counts(stream, f"{at}/table", f"{at}/offsets", once=True).awaitTermination()
    got = {str(row.publish_day): row.article_count for row in snapshots.read(spark, f"{at}/table").collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-04": 1, "2024-01-05": 2, "None": 3}
    assert sum(row.late for row in read_cycles(spark, f"{at}/cycles").collect()) == 2
    assert sum(got.values()) + 2 == sum(map(len, cycles))


def test_daily_counts_survive_a_stop_before_the_commit(spark, tmp_path, monkeypatch):
    at, bronze = str(tmp_path), str(tmp_path / "bronze")
    day_of(spark, bronze, ["2024-01-01", "2024-01-02"])

    def run():
        flows.start_daily_counts(readers.stream_bronze(spark, bronze), f"{at}/table", f"{at}/offsets", once=True).awaitTermination()

    run()
    day_of(spark, bronze, ["2024-01-02", "2024-01-03"])
    replace = snapshots.replace

    def stopping(df, root):
        replace(df, root)
        raise OSError("stopped here")

    monkeypatch.setattr(snapshots, "replace", stopping)
    with pytest.raises(Exception, match="stopped here"):
        run()
    monkeypatch.setattr(snapshots, "replace", replace)
    run()
    got = {str(row.publish_day): row.article_count for row in snapshots.read(spark, f"{at}/table").collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}


def test_a_joined_model_cleans_a_stream_too(spark, tmp_path):
    labelled = spark.createDataFrame([("en", "the town and the river"), ("fr", "la ville et la rivière")], "lang string, text string")
    profiles = train_profiles(labelled)
    whole, parted = load_model(profiles), load_model(profiles, 5)
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for numbers in (range(1, 7), range(7, 11)):
        append_bronze(articles(spark, numbers), bronze)
        stream = readers.stream_bronze(spark, bronze)
        flows.start_cleaning(stream, parted, silver, str(tmp_path / "offsets"), once=True).awaitTermination()
    batch = to_silver(readers.read_bronze(spark, bronze), whole)
    assert stable(readers.read_silver(spark, silver).select(*batch.columns)) == stable(batch)


def test_a_cycle_of_one_file_is_read_by_many_tasks(spark, tmp_path):
    pages = [(n, "https://en.hespress.com/", f'<div class="card"><h3>title {n}</h3></div>') for n in range(64)]
    spark.createDataFrame(pages, PAGE).coalesce(1).write.parquet(f"{tmp_path}/pages")
    tasks = []

    def cycle(batch, number):
        tasks.append({row[0] for row in batch.select(F.spark_partition_id()).collect()})

    stream = readers.stream_pages(spark, f"{tmp_path}/pages", files_per_cycle=1)
    items = read_items(stream, STREAM_RULES)
    items.writeStream.foreachBatch(cycle).option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination()
    assert [len(found) for found in tasks] == [spark.sparkContext.defaultParallelism]
