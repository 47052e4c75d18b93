import os
from contextlib import contextmanager
from dataclasses import replace

import pytest

from broadsheet import session
from broadsheet.operators import gold
from broadsheet.operators.profiles import train_profiles
from broadsheet.plans import inputs, medallion
from broadsheet.schema import PAGE, SILVER
from broadsheet.sources import snapshots
from broadsheet.sources.readers import read_bronze, read_silver
from broadsheet.sources.writers import FileWarehouse


@pytest.fixture()
def lake(tmp_path):
    return medallion.Lake(str(tmp_path / "bronze"), str(tmp_path / "silver"), FileWarehouse(str(tmp_path / "gold")))


@pytest.fixture(scope="module")
def profiles(spark):
    labelled = spark.createDataFrame([("en", "the town and the river"), ("fr", "la ville et la rivière")], "lang string, text string")
    return train_profiles(labelled)


@pytest.fixture()
def pages(spark):
    cards = "".join(f"<div class='card'><h3>The town number {i}</h3><a href='/{i}'>m</a></div>" for i in range(8))
    headings = "<a href='/n'><h3>The river and the town</h3></a><h3>x</h3><h3></h3>"
    return spark.createDataFrame(
        [(1, "https://en.hespress.com/", cards), (2, "https://www.bbc.com/news", headings), (3, "https://www.aljazeera.com/", "")],
        PAGE,
    )


def gold_tables(spark, lake):
    names = [*gold.GOLD_TABLES, gold.KEYWORD_TABLE]
    return {name: sorted(map(tuple, lake.warehouse.load(spark, name).collect()), key=str) for name in names}


def test_chain(spark, lake, pages, profiles):
    report = medallion.run(spark, pages, profiles, lake)
    assert report["extract"] == {"failed_pages": 0, "total": 10, "Al Jazeera": 0, "BBC News": 2, "Hespress": 8}
    # The heading "x" makes content of 24 characters, which is too short.
    assert report["clean"] == {"loaded": 10, "accepted": 9, "rejected": 1}
    silver = read_silver(spark, lake.silver)
    assert silver.columns == SILVER.fieldNames() and silver.count() == 9
    tables = gold_tables(spark, lake)
    assert report["aggregate"] == {name: len(rows) for name, rows in tables.items()}
    assert tables["gold_articles_per_source"] == [("BBC News", 1), ("Hespress", 8)]
    assert tables["gold_articles_per_country"] == [("International", 1), ("Maroc", 8)]
    assert tables["gold_articles_per_category"] == [("General", 8), ("News", 1)]
    assert tables["gold_top_keywords"] == [("number", 8), ("river", 1), ("town", 9)]
    for name in gold.GOLD_TABLES:
        assert sum(count for _, count in tables[name]) == 9


def test_bronze_grows_and_the_rest_is_rebuilt(spark, lake, pages, profiles):
    medallion.run(spark, pages, profiles, lake)
    first = gold_tables(spark, lake)
    medallion.run_clean(spark, lake.bronze, lake.silver, inputs.load_model(profiles))
    medallion.run_aggregate(spark, lake.silver, lake.warehouse)
    assert gold_tables(spark, lake) == first
    medallion.run(spark, pages, profiles, lake)
    assert read_bronze(spark, lake.bronze).count() == 20
    assert gold_tables(spark, lake)["gold_articles_per_source"] == [("BBC News", 2), ("Hespress", 16)]


def test_missing_layers_stop_cleanly(spark, lake, profiles, tmp_path):
    assert medallion.run_clean(spark, lake.bronze, lake.silver, inputs.load_model(profiles)) is None
    assert medallion.run_aggregate(spark, lake.silver, lake.warehouse) is None
    assert not any(tmp_path.iterdir())


def test_dashboard_views_over_stored_tables(spark, lake, pages, profiles):
    medallion.run(spark, pages, profiles, lake)
    names = [*gold.GOLD_TABLES, gold.KEYWORD_TABLE]
    views = gold.register_dashboard_views(spark, {name: lake.warehouse.load(spark, name) for name in names})
    assert len(views) == 5
    assert [tuple(row) for row in spark.table("dashboard_sources").collect()] == [("Hespress", 8), ("BBC News", 1)]
    shares = spark.sql("SELECT country, share FROM dashboard_country_share").collect()
    assert [tuple(row) for row in shares] == [("Maroc", 0.888889), ("International", 0.111111)]
    assert spark.table("dashboard_keywords").first().word == "town"


def test_unmatched_hosts_are_reported(spark, lake, pages, profiles):
    more = [(10, "https://moved.example/", "<h3>x</h3>"), (11, "https://moved.example/2", ""), (12, None, "<h3>x</h3>")]
    report = medallion.run(spark, pages.union(spark.createDataFrame(more, PAGE)), profiles, lake)["extract"]
    assert report["total"] == 10
    assert (report["unmatched_pages"], report["unmatched_hosts"]) == (3, {"moved.example": 2, None: 1})


def test_broken_bronze_lines_are_set_apart(spark, lake, pages, profiles, tmp_path):
    """Loaded lines are good ones and broken ones; a later run without broken lines empties the table."""
    lake = replace(lake, quarantine=str(tmp_path / "quarantine"))
    medallion.run_extract(pages, lake.bronze)
    broken = ['{"id": "x", "title": ', "no record at all", '{"id": 7} trailing {']
    odd = tmp_path / "bronze" / "odd.json"
    odd.write_text("\n".join([*broken, '{"id": "fine"}', ""]), encoding="utf-8")
    report = medallion.run_clean(spark, lake.bronze, lake.silver, inputs.load_model(profiles), lake.quarantine)
    assert report["loaded"] == 10 + len(broken[:2]) + 2 and report["broken"] in (2, 3)
    kept = snapshots.read(spark, lake.quarantine).collect()
    assert {row.line for row in kept} >= set(broken[:2]) and len(kept) == report["broken"]
    assert all(row.file.endswith("/odd.json") for row in kept)
    assert read_silver(spark, lake.silver).count() == report["accepted"] == 9
    odd.unlink()
    assert "broken" not in medallion.run_clean(spark, lake.bronze, lake.silver, inputs.load_model(profiles), lake.quarantine)
    assert snapshots.read(spark, lake.quarantine).count() == 0


def test_staged_counts_are_removed(spark, lake, pages, profiles, monkeypatch):
    made = []
    monkeypatch.setattr(medallion, "scratch", lambda *a: made.append(session.scratch_path(*a)) or contextmanager(_given)(spark, made[-1]))
    medallion.run(spark, pages, profiles, lake)
    assert len(made) == 1 and not os.path.exists(made[0])


def _given(spark, path):
    try:
        yield path
        assert os.path.exists(path)
    finally:
        session.remove(spark, path)
