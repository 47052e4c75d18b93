"""Items with a null id have windows like others: the query against its SQL on made-up tables."""

import duckdb

from broadsheet.llm import decontamination
from broadsheet.llm.oracles import OP6
from oracle_compare import differences

ITEMS = [
    (None, "one two three four five six seven eight nine ten eleven"),
    (None, "short one"),
    (5, "five six seven eight nine ten eleven twelve thirteen fourteen"),
    (5, "other words of item five"),
    (40, "short one"),
    (6, None),
]
DOCS = [
    (1, "x One two three four five six seven eight nine TEN y"),
    (2, "a short one, five six seven eight nine ten eleven twelve thirteen fourteen"),
    (3, "other words of item five"),
    (4, None),
    (5, "clean"),
]


def test_null_ids_equal_the_sql(spark):
    connection = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", DOCS), ("benchmark", "item_id", ITEMS)):
        connection.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        connection.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert differences(decontamination.digest(docs, items), connection, OP6) == []


def test_null_ids_in_several_automata(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, decontamination.digest(docs, items).collect()))
    monkeypatch.setattr(decontamination, "MAX_WORDS", 8)
    assert sorted(map(tuple, decontamination.digest(docs, items).collect())) == whole
