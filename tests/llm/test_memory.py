"""What bounds the memory of an executor and its Python workers."""

import pyarrow as pa

from broadsheet.llm import decontamination, tables


def test_a_batch_of_wide_rows_is_bounded_by_its_bytes(spark):
    tables.Workspace(spark, "wide")
    assert spark.conf.get(tables.BATCH_SETTING) == str(tables.BATCH_ROWS)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 60, 1, 1).selectExpr("CAST(repeat('x', 1000000) AS binary) AS entries")
    found = [row.n for row in wide.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 60_000_000 and max(found) <= tables.BATCH_BYTES + 2_000_000


def test_texts_are_scanned_once(spark):
    passage = " ".join(f"word{n}" for n in range(20))
    docs = spark.createDataFrame([(1, f"a b {passage} c " + "d " * 60), (2, passage), (3, None), (4, "x y")], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    clean = decontamination.decontaminate(docs, items)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("scan_texts(") == 1
    assert {row.doc_id for row in clean.collect()} == {1, 3, 4}
