"""Lines of few words take part in line dedup."""

import corpus_pipeline
from broadsheet.llm import line_dedup

SF_DIR = "/root/testdata/sf0.001"


def test_every_line_takes_part(spark):
    long = "".join(chr(0x4E00 + 7 * i) for i in range(80))
    rows = [
        (1, f"x y\n\n{long}\nChapter one and two"),
        (2, f"X  y\n\nnew\n{long[:79]}一\nz"),
        (3, "z\nz\nother"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup_lines(docs, every=True).collect()}
    assert found == {1: (rows[0][1], 0), 2: ("\nnew\nz", 2), 3: ("other", 2)}


def test_a_copy_with_a_short_line_leaves_the_pipeline(spark):
    text = "Short title\n\nthis line has quite a few words in it\nend\n"
    rows = [(1, text, "s"), (2, text, "s"), (3, text + "more", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, SF_DIR).collect()}
    assert left == {1: text, 3: "\nmore"}
