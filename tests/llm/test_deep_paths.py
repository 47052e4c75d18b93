"""Bad branches far down the path."""

from broadsheet.llm import url_filters


def test_a_bad_branch_begins_at_the_sixth_segment(spark):
    rows = [(f"http://h.org/2024/03/12/en/{kind}/sub/{i}", int(kind == "bad")) for kind in ("bad", "good") for i in range(60)]
    rows += [(f"http://h.org/a/b/c/d/e/{kind}/{i}/{i}/{i}/x", int(kind == "bad")) for kind in ("bad", "good") for i in range(60)]
    found = url_filters.judge(spark.createDataFrame(rows, "url string, bad int"), []).collect()
    assert len(found) == len(rows)
    assert all(r.verdict == ("block" if r.bad else "allow") for r in found)
    assert len({r.template for r in found}) == 4
