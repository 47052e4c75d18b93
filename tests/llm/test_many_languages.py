"""Every labelled language is learnt, also where they or their windows are many."""

import random

from broadsheet.llm import language_id


def documents(spark, langs, each):
    rng = random.Random(7)
    rows = []
    for k in range(langs):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(30)]
        rows += [(" ".join(rng.choice(words) for _ in range(40)), f"l{k:03}") for _ in range(each)]
    return spark.createDataFrame(rows, "text string, lang string"), rows


def test_more_than_64_languages_are_learnt(spark):
    docs, rows = documents(spark, 80, 6)
    docs = docs.union(spark.createDataFrame([("zyx wvu tsr " * 9, "single")], "text string, lang string"))
    model = language_id.fit(docs)
    assert model.value["langs"] == sorted({lang for _, lang in rows} | {"single"})
    found = docs.select("lang", language_id.identify(docs["text"], model)["lang_pred"].alias("p")).collect()
    assert sum(r.lang == r.p for r in found) >= 0.99 * len(found)


def test_too_many_windows_make_the_sample_smaller(spark, monkeypatch):
    docs, rows = documents(spark, 5, 60)
    monkeypatch.setattr(language_id, "MAX_WINDOWS", 2000)
    model = language_id.fit(docs)
    assert model.value["langs"] == sorted({lang for _, lang in rows})
    monkeypatch.setattr(language_id, "MAX_WINDOWS", 1)
    assert language_id.fit(docs).value["langs"] == sorted({lang for _, lang in rows})
