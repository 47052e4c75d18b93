"""Valid values beside other digits."""

from broadsheet.llm import pii


def test_valid_values_beside_other_digits_are_replaced(spark):
    card = "4111 1111 1111 1111"
    texts = [
        card,
        f"{card} 123",
        "4111111111111111 12/27",
        f"3 {card}",
        f"1234 {card}",
        f"{card} 12/27",
        "+45 12 34 56 78",
        "+45 12 34 56 78 in 1999",
        "+1 " + card,
        "4111 1111 1111 1112 123",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = pii.pseudonymise(docs, "secret")
    new = {r.doc_id: r.text for r in made.collect()}
    assert new[0] != card and new[1] == f"{new[0]} 123" and new[2] == new[0].replace(" ", "") + " 12/27"
    assert new[3] == f"3 {new[0]}" and new[4] == f"1234 {new[0]}" and new[5] == f"{new[0]} 12/27"
    assert new[6] != texts[6] and new[7] == new[6] + " in 1999" and new[8] == "+1 " + new[0] and new[9] == texts[9]
    two = spark.createDataFrame([(1, card + " 5500 0000 0000 0004")], "doc_id long, text string")
    assert pii.pseudonymise(two, "secret").first().n_replaced == 2
    back = pii.pseudonymise(made.drop("n_replaced"), "secret", back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
