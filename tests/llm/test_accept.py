from newsloom.llm import language as lg


def test_lettered_texts_stay_if_no_two_languages_were_learned(spark, small):
    rows = [(1, "some words"), (2, "12 34 !!"), (3, None), (4, "autres mots")]
    for model in (lg.learn(small(rows)), lg.fit([("aa", "some words"), ("bb", "12"), ("cc", "")]), lg.fit([("aa", "some words")])):
        assert sorted(r.doc_id for r in lg.accept(small(rows), model, 0.4).collect()) == [1, 4]
