from newsloom.llm import language as lg


def test_lexicon_counts_whole_texts():
    late = " ".join(["head"] * 2000 + ["tail"] * 50)
    assert {"head", "tail", "other"} <= set(lg.fit([("aa", late), ("bb", "other words")]).lexicon)
