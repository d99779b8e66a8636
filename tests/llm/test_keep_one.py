from newsloom.llm import jaccard_join as jj

TEXT = " ".join(f"word{k}" for k in range(100))
NEAR = TEXT + " more"
OTHER = " ".join(f"other{k}" for k in range(100))


def kept(small, rows):
    out = jj.keep_one(small(rows))
    assert out.columns == small(rows).columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_a_row_without_id_does_not_keep_its_near_copies(spark, small):
    assert kept(small, [(None, TEXT), (1, NEAR), (2, TEXT), (3, OTHER)]) == [(3, OTHER), (None, TEXT)]
    assert len(kept(small, [(None, TEXT), (None, NEAR), (None, OTHER)])) == 2


def test_rows_that_share_the_leaders_id_do_not_all_stay(spark, small):
    assert kept(small, [(1, TEXT), (1, NEAR), (2, NEAR), (1, OTHER)]) == [(1, OTHER), (1, TEXT)]
    assert kept(small, [(1, NEAR), (2, TEXT), (3, OTHER), (4, None), (5, "")]) == [(1, NEAR), (3, OTHER), (4, None), (5, "")]
