from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import archive as J
from newsloom.plans import queries as plans

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_merge_keeps_every_document_and_its_whole_text(spark):
    docs = documents(spark)
    got = {r.key: r for r in plans.queries()["archive_merge_whole"](spark, SF).collect()}
    assert set(got) == set(docs)
    assert all((got[i].body or "").startswith(r.text or "") for i, r in docs.items())
    assert {"added", "kept", "body", "date", "body and date"} == {r.change for r in got.values()}


def test_backfill_is_cut_by_the_operators_bound_only(spark):
    docs = documents(spark)
    got = {r.key: r.body or "" for r in plans.queries()["backfill_bodies_whole"](spark, SF).collect()}
    assert set(got) == set(docs)
    assert all(len(got[i]) == min(J.BODY_CHARS, len(f"{r.source}\n{r.text}")) for i, r in docs.items() if i % 3 == 0 and r.text is not None)
    long = [i for i, r in docs.items() if len(r.text or "") > J.BODY_CHARS]
    assert any(i % 3 == 0 for i in long) and all(got[i] == docs[i].text for i in long if i % 3)


def test_prompt_has_the_whole_title_and_2400_characters(spark):
    rows = [(" " + "t" * 300 + " ", "src", None, "b  " * 2000), ("x", None, "short", "body"), (None, "", "", "")]
    df = spark.createDataFrame(rows, "title string, source string, summary string, body string")
    got = [r.p for r in df.select(T.judge_prompt(*map(F.col, df.columns)).alias("p")).collect()]
    assert got == ["Titre : " + "t" * 300 + "\nSource : src\nTexte : " + ("b  " * 2000)[:2400], "Titre : x\nTexte : short", "Titre : "]
    assert set(documents(spark)) == {r.doc_id for r in plans.queries()["judge_prompt_whole"](spark, SF).collect()}
