"""Similar papers: words are counted in the tasks of one scan, which the text join leaves spread."""

from papyra import fixtures as fx
from papyra.operators import reports


def test_shares_of_odd_texts(spark):
    rows = [("p", "A b", "c d\x1cE d"), ("x", "a", "B C  f"), ("y", None, "e"), ("z", "", None), ("w", "zz", "a b c d e"),
            ("v", "B a", "C d e"), ("u", None, None), (None, "a", "b")]
    papers = spark.createDataFrame(rows, "paper_id string, title string, abstract string")
    found = reports.similar_papers(papers, "p", 4)
    assert [tuple(r) for r in found.collect()] == [("v", 1.0), ("w", 5 / 6), ("x", 3 / 6), ("y", 1 / 5)]
    assert "MapInArrow" in found._jdf.queryExecution().toString()
    assert reports.similar_papers(papers, "none").count() == 0 == reports.similar_papers(papers, "u").count()


def test_papers_stay_spread_when_their_text_comes(spark, small):
    plan = fx.snapshot(spark, small, ("text",))._jdf.queryExecution().toString()
    assert "SortMergeJoin [doc_id" in plan and "BroadcastHashJoin [doc_id" not in plan
