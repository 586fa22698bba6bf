"""The lake in shares, whose shuffles are on disk one at a time."""

from papyra import fixtures as fx
from papyra.operators import normalize
from papyra.plans import lake, spread
from papyra.session import freed_shuffles, scratch

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shares_hold_whole_folders(spark):
    rows = spark.createDataFrame([(str(i), None if i % 9 == 0 else str(i % 9)) for i in range(90)], "id string, ds string")
    before, spread.SHARE_ROWS = spread.SHARE_ROWS, 20
    try:
        frames = [f.collect() for f in spread.by_shares(rows, ["ds"], 5)]
        none = spread.by_shares(rows.limit(0), ["ds"], 5)
    finally:
        spread.SHARE_ROWS = before
    assert len(frames) == 5 and max(map(len, frames)) <= 20
    assert sorted(r.id for f in frames for r in f) == sorted(r.id for r in rows.collect())
    days = [{r.ds for r in f} for f in frames]
    assert sum(map(len, days)) == len(set.union(*days)) == 9
    assert [f.count() for f in none] == [0]


def test_lake_in_shares_is_replaced_whole(spark, small):
    papers = normalize.normalize_historical(
        fx.snapshot(spark, small, ("items",)), fx.AS_OF, fx.RUN_TS).filter("year = '1996' and month < '03'")
    path, had = scratch(spark, "lake"), spark.conf.get(FREED)
    before, spread.SHARE_ROWS = spread.SHARE_ROWS, 20
    try:
        n = papers.count()
        assert n > 40
        for replace in ("partitions", "partitions", "all"):
            lake.write_lake(papers, path, replace=replace)
            assert lake.read_lake(spark, path).count() == n
    finally:
        spread.SHARE_ROWS = before
    assert spark.conf.get(FREED) == had
    with freed_shuffles(spark):
        assert spark.conf.get(FREED) == "true"
