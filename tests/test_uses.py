"""Network, recommendation, drift, as-of figures, sessions, name search, harvest quarantine and stream pairing."""

import gzip
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from papyra import fixtures as fx
from papyra.operators import drift, lookups, network, normalize, recommend, reports, search_index
from papyra.plans import historical, incremental, state
from papyra.session import scratch
from papyra.sources import oai
from papyra.streaming import jobs
from papyra.streaming import pairing as stream_pairs
from papyra.streaming.progress import ProgressLog
from tests.test_jobs import HISTORY, META, ids


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# ---- network ------------------------------------------------------------------------------

def random_network(rng, papers, authors):
    rows = set()
    for p in range(papers):
        for a in rng.sample(range(authors), rng.choice([1, 1, 2, 3])):
            rows.add((f"m{p % 3}", f"p{p}", f"a{a:04}"))
    # one paper of many authors, and a chain that joins its ends only step by step
    rows |= {("m0", "crowd", f"a{a:04}") for a in range(0, authors, 9)}
    for i in range(60):
        rows |= {("m1", f"c{i}", f"x{i:03}"), ("m1", f"c{i}", f"x{i + 1:03}")}
    return sorted(rows)


def test_components_equal_union_find(spark):
    rows = random_network(random.Random(1), 120, 200)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    papers = defaultdict(list)
    for period, paper, author in rows:
        papers[period, paper].append((period, author))
    for authors in papers.values():
        for a in authors:
            x, y = sorted((find(a), find(authors[0])))
            parent[y] = x
    label = {node: min(n for n in parent if find(n) == find(node)) for node in list(parent)}
    size = Counter(label.values())
    frame = spark.createDataFrame(rows + rows[:5], "period string, paper_id string, author_id string")
    got = {tuple(r) for r in network.components(frame).collect()}
    assert got == {(p, a, label[p, a][1], size[label[p, a]]) for p, a in label}


def test_rank_equals_the_pairwise_definition(spark):
    rows = random_network(random.Random(2), 60, 50)
    weight, rank = defaultdict(lambda: defaultdict(int)), {}
    papers = defaultdict(set)
    for period, paper, author in rows:
        papers[period, paper].add((period, author))
        rank[period, author] = 1.0
    for authors in papers.values():
        for a in authors:
            for b in authors - {a}:
                weight[a][b] += 1
    for _ in range(4):
        gets = defaultdict(float)
        for a, others in weight.items():
            for b, w in others.items():
                gets[b] += rank[a] * w / sum(others.values())
        rank = {a: 0.15 + 0.85 * gets[a] for a in rank}
    frame = spark.createDataFrame(rows, "period string, paper_id string, author_id string")
    got = network.rank(frame, iterations=4)
    for r in got.collect():
        assert math.isclose(r["rank"], rank[r.period, r.author_id], rel_tol=1e-9)
    assert got.count() == len(rank)


def test_no_pairs_and_no_authors(spark):
    papers = spark.createDataFrame([("1", []), ("2", None)], "paper_id string, authors array<struct<last_name:string,first_name:string>>")
    rows = network.incidence(papers)
    assert network.components(rows).count() == 0 and network.rank(rows).count() == 0


# ---- recommendation -----------------------------------------------------------------------

def nearest(texts, wanted, k):
    bags = {i: Counter(t.lower().split()) for i, t in texts.items() if t.split()}
    df = Counter(w for b in bags.values() for w in b)
    vectors = {}
    for i, bag in bags.items():
        v = {w: n * math.log((len(bags) + 1) / (df[w] + 1)) for w, n in bag.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        vectors[i] = {w: x / length for w, x in v.items()} if length else {}
    out = {}
    for i in wanted:
        if i in vectors:
            scored = []
            for j, v in vectors.items():
                if j != i:
                    score = 1.0 if bags[i] == bags[j] else round(sum(x * v.get(w, 0.0) for w, x in vectors[i].items()), 6)
                    scored.append((-score, j))
            out[i] = sorted(scored)[:k]
    return out


def test_recommendations_have_exact_scores_and_high_recall(spark, small):
    papers = normalize.normalize_historical(fx.snapshot(spark, small, ("text", "items")), fx.AS_OF, fx.RUN_TS)
    texts = {r.paper_id: f"{r.title} {r.abstract}" for r in papers.select("paper_id", "title", "abstract").collect()}
    wanted = [i for i in texts if int(i) % 20 == 0]
    want = nearest(texts, wanted, 5)
    got = defaultdict(list)
    for r in recommend.recommend_papers(papers, F.col("paper_id").cast("long") % 20 == 0).orderBy("paper_id", "position").collect():
        got[r.paper_id].append((-r.score, r.neighbour))
    full = {i: dict((j, s) for s, j in nearest({i: texts[i], **texts}, [i], len(texts))[i]) for i in list(want)[:10]}
    for i, scores in full.items():
        for s, j in got[i]:
            assert math.isclose(scores[j], s, abs_tol=2e-6)
    hits = sum(s <= want[i][-1][0] + 2e-6 for i in want for s, _ in got[i])
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(len(v) <= 5 and len({j for _, j in v}) == len(v) for v in got.values())


def test_recommendations_of_odd_papers(spark):
    texts = ["", None, "   ", "one", "one", "one two", "ONE two", "two one", "three"] + ["crowd of words"] * 30
    papers = spark.createDataFrame([(f"{i:03}", t, None, 1) for i, t in enumerate(texts)], "paper_id string, title string, abstract string, score int")
    got = recommend.recommend_papers(papers, F.lit(True))
    found = defaultdict(list)
    for r in got.orderBy("paper_id", "position").collect():
        found[r.paper_id].append(r.neighbour)
    assert not {"000", "001", "002"} & set(found)
    assert found["003"][0] == "004" and found["005"][:2] == ["006", "007"] and found["012"] == ["009", "010", "011", "013", "014"]
    assert not any(word in plan_of(got) for word in ("Cartesian", "NestedLoop"))
    assert recommend.recommend_papers(papers, F.lit(False)).count() == 0


def test_crowded_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(recommend, "BUCKET", 3)
    papers = spark.createDataFrame([(f"{i:03}", f"common words here {i % 50} x{i % 50}", None) for i in range(100)], "paper_id string, title string, abstract string")
    got = recommend.recommend_papers(papers, F.col("paper_id") == "007").collect()
    assert got[0].neighbour == "057" and got[0].score == 1.0


# ---- drift --------------------------------------------------------------------------------

def test_share_drift(spark):
    rows = [("1", "a", 5), ("1", "b", 5), ("2", "a", 50), ("2", "b", 50), ("3", "c", 7), ("4", "c", 1), ("4", "d", 1)]
    counts = spark.createDataFrame(rows, "run string, category string, papers long")
    got = {r.run: r for r in drift.share_drift(counts, 0.5).collect()}
    assert got["1"].divergence is None and got["2"].divergence == 0.0
    assert math.isclose(got["3"].divergence, math.log(2)) and got["3"].alert
    want = (math.log(2 / 1.5) + 0.5 * math.log(2 * 0.5 / 1.5) + 0.5 * math.log(2)) / 2
    assert math.isclose(got["4"].divergence, want) and not got["4"].alert and got["4"].before == "3"


def test_sketches_merge_within_their_bounds(spark):
    papers = spark.range(60000).select(
        (F.col("id") % 6).cast("string").alias("run"), F.repeat(F.lit("x"), (F.col("id") % 1000).cast("int")).alias("abstract"),
        F.array(F.struct((F.col("id") % 20000).cast("string").alias("last_name"), F.lit("f").alias("first_name"))).alias("authors"))
    profiles = drift.sketches(papers, F.col("run"))
    all_ = drift.estimates(drift.merged(profiles, F.lit("all"))).first()
    assert all_.papers == 60000 and abs(all_.authors - 20000) < 0.05 * 20000
    assert abs(all_["median"] - 500) < 30 and abs(all_.p90 - 900) < 30


# ---- journals and sessions ----------------------------------------------------------------

def test_impact_as_of(spark):
    papers = spark.createDataFrame(
        [(1, "J. X 3", "2000-06-01"), (2, "J. X 4", "2001-01-01"), (3, "J. X", "1999-12-31"), (4, "J. Y", "2005-01-01"),
         (5, "", "2005-01-01"), (6, None, "2005-01-01"), (7, "J. X", None), (8, "J. X 9", "2010-01-01")],
        "paper_id int, journal_ref string, day string").withColumn("day", F.to_date("day")).withColumn("impact_factor", F.lit(0))
    journals = spark.createDataFrame(
        [("j x", "2000-01-01", 1.0), ("J. X", "2001-01-01", 2.0), ("J.X.", "2001-01-01", 3.0), ("j x", None, 9.0), ("j x", "2008-01-01", None)],
        "journal string, day string, impact double").withColumn("day", F.to_date("day"))
    for rows_per_task in (1, 1000):
        got = reports.enrich_with_journals_asof(papers, journals, F.col("day"), rows_per_task)
        assert {r.paper_id: r.impact for r in got.collect()} == {
            1: 1.0, 2: 3.0, 3: None, 4: None, 5: None, 6: None, 7: None, 8: None}
        assert "NestedLoop" not in plan_of(got) and got.columns == [*papers.columns, "impact", "impact_day"]


def test_sessions_end_after_the_gap(spark):
    rows = [(1, "2024-01-01 00:00:00", 7, "a"), (1, "2024-01-01 00:00:00", 7, "a"), (2, "2024-01-01 00:29:59", 7, "b"),
            (3, "2024-01-01 01:30:00", 7, "a"), (5, "2024-01-01 02:00:00", 7, "a"), (4, "2024-01-01 00:10:00", 8, "a")]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string")
    got = sorted((r.user_id, str(r.session_start), r.events, r.kinds) for r in reports.behaviour_sessions(events).collect())
    assert got == [(7, "2024-01-01 00:00:00", 2, "a,b"), (7, "2024-01-01 01:30:00", 2, "a"), (8, "2024-01-01 00:10:00", 1, "a")]


# ---- search -------------------------------------------------------------------------------

def test_indexed_search_finds_what_the_scan_finds(spark):
    names = [("Curie", "Marie"), ("Böhr", None), ("Ab", "Li"), ("Marie-Curie", "X"), (None, "curIE"), ("a%b_c", "\\")]
    papers = spark.createDataFrame(
        [(f"{i:03}", [names[i % 6], names[(i * 5 + 1) % 6]] if i % 7 else None) for i in range(60)],
        "paper_id string, authors array<struct<last_name:string,first_name:string>>")
    path = scratch(spark, "grams")
    search_index.write_index(papers, path, parts=8)
    for needle in ("curie", "CUR", "rie-c", "öhr", "ab", "", "nobody", "%b_", "arie", "curiex"):
        assert ids(search_index.search(papers, path, needle, 1000, 8)) == ids(lookups.papers_by_author(papers, needle, 1000)), needle
    plan = search_index.candidates(spark, path, "curie", 8)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [part" in plan
    assert "PushedFilters: [In(gram" in plan


# ---- harvest ------------------------------------------------------------------------------

GOOD = "<record><header><identifier>oai:%d</identifier><datestamp>2024-01-0%d</datestamp></header><metadata><arXiv><id>%d</id></arXiv></metadata></record>"


def test_a_damaged_record_takes_no_other_with_it(spark, tmp_path):
    bad = "<record><header><identifier>oai:9</identifier></header><metadata><arXiv><id>9</metadata></record>"
    other = GOOD.replace("arXiv>", "oai_dc>") % (3, 3, 3)
    undated = (GOOD % (4, 4, 4)).replace("2024-01-04", "")
    tail = "<record><header><identifier>oai:8</identifier><datestamp>2024"
    (tmp_path / "r.xml").write_text("<ListRecords>\n" + "\n".join(
        [GOOD % (1, 1, 1), bad, GOOD % (2, 2, 2), other, undated, "<record><header>" + GOOD % (5, 5, 5)]) + "</ListRecords>\n" + tail)
    (tmp_path / "empty.xml").write_text("")
    responses = oai.read_responses(spark, str(tmp_path))
    held = {r.reason: r.text for r in oai.quarantine(responses).filter("reason <> 'malformed'").collect()}
    assert held == {"unknown_format": other, "missing_datestamp": undated}
    broken = sorted(r.text for r in oai.quarantine(responses).filter("reason = 'malformed'").collect())
    assert broken == sorted([bad, "<record><header></record>", tail + "</record>"])
    assert sorted(r.id for r in oai.harvested(responses).collect()) == ["1", "2", "4", "5"]
    counts = oai.harvest_counts(responses).first().asDict()
    assert counts.pop("responses") == sum(counts.values()) == 8


# ---- files and streams --------------------------------------------------------------------

def test_files_and_failed_files_are_counted(spark, small, tmp_path):
    good = [r.value for r in fx.snapshot_lines(spark, small).limit(3).collect()]
    (tmp_path / "a b.txt").write_text("\n".join(good[:2]))
    (tmp_path / "c.txt").write_text('{"id": \n' + good[2])
    (tmp_path / "bad.txt").write_text('{"id": ')
    (tmp_path / "none.txt").write_text("")
    (tmp_path / "blank.txt").write_text("\n \n")
    (tmp_path / "no.txt.gz").write_bytes(b"no gzip")
    (tmp_path / "yes.txt.gz").write_bytes(gzip.compress(good[0].encode()))
    metrics = scratch(spark, "m")
    with pytest.raises(Exception):
        historical.load_snapshot(spark, str(tmp_path), scratch(spark, "l"), fx.AS_OF, fx.RUN_TS)
    historical.load_snapshot(
        spark, str(tmp_path), scratch(spark, "l"), fx.AS_OF, fx.RUN_TS, metrics=metrics, skip_unreadable=True)
    row = spark.read.parquet(metrics).filter("stage = 'extract'").first()
    # the file of blank lines has no record either
    assert (row.files, row.failed_files, row.input) == (7, 3, 6) and row.seconds > 0


def deliver(root, format_name, day, *lines):
    folder = root / format_name / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir())):04}.json").write_text("\n".join(lines))


def test_stream_pairing_goes_on_after_a_restart(spark, tmp_path):
    root, output, checkpoint = tmp_path / "raw", scratch(spark, "pairs"), scratch(spark, "ck")
    log = ProgressLog()
    spark.streams.addListener(log)

    def run():
        stream_pairs.stream_pairing(
            spark, str(root), output, checkpoint, wait="5 days", delay="1 day", arrived=F.to_timestamp("ds")).awaitTermination()
        pairs = stream_pairs.read_pairs(spark, output)
        outcome = stream_pairs.pairs_outcome(pairs, fx.RUN_TS)
        return (ids(outcome.filter("reason is null").select("paper_id")),
                sorted((r.reason, r.paper_id or "", r.format) for r in stream_pairs.quarantine(pairs).collect()))

    deliver(root, "arXiv", "2024-01-01", META % "a", META % "b", '{"id": ')
    deliver(root, "arXivRaw", "2024-01-01", HISTORY % "c")
    assert run() == ([], [("malformed", "", "arXiv")])
    deliver(root, "arXivRaw", "2024-01-03", HISTORY % "a")
    assert run() == (["a"], [("malformed", "", "arXiv")])
    deliver(root, "arXiv", "2024-01-04", (META % "a").replace('"t"', '"newer"'))
    assert run()[0] == ["a"]
    assert stream_pairs.pairs_outcome(stream_pairs.read_pairs(spark, output), fx.RUN_TS).filter("paper_id = 'a'").first().title == "newer"
    deliver(root, "arXiv", "2024-03-01", META % "z")
    done, refused = run()
    # b and c have waited in vain; z still waits
    assert done == ["a"] and refused == [("malformed", "", "arXiv"), ("unpaired", "b", "arXiv"), ("unpaired", "c", "arXivRaw")]
    import time

    for _ in range(50):
        if len(log.rows) >= 4:
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    seen = log.frame(spark)
    assert seen.agg(F.sum("input_rows")).first()[0] > 0
    assert seen.filter("state_rows > 0").count() > 0


def test_stream_loads_count_files(spark, tmp_path):
    root, metrics = tmp_path / "raw", scratch(spark, "m")
    deliver(root, "arXiv", "2024-01-01", META % "a")
    deliver(root, "arXivRaw", "2024-01-01", HISTORY % "a")
    deliver(root, "arXivRaw", "2024-01-02", "{")
    table = state.StateTable(scratch(spark, "t"), 2)
    jobs.stream_incremental(spark, str(root), table, scratch(spark, "ck"), fx.RUN_TS, metrics=metrics).awaitTermination()
    row = spark.read.parquet(metrics).filter("stage = 'extract'").first()
    assert (row.files, row.failed_files) == (3, 1)
    batch = scratch(spark, "m")
    incremental.load_days(
        spark, str(root), state.StateTable(scratch(spark, "t"), 2), "2024-01-01", "2024-01-03", fx.RUN_TS, metrics=batch)
    row = spark.read.parquet(batch).filter("stage = 'extract'").first()
    assert (row.files, row.failed_files) == (3, 1)
