"""The operators against brute force, and on empty tables, nulls, repeats and clashing columns."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from papyra.llm import (
    balltree, bpe, decontaminate, langid, lm_score, near_dedup, packing, secret_scan, simple8b, site_tree,
    textbytes, token_ledger,
)
from papyra.session import scratch
from tests.compare import differences, duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, secrets string, score string, id long, a long"
LONG = " ".join(f"word{i % 977} then{i}" for i in range(40000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards mix a jug of quartz potion tonight"
TEXTS = [
    None, "", "   \n\t", "one", PROSE, PROSE, PROSE.upper(), PROSE + " again", "été — naïve x  y\n\nz it's 12,3!",
    'api_key = "abcdEFGH1234ijkl"', LONG, LONG + " end", "  lead", "!!! ??? 123",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if t and i % 5 else None, None, len(t or ""), "x", "y", 1, 2) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[4], (None, "no id at all", None, "s", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


@pytest.mark.parametrize("name", ["op1_decontamination", "op10_top_k"])
def test_equals_sql(spark, small, name):
    problem, n = differences(spark, duck(small), small, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and n > 0


def test_ids_equal_those_of_whole_texts(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [t or "" for t in TEXTS]
    texts += ["a  b\t c\n\nd 　 f", "x \x1c y\x85 z", " é\n é,", "<|endoftext|> hi", "we'll\n's D'RE", "—, ×, ÷."]
    encoder = bpe.Encoder(bpe.vocabulary())
    ids, places = encoder.encode(pa.array(texts))
    for i, e in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[places[i] : places[i + 1]].tolist() == e.ids


def test_added_tokens_have_their_own_id():
    from tokenizers import Tokenizer

    texts = ["<|endoftext|> hi", "a<|endoftext|>b <|endoftext|>\n<|endoftext|><|endoftext|>", "cut <|endof", "text|> here", "", "<|endoftext|>", None]
    ids, places = bpe.Encoder(bpe.vocabulary()).encode(pa.array(texts))
    fresh = Tokenizer.from_file(bpe.vocabulary())
    got = [ids[a:b].tolist() for a, b in zip(places, places[1:])]
    assert got == [fresh.encode(t or "", add_special_tokens=False).ids for t in texts] and got[0] == [50256, 23105]


@pytest.mark.parametrize("top", [2, 1000, 50257, 1 << 63])
@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 9000])
def test_simple8b_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint64)
    if top > 1 << 60 and n > 9:
        ids[3], ids[5:9] = (1 << 64) - 1, 1
    w, per_block, raw, raw_per_block = simple8b.encode_blocks(ids)
    first = lambda x: np.concatenate([[0], x]).cumsum().astype(np.int64)
    assert (simple8b.decode_blocks(w, first(per_block), raw, first(raw_per_block), n) == ids).all()


def test_pieces_are_cut_only_if_none_has_room():
    lengths = [500] * 40 + [800] * 20 + [200] + [24] * 200
    pieces = packing.pack(lengths)
    assert [p[1:3] for p in pieces if p[0] == 60] == [(0, 200)]
    # brute force over all open sequences, while any is open
    used, costs = [0] * (sum(lengths) // 1024), [0.0] * (sum(lengths) // 1024)
    for doc, start, n, s, offset in pieces:
        if s < len(used):
            full = 1024 - used[s] == n
            fits = [(costs[i], i) for i in range(len(used)) if 1024 - used[i] >= n]
            cheapest = min((costs[i], i) for i in range(len(used)) if used[i] < 1024)
            assert offset == used[s] and (min(fits)[1] == s or full and cheapest[1] == s)
            used[s], costs[s] = used[s] + n, costs[s] + packing.cost(n)
    assert used == [1024] * len(used) and sum(p[2] for p in pieces) == sum(lengths)


def test_shards_and_packing(spark, odd, none):
    tokenizer = bpe.Encoder(bpe.vocabulary()).tokenizer
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(TEXTS)}
    ids[None] = np.array([*tokenizer.encode("no id at all", add_special_tokens=False).ids, 0], "<u4")
    path, at = scratch(spark, "t"), 0
    simple8b.write_tokens(odd, path)
    rows = simple8b.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, *sorted([*range(len(TEXTS)), 4])]
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
        at += r.n_tokens
    empty = scratch(spark, "t")
    assert simple8b.write_tokens(none, empty).count() == 0 == simple8b.read_tokens(spark, empty).count()

    sequences, covered = collections.defaultdict(list), collections.Counter()
    for r in packing.pack_documents(odd).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == collections.Counter({i: len(x) * (2 if i == 4 else 1) for i, x in ids.items()})
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == 1024 or at < 1024 and at & (at - 1) == 0
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(spark, small, odd, none, k):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionAll(
        odd.select(F.col("doc_id") + 10**6, "text"))
    found = near_dedup.near_duplicate_groups(docs, k).where("doc_id IS NOT NULL").collect()
    sets = {r.doc_id: shingle_set(r.text, k) for r in docs.collect() if r.doc_id is not None}
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b]) if a < b else 0
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    for r in found:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root(r.doc_id), root(r.doc_id) == r.doc_id)
    kept = near_dedup.without_near_duplicates(odd, k)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 1
    assert near_dedup.near_duplicate_groups(none, k).count() == 0


def test_families_are_compared_in_blocks(spark, monkeypatch):
    """Many texts that share most words, but not enough of them, and a few pairs that do."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.choice(100, 4, replace=False):
            w[j] = f"x{i}-{j}"
        rows.append((i, " ".join(w)))
        if i % 10 == 0:
            rows.append((100 + i, " ".join([*w, f"tail{i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(docs, 4).collect()}
    sets, label = {i: shingle_set(t, 4) for i, t in rows}, {i: i for i, _ in rows}
    for _ in range(len(rows)):
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_sketch_fills_every_coordinate_and_estimates():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    values = textbytes.mix(np.concatenate([a, b, a[:1]]))
    s = near_dedup.sketch(values, np.array([0, 1000, 2000, 2001]))
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 2 / 3) < 0.2


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, PROSE), (2, "one"), (3, None), (4, ""), (5, "quartz potion")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(odd, items).collect()}
    assert found == {(i, 1) for i in (4, 5, 6, 7)} | {(3, 2)} | {(i, 5) for i in (4, 5, 6, 7)}
    assert {r.doc_id for r in decontaminate.without_contaminated(odd, items).collect()} == {
        None, *range(len(TEXTS))} - {3, 4, 5, 6, 7}
    assert decontaminate.contained_items(odd, items.limit(0)).count() == 0
    assert decontaminate.contained_items(none, items).count() == 0


def test_language(spark, small, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    network = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    seen = langid.predict(docs, network).where(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect()
    assert np.mean([r.lang == r.lang_pred for r in seen]) > 0.95
    out = langid.predict(odd, network).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.lang_pred == "und"} == {0, 1, 2, 13}
    assert langid.train(none) is None and langid.predict(none, network).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_language_model(spark, odd, none, monkeypatch):
    good = spark.createDataFrame([(4,), (4,), (None,)], "doc_id long")
    encoder = bpe.Encoder(bpe.vocabulary()).tokenizer
    rows = [(r.doc_id, encoder.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()]
    # brute force over lists of ids, background 0 and target 1
    pairs, tokens, heads = ([collections.Counter(), collections.Counter()] for _ in range(3))
    for doc_id, ids in rows:
        for before, token in zip([None, *ids], ids):
            for w in (0, 1) if doc_id == 4 else (0,):
                pairs[w][before, token] += 1
                tokens[w][token] += 1
                heads[w][before] += 1
    total, strength, size = sum(tokens[1].values()), lm_score.STRENGTH, len(tokens[0])
    scale = total / sum(tokens[0].values()), 1.0

    def log_p(w, before, token):
        low = (tokens[w][token] * scale[w] + strength / size) / (total + strength)
        return np.log((pairs[w][before, token] * scale[w] + strength * low) / (heads[w][before] * scale[w] + strength))

    expected = sorted(
        (str(i), len(ids), np.mean([log_p(0, b, t) - log_p(1, b, t) for b, t in zip([None, *ids], ids)]) if ids else None)
        for i, ids in rows)
    for chunk, held in ((lm_score.CHUNK_TOKENS, lm_score._HELD), (50, 40)):  # the small ones: many chunks, early flushes
        monkeypatch.setattr(lm_score, "CHUNK_TOKENS", chunk)
        monkeypatch.setattr(lm_score, "_HELD", held)
        found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm_score.score(odd, good).collect())
        assert [f[:2] for f in found] == [e[:2] for e in expected]
        assert all(f[2] is e[2] if e[2] is None else abs(f[2] - e[2]) < 1e-9 for f, e in zip(found, expected))
    score = {f[0]: f[2] for f in found}
    assert score["0"] is None and score["1"] is None and score["4"] < 0 < score["10"]
    assert all(r.score in (0, None) for r in lm_score.score(odd, good.limit(0)).collect())
    assert lm_score.score(none, good).count() == 0


def test_language_model_table_is_joined_and_not_sent(spark, odd):
    """Only the two tables of tokens, bounded by the vocabulary, are broadcast; the bigrams are shuffled."""
    encoded = lm_score.tokens(odd)
    path = scratch(spark, "counts")
    lm_score.gram_counts(encoded, odd.where("doc_id = 4")).write.parquet(path)
    plan = lm_score.score_tokens(encoded, lm_score.loss_differences(spark.read.parquet(path)).hint("merge"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" in text and "CartesianProduct" not in text


def page(main, extra=""):
    return (
        f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
        f"{main}{extra}<footer>&copy; x</footer></body>")


def test_main_text(spark):
    article = "<article><h1>Head &amp; line</h1><p>One\n  two<br>three<p><b>Four</article>"
    rows = [(1, "http://a.com/1", page(article, "<div class='cookie-notice'>ok</div><form>f</form>")), (2, None, None), (3, "x", ""), (4, "http://", "<p>un<closed"), (4, "http://", "<p>un<closed")]
    # a site without landmarks: its slogan stands on every page, its texts are its own
    rows += [(100 + i, "http://b.com/x", page(f"<div class='slogan'><p>Buy now at Bee</p></div><div class='story'><p>Story number {i} of many</p></div>")) for i in range(20)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    out = collections.defaultdict(list)
    for r in site_tree.extract(pages).collect():
        out[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert out[1] == ["Head & line\n\nOne two three\n\nFour"] and out[2] == out[3] == [""] and len(out[4]) == 2
    assert [out[100 + i] for i in range(20)] == [[f"Story number {i} of many"] for i in range(20)]
    assert site_tree.extract(pages.limit(0)).count() == 0


def test_names_alone_remove_no_main_text(spark):
    """An entry header, a layout wrapper, a body beside teasers, a span within a line; then a host that shows which parts vary."""
    wrapped = "<div class='layout no-sidebar'><h1>Top</h1><p>Text of the page that is long enough</p></div>"
    entry = "<article><header class='entry-header'><h1>Title</h1></header><p>Body</p></article>"
    teasers = "<div class='story'><p>The real body of this page</p></div><article class='teaser'><h2>Teaser</h2></article>"
    line = "<article><p>See <span class='related'>this</span>, and more</p></article>"
    rows = [(i, f"http://host{i}.com/", page(x)) for i, x in enumerate([entry, wrapped, teasers, line])]
    rows += [(10 + i, "http://s.com/", page(f"<div class='search'><p>Found {i} by itself</p></div><div class='promo'>Buy</div><div><p>Story {i} told at length</p></div>")) for i in range(12)]
    out = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[0] == "Title\n\nBody" and out[1] == "Top\n\nText of the page that is long enough"
    assert "The real body of this page" in out[2] and out[3].startswith("See") and out[3].endswith(", and more")
    assert [out[10 + i] for i in range(12)] == [f"Found {i} by itself\n\nStory {i} told at length" for i in range(12)]


def test_few_pages_back_off_to_other_hosts(spark):
    """Two pages of a host lose what they share; a single page loses what other hosts share at the same path."""
    form = "<div class='box'><p>Win a prize</p></div>"
    story = lambda i: f"<div class='text'><p>Story number {i} of many</p></div>"
    rows = [(i, f"http://two{i // 2}.com/{i}", page(story(i), form)) for i in range(4)] + [(9, "http://one.com/", page(story(9), form))]
    rows += [(20 + i, "http://alone.com/", f"<section><p>Same words</p></section><div><p>Own words {i}</p></div>") for i in range(2)]
    out = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"Story number {i} of many" for i in (0, 1, 2, 3, 9)} | {20 + i: f"Own words {i}" for i in range(2)}


def test_ledger(spark, odd, none):
    counted = token_ledger.count_tokens(odd.select("doc_id", "source", "lang", "text"), ["text"])
    assert {r.doc_id: r.text_tokens for r in counted.collect()}[0] == 0
    columns = "doc_id long, tokenizer string, op string, seq int, source string, lang string, tokens long, chars long"
    batch = lambda *rows: spark.createDataFrame(rows, columns)
    ledger = token_ledger.Ledger(spark, scratch(spark, "ledger"))
    assert ledger.totals().count() == 0
    first = batch((1, "v1", "insert", 1, "s", "en", 10, 40), (2, "v1", "insert", 1, "s", "en", 5, 20), (2, "v2", "insert", 1, "s", None, 6, 20),
                  (None, "v1", "insert", 1, "s", "en", 9, 9), (2, "v1", "insert", 1, "s", "en", 5, 20))
    second = batch((1, "v1", "revise", 1, "t", "en", 12, 44), (2, "v2", "delete", 1, None, None, None, None), (7, "v1", "delete", 1, None, None, None, None))
    assert ledger.commit("a", first) and ledger.commit("b", second) and not ledger.commit("b", second)
    want = {("s", "en", "v1", 1, 5, 20), ("t", "en", "v1", 1, 12, 44)}
    assert {tuple(r) for r in ledger.totals().collect()} == want
    assert {tuple(r) for r in ledger.compact(scratch(spark, "ledger")).totals().collect()} == want
    # what a broken commit left behind is written anew
    first.limit(0).write.parquet(f"{ledger.path}/rows/c")
    assert ledger.commit("c", batch()) and {tuple(r) for r in ledger.totals().collect()} == want


def test_secrets(spark, odd, none):
    rows = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan(odd)).collect()}
    assert rows[9].n_assign == 1 and rows[9].spans == "assign:0:27" and rows[4].spans == "" == rows[0].spans
    assert secret_scan.scan_text('k = "Zx9aQ81mmPq2"\nDB_PASSWORD=k\npassword = changeme') == [("lex", 5, 17, "DB_PASSWORD", 0.8546)]
    clean = secret_scan.redact(odd)
    assert clean.columns == odd.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert texts[9] == ('[SECRET]"', 9) and texts[4][0] == PROSE and texts[0] == (None, 0)
    assert secret_scan.scan(none).count() == 0 == secret_scan.redact(none).count()


def test_bare_values_hide_no_pairs():
    for text in ("login?user=bob&pwd=Zx9aQ81mmPq2", "args: --pwd=Zx9aQ81mmPq2", "env: DB_PWD=Zx9aQ81mmPq2", "user=bob&password=Zx9aQ81m",
                 "pwd=Zx9aQ81mmPq2&user=bob", 'args: --pwd="Zx9aQ81mmPq2"', 'k = "Zx9aQ81mmPq2"\npwd=k&user=bob'):
        value = "Zx9aQ81mmPq2" if "mm" in text else "Zx9aQ81m"
        spans = [s[:3] for s in secret_scan.scan_text(text)]
        assert spans == [("lex", text.index(value), text.index(value) + len(value))], text


def test_top_k(spark):
    rows = [(0, [1.0, 0.5], "x"), (1, [1.0, 0.5], "x"), (1, [1.0, 0.5], "x"), (2, None, "x"), (3, [float("nan"), 1.0], "x"), (4, [None, 1.0], "x"), (None, [1.0, 1.0], "x"), (50, [0.1], "x"), (100, [], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in balltree.top_k(table, table.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 256 * 256 + 128 * 128), (0, 2, 1, 256 * 256 + 128 * 128)]
    assert balltree.top_k(table.limit(0), table).count() == 0


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, kept, small).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, small)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    assert corpus_pipeline.run(spark, small).count() == pieces.count()
