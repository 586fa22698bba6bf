"""Exact duplicates, periodic runs and ranked search: against SQL, brute force and odd rows."""

import hashlib
import random
import re
import time
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from papyra.llm import balltree, exact_dedup, lexical_search, periodic_runs, secret_scan, token_ledger
from papyra.llm import textbytes as tb
from papyra.session import scratch
from tests.compare import differences, duck
from tests.llm.test_operators import SCHEMA, none, odd  # noqa: F401


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_periodic_runs", "op13_lexical_search"])
def test_equals_sql(spark, small, name):
    problem, n = differences(spark, duck(small), small, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and n > 0


def brute_groups(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(low(text), []).append(doc)
    out = []
    for doc, text in rows:
        own = groups[low(text)]
        keep = max((d for d in own if d is not None), default=None)
        out.append((doc, keep, len(own), doc == keep, hashlib.sha256(low(text).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_exact_groups_of_odd_rows(spark, odd, monkeypatch, words):  # noqa: F811
    # with a bit table of one word nearly every row goes on: the groups must not change
    monkeypatch.setattr(exact_dedup, "WORDS", words)
    prefix = "x" * exact_dedup.PREFIX
    more = [(100, prefix + "a"), (101, prefix + "b"), (102, prefix + "A"), (102, prefix + "a"), (None, None), (None, "sole"), (103, "É"), (104, "é")]
    more += [(200 + i, "Hot") for i in range(900)]
    docs = odd.select("doc_id", "text", "id", "a").unionAll(
        spark.createDataFrame([(d, t, 1, 2) for d, t in more], "doc_id long, text string, id long, a long"))
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    got = exact_dedup.exact_duplicates(docs, {"text_sha256": digest})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in got.collect()) == brute_groups(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Cartesian", "NestedLoop", "Python", "Arrow"))


def test_no_rows(spark, none):  # noqa: F811
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_runs(none)).count() == 0
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(items.withColumnRenamed("item_id", "doc_id"), items.where("false")).count() == 0


def brute_runs(words):
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def random_words(rng):
    n, kinds = rng.randint(0, 400), rng.choice([1, 2, 3, 10, 200])
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n > 30 else 0):
        a = rng.randrange(n - 20)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a, a + rng.randint(p, n - a)):
            words[i] = words[a + (i - a) % p]
    if n > 50 and rng.random() < 0.3:
        words[rng.randrange(n)] = "odd"
    return words


def runs_of(texts):
    ids, first = periodic_runs.word_ids([[w.encode() for w in t] for t in texts])
    start, end, period = periodic_runs.find_runs(ids, first)
    at = np.searchsorted(start, first)
    return [sorted(zip((start[a:b] - first[i]).tolist(), (end - start)[a:b].tolist(), period[a:b].tolist()))
            for i, (a, b) in enumerate(zip(at, at[1:]))]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(40)]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_runs_survive_false_zeros(monkeypatch):
    """With every sum of squares taken for zero, the words decide at last."""
    right, calls = periodic_runs.mismatches, []

    def careless(blocks, windows):
        calls.append(1)
        got = right(blocks, windows)
        return got * 0 if len(calls) < 3 else got

    monkeypatch.setattr(periodic_runs, "mismatches", careless)
    rng = random.Random(5)
    texts = [[str(i % 7) for i in range(60)], random_words(rng), [str(i % 40) for i in range(150)]]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_mismatches_are_sums_of_squares():
    rng = np.random.default_rng(3)
    for size in (8, 32, 128):
        blocks, windows = (rng.integers(0, periodic_runs.PRIME, (5, n)).astype(np.uint64) for n in (size, 2 * size))
        got = periodic_runs.mismatches(blocks, windows)
        for row in range(5):
            for d in range(size):
                want = sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[row], windows[row, d : d + size]))
                assert got[row, d] == want % periodic_runs.PRIME


def test_long_texts_of_few_words_take_no_square_time():
    begin = time.monotonic()
    n = 300_000
    for text in (["a"] * n, ["a", "b"] * (n // 2), [str(i % (n // 4)) for i in range(n)]):
        assert runs_of([text])[0][0][:2] == (0, n)
    assert time.monotonic() - begin < 20


def test_runs_of_odd_rows(spark, odd):  # noqa: F811
    extra = [(300, " ".join(["ab", "c"] * 30)), (300, "A a " * 40), (301, "x " * 30), (302, "\t a\x0b" * 24), (None, "n " * 24)]
    docs = odd.select("doc_id", "text", "id", "a").unionAll(
        spark.createDataFrame([(d, t, 1, 2) for d, t in extra], "doc_id long, text string, id long, a long"))
    want = []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute_runs(words) if len(words) < 5000 else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        want.append((r.doc_id, len(words), tuple(runs), " ".join(w for i, w in enumerate(words) if i not in gone), best))
    got = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs"))).collect()
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed, r.best and tuple(r.best)) for r in got) == Counter(want)


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(text))


def brute_search(docs, items, k=10):
    held = [(d, Counter(terms_of(t))) for d, t in docs if t and terms_of(t)]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item in sorted({i for i, _ in items if i is not None}):
        asked = Counter(t for i, text in set(items) if i == item for t in terms_of(text))
        scored = []
        for doc, c in held:
            m = 25 + 75 * sum(c.values()) * total // length
            score = sum(n * floor(1000 * log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, n in asked.items() if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank + 1, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k])]
    return out


def test_search_of_odd_rows(spark, odd):  # noqa: F811
    items = [(1, "the quick fox fox"), (2, None), (3, "..."), (4, "api_key 12 ÉTÉ été z"), (4, "word3 then39999"), (4, "word3 then39999"),
             (None, "one"), (5, "again again nothing"), (6, "ONE")]
    copies = [(i, "one two", 0, 0) for i in (70, 60, 60, 50)] + [(80 + i, f"one more {i}", 0, 0) for i in range(12)]
    docs = odd.select("doc_id", "text", "id", "a").unionAll(spark.createDataFrame(copies, "doc_id long, text string, id long, a long"))
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id long")
    got = [tuple(r) for r in lexical_search.search(docs, asked).orderBy("item_id", "rank").collect()]
    assert got == brute_search([(r.doc_id, r.text) for r in docs.collect()], items) and len(got) >= 20


def test_search_in_several_passes(spark, small, monkeypatch):
    monkeypatch.setattr(lexical_search, "TERMS_PER_PASS", 200)
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = [tuple(r) for r in lexical_search.search(docs, items).orderBy("item_id", "rank").collect()]
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want


@pytest.mark.parametrize("first_read", [1, 3, 32])
def test_intervals_resolve_ties(monkeypatch, first_read):
    monkeypatch.setattr(lexical_search, "FIRST_READ", first_read)
    rng = np.random.default_rng(first_read)
    for _ in range(60):
        n, terms = int(rng.integers(1, 300)), int(rng.integers(1, 9))
        ids = rng.permutation(n * 3)[:n]
        held = rng.random((n, terms)) < rng.uniform(0.05, 1)
        impact = rng.integers(1, 4, (n, terms)) * held
        weights = rng.integers(0, 4, terms)
        doc, term = np.nonzero(held)
        lists = lexical_search.ImpactLists(ids, doc, term, impact[doc, term])
        scores = impact @ weights
        for floor_ in (0, int(np.median(scores))):
            best, got = lists.search(np.arange(terms), weights, 5, floor_)
            want = sorted((-s, d) for s, d in zip(scores.tolist(), ids.tolist()) if s > 0 and s >= floor_)[:5]
            assert list(zip((-got).tolist(), ids[best].tolist())) == want


def test_terms_end_at_ascii_marks():
    import pyarrow as pa

    terms, first = lexical_search.term_hashes(pa.array(["A1_b c d", None, "", "a1 B"]))
    assert first.tolist() == [0, 3, 3, 3, 5] and terms[0] == terms[3] and terms[1] == terms[4]
    assert tb.text_buffer(pa.array(["x"]))[0].tolist() == [120]


def top_by_hand(vectors, queries, k):
    out = []
    for q in queries:
        whole = lambda v: [floor(256 * x) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(whole(vectors[q]), whole(v))), i) for i, v in vectors.items() if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return out


def test_large_components_take_part(spark):
    vectors = {0: [1.0, 1.0], 1: [3e6, 1.0], 2: [0.5, 0.5], 3: [-2e9, 7.0], 4: [2.0**34, -1.0], 50: [500.0, 300.0], 51: [1e6, -2e6]}
    rows = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in balltree.top_k(rows, rows.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == top_by_hand(vectors, [0, 50], 5) and got[0] == (0, 1, 4, sum(256 * x * 256 for x in (2**34, -1)))
    with pytest.raises(Exception, match="2\\*\\*62"):
        balltree.top_k(rows, rows.where("vec_id = 4").selectExpr("50 AS vec_id", "embedding")).collect()


def test_several_shards_and_groups(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 70), ("QUERY_ROWS", 9)):
        monkeypatch.setattr(balltree, name, value)
    rng = np.random.default_rng(4)
    vectors = {i: rng.integers(-40, 40, 6).astype(float).tolist() for i in range(400)}
    rows = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in balltree.top_k(rows, rows.where("vec_id % 10 = 0")).orderBy("query_id", "rank").collect()]
    assert got == top_by_hand(vectors, range(0, 400, 10), 5)


@pytest.mark.parametrize("n", [0, 1, 5, tb.BLOCK - 1, tb.BLOCK, tb.BLOCK + 1, 3 * tb.BLOCK + 7])
def test_span_sums_over_block_edges(n):
    rng = np.random.default_rng(n)
    data = rng.integers(0, 256, n).astype(np.uint8)
    begins = rng.integers(0, n + 1, 40)
    ends = np.array([rng.integers(b, min(n, b + 50) + 1) for b in begins])
    base, want = tb._BASE, []
    for b, e in zip(begins.tolist(), ends.tolist()):
        want.append(sum(int(tb._BYTE[x]) * pow(base, i, 1 << 64) for i, x in enumerate(data[b:e])) % (1 << 64))
    assert tb.span_sums(data, tb._BYTE, begins, ends).tolist() == want


CHANGES = "doc_id long, tokenizer string, source string, lang string, chars long, tokens long, op string, seq int"


def test_ledger_totals_equal_a_dictionary(spark):
    rng, ledger, held = random.Random(3), token_ledger.Ledger(spark, scratch(spark, "ledger")), {}
    for batch in range(4):
        rows = []
        for seq in range(60):
            op = rng.choice(["insert", "revise", "delete"])
            value = (rng.choice(["s", "t", None]), rng.choice(["en", None]), rng.randint(0, 9), rng.choice([None, 5, 7]))
            doc, version = rng.randint(0, 30), rng.choice(["v1", "v2"])
            rows.append((doc, version, *(value if op != "delete" else (None,) * 4), op, seq))
            if op == "delete":
                held.pop((doc, version), None)
            else:
                held[doc, version] = value
        changes = spark.createDataFrame([*rows, (None, "v1", "s", "en", 1, 1, "insert", 0), (1, None, "s", "en", 1, 1, "insert", 0)], CHANGES)
        assert ledger.commit(f"b{batch}", changes) and not ledger.commit(f"b{batch}", changes)
        want = Counter(), Counter(), Counter()
        for (doc, version), (source, lang, chars, tokens) in held.items():
            for total, n in zip(want, (1, tokens or 0, chars)):
                total[source, lang, version] += n
        got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in ledger.totals().collect()}
        assert got == {k: tuple(total[k] for total in want) for k in want[0]}
        assert ledger.documents().count() == len(held)
    one = spark.createDataFrame([(5, "v1")], "doc_id long, tokenizer string").select("*", token_ledger._bucket())
    plan = ledger.documents_of(one)._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
    # cut down to the batch's documents before the sums
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_counted_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "two words", 99)], "doc_id long, text string, text_tokens int")
    got = token_ledger.count_tokens(docs, ["text"])
    assert got.columns == ["doc_id", "text_tokens"] and got.first().text_tokens not in (0, 99)


V = "Zx9aQ81mmPq2"
LITERALS = [
    ('password = "ab\\"cd1234XYzz"', 'ab\\"cd1234XYzz'), ('pwd = "Zx9a" + "Q81mmPq2"', 'Zx9a" + "Q81mmPq2'),
    (f'<add key="DbPwd" value="{V}"/>', V), (f"<pwd>{V}</pwd>", V), (f"pwd: >-\n  {V}\nnext: 1", V), (f'pwd = """{V}"""', V),
    (f'#define PWD "{V}"', V), (f'let pwd: string = "{V}"', V), (f'cfg["pwd"] = "{V}"', V), (f"run --pwd {V} x", V),
    (f'k = "{V}"\npwd = f"{{k}}"', V), (f'pwd =\n    "{V}"', V), (f'pwd = "{V}" # c', V), (f"{{'pwd': '{V}'}}", V),
    (f"pwd=`{V}`", V), (f'a = {{ k = "{V}" }}\npwd = k', None), (f'{{ k = "{V}"; pwd = k }}', V), ("pwd = 'it\\'s9Zx8Qq77'", "it\\'s9Zx8Qq77"),
    (f"export PWD={V};", V), (f'pwd => "{V}"', V), (f"don't use pwd: \"{V}\"", V), ('k = "Zx9a"\npwd = "Q81mmPq2" + k', 'Q81mmPq2" + k'),
    (f'if pwd == "{V}":', None), (f'<a href="x">{V}</a>', None), (f'"db-pwd" : "{V}"', V), (f"pwd = {V}{'a1' * 3000}", None),
]


@pytest.mark.parametrize("text, want", LITERALS)
def test_literals_of_many_syntaxes(text, want):
    found = [text[a:b] for kind, a, b, *_ in secret_scan.scan_text(text) if kind == "lex"]
    assert found == ([want] if want else [])


@pytest.mark.parametrize("unit", [
    "pwd=", 'pwd="', 'pwd=\\"', '"\\"', 'pwd="""', "<pwd>", "<pwd", "pwd={", "pwd=\n", "&pwd=a", "pwd: |\n ", '"a"+', 'pwd="a"+"b"',
    "--pwd ", 'pwd=f"{pwd}', "pwd:", "pwd: ", "pwd:a<", 'pwd=f"{pwd}{pwd}"\n', "}{", '""" ', "a", "1-"])
def test_lexing_takes_linear_time(unit):
    seconds = []
    for n in (20_000, 320_000):
        begin = time.process_time()
        secret_scan.lexed_spans(unit * (n // len(unit)))
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 40 * max(seconds[0], 0.02)


def test_base_spans_equal_the_patterns_over_all_documents(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in secret_scan.digest(secret_scan.scan(spark.read.parquet(f"{small}/documents.parquet"))).collect():
        text, found = texts[r.doc_id], []
        found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and r.spans == shown
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in found) for i in range(3))
