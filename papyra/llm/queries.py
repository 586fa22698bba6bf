"""One registered query per operator, each over its whole table; SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm import (
    balltree, decontaminate, exact_dedup, langid, lexical_search, lm_score, near_dedup, packing, periodic_runs,
    secret_scan, simple8b, site_tree, token_ledger,
)
from papyra.session import scratch

TOKENIZER = "byte_bpe_50k"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    """doc_id and item_id of every benchmark item in every document, with the exact containment."""
    found = decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


def op2_lm_score(spark, sf_dir):
    """Target: documents labelled as good; background: all documents."""
    docs = _table(spark, sf_dir, "documents")
    good = _table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.score(docs, good).select("doc_id", "n_tokens", F.round("score", 6).alias("score"))


def op3_html(spark, sf_dir):
    return site_tree.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_token_counts(spark, sf_dir):
    """All documents are inserted; those labelled toxic are deleted; those labelled as poor are revised to
    their text with digits masked; the deletion is delivered again; totals after all that."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    masked = docs.select(
        "doc_id", "source", "lang", F.length("text").cast("long").alias("chars"), "text",
        F.regexp_replace("text", "[0-9]", "0").alias("masked"))
    path = scratch(spark, "ledger")
    counted = token_ledger.count_tokens(masked, ["text", "masked"])
    counted.write.parquet(f"{path}/counted")
    counted = spark.read.schema(counted.schema).parquet(f"{path}/counted").withColumn("tokenizer", F.lit(TOKENIZER))
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    ledger = token_ledger.Ledger(spark, f"{path}/ledger")
    insert = counted.select(
        "doc_id", "tokenizer", "source", "lang", "chars", F.col("text_tokens").alias("tokens"),
        F.lit("insert").alias("op"), F.lit(1).alias("seq"))
    none = F.lit(None)
    delete = marked.where("toxic = 1").select(
        "doc_id", F.lit(TOKENIZER).alias("tokenizer"), none.cast("string").alias("source"), none.cast("string").alias("lang"),
        none.cast("long").alias("chars"), none.cast("long").alias("tokens"), F.lit("delete").alias("op"), F.lit(2).alias("seq"))
    revise = counted.join(marked.where("quality = 0 AND toxic = 0").select("doc_id"), "doc_id").select(
        "doc_id", "tokenizer", "source", "lang", "chars", F.col("masked_tokens").alias("tokens"),
        F.lit("revise").alias("op"), F.lit(3).alias("seq"))
    for name, changes in (("insert", insert), ("takedown", delete), ("masking", revise), ("takedown", delete)):
        ledger.commit(name, changes)
    return ledger.totals()


def op5_token_shards(spark, sf_dir):
    path = scratch(spark, "tokens")
    simple8b.write_tokens(_table(spark, sf_dir, "documents"), path)
    return simple8b.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    guessed = langid.predict(docs.select("doc_id", "text"), network)
    return guessed.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_secrets(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents")).drop("cost")


def op9_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicate_groups(_table(spark, sf_dir, "documents"), k=4)


def op10_top_k(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return balltree.top_k(rows, rows.where("vec_id % 50 = 0"))


def op11_exact_dedup(spark, sf_dir):
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), {"text_sha256": digest})


def op12_periodic_runs(spark, sf_dir):
    """Runs of all documents, every tenth of which is made periodic first."""
    docs = periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ALL = [
    op1_decontamination, op2_lm_score, op3_html, op4_token_counts, op5_token_shards, op6_language, op7_secrets,
    op8_packing, op9_near_dedup, op10_top_k, op11_exact_dedup, op12_periodic_runs, op13_lexical_search,
]


def registry():
    return {q.__name__: q for q in ALL}


_WORDS = r"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# unsigned crc32 of the decimal doc_id, bit by bit; 3988292384 is the polynomial
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def statements() -> dict[str, str]:
    return {
        # items of five words or more, as all benchmark items are
        "op1_decontamination": f"""
            WITH d AS (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents WHERE text IS NOT NULL),
            i AS (SELECT item_id, {_WORDS.format(text='text')} AS w FROM benchmark WHERE text IS NOT NULL),
            ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
                   FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM d)),
            si AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s
                   FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM i)),
            n AS (SELECT item_id, count(*) AS n_item FROM si GROUP BY item_id)
            SELECT doc_id, item_id, n_item, count(*) AS n_shared
            FROM ds JOIN si USING (s) JOIN n USING (item_id)
            GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item""",
        "op10_top_k": """
            WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                       FROM embeddings
                       WHERE embedding IS NOT NULL AND len(embedding) > 0
                         AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
            s AS (SELECT q.vec_id AS query_id, c.vec_id,
                         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
                  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
        "op11_exact_dedup": f"""
            WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
            FROM d WINDOW same AS (PARTITION BY t)""",
        # stretches of word pairs that are equal at one distance; a stretch's smallest distance is its period
        "op12_periodic_runs": f"""
            WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
                              {_CRC} AS h FROM documents),
            o AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM d),
            p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM o),
            t AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
                      THEN list_transform(w, lambda x, i: CASE WHEN i - 1 < a THEN x ELSE w[a + (i - 1 - a) % p + 1] END)
                      ELSE w END AS w FROM p),
            word AS MATERIALIZED (SELECT doc_id, n, i - 1 AS i, x FROM (
                SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM t)),
            equal AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM word l JOIN word r
                      ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i AND 3 * (r.i - l.i) <= l.n),
            stretch AS (SELECT doc_id, q, min(i) AS s, max(i) + q + 1 AS e FROM (
                SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
                GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
            run AS (SELECT doc_id, s, e - s AS len, min(q) AS q FROM stretch GROUP BY doc_id, s, e),
            per_doc AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed
                        FROM run GROUP BY doc_id),
            best AS (SELECT * FROM (SELECT *, row_number() OVER (
                        PARTITION BY doc_id ORDER BY (len * 1000000000000) // q DESC, s, q) AS place FROM run) WHERE place = 1),
            gone AS (SELECT DISTINCT word.doc_id, i FROM word JOIN run ON word.doc_id = run.doc_id AND i >= s + q AND i < s + len),
            kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS c FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
            SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period,
                   (1000 * len) // q AS exponent_milli,
                   sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
            FROM documents LEFT JOIN per_doc USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
        "op13_lexical_search": """
            WITH term_of AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')) AS term FROM documents),
            asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(list_filter(regexp_split_to_array(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')) AS term FROM benchmark) GROUP BY item_id, term),
            tf AS (SELECT doc_id, term, count(*) AS tf FROM term_of GROUP BY doc_id, term),
            size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
            total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM size),
            weight AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
            scored AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len))))::BIGINT AS score
                       FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
            ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
                       FROM scored WHERE score > 0)
            SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    }
