"""Ranked lexical search by NRA (no random access): impact-sorted lists and score intervals.

1. One pass over the whole texts counts the terms of every document and keeps, per document, how often it holds each
   term that some item asks for. Counts (N, L, df) are sums of that table.
2. Its rows are taken as they lie, in shards of at most ``SHARD_POSTINGS`` postings; nothing is shuffled. In a shard every term has a list of
   (impact, document), greatest impact first, where impact is the part of the score without the term's weight.
3. For each item the lists of its terms are read in step, a block of each per round. A document's lower bound is the
   sum of what was read for it, its upper bound adds for every list in which it was not met the list's last read
   impact. Documents whose upper bound falls under the k-th greatest lower bound are out. Reading goes on
   until every document that can reach the k-th place has equal bounds and none unread can reach it:
   then members, order and scores are exact, ties included. The k-th score goes on to the task's next shard.
4. The best of all shards are ranked once more.

The items' terms are held by every task as 64-bit hashes. Items are dealt into as many passes as keep that table
below ``TERMS_PER_PASS``, so memory does not depend on their number.

Terms are the maximal runs of A-Z, a-z, 0-9 and characters beyond ASCII, A-Z lower-cased. Null texts and texts without a
term have no rank and count nowhere. Repeated rows are documents of their own; of equal scores the
smaller doc_id comes first, a null doc_id last. Rows of one item_id are one item, made of its different texts;
items without id or terms give no rows. Empty tables give none. Columns other than ids and texts are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship
from papyra.session import scratch

TERMS_PER_PASS = 1 << 20
SHARD_POSTINGS = 1 << 20
SLICE_BYTES = 1 << 20
FIRST_READ = 32  # postings of each list in the first round; twice as many in each later one
NULL_ID = np.iinfo(np.int64).max

IN_TERM = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    IN_TERM[ord(_first) : ord(_last) + 1] = True
IN_TERM[128:] = True


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms in text order, and the n + 1 places of the texts."""
    data, offsets = tb.text_buffer(column)
    begins, ends = tb.edges(IN_TERM[data], offsets)
    return tb.span_hashes(data, begins, ends), np.searchsorted(begins, offsets)


def _item_terms(batches):
    """(item_id, text) to (item_id, term, times)."""
    for batch in batches:
        for part in tb.slices(batch, "text", SLICE_BYTES):
            terms, first = term_hashes(part.column(1))
            item = np.repeat(part.column(0).to_numpy(), np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(terms.view(np.int64))], names=["item_id", "term"])


COUNTED = "doc_id long, n_terms long, terms array<int>, times array<int>"


def _count(wanted: np.ndarray):
    """(doc_id, text) to the number of its terms and the places (in ``wanted``) and counts of those asked for."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                terms, first = term_hashes(part.column(1))
                place = np.searchsorted(wanted, terms)
                place[place == len(wanted)] = 0
                hit = wanted[place] == terms
                row = np.repeat(np.arange(part.num_rows), np.diff(first))[hit]
                pairs, times = np.unique(row * len(wanted) + place[hit], return_counts=True)
                row, place = np.divmod(pairs, len(wanted))
                offsets = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    names=["doc_id", "n_terms", "terms", "times"])

    return run


class ImpactLists:
    """Lists of one shard: for each term the documents that hold it, by descending impact."""

    def __init__(self, ids: np.ndarray, document: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((document, -impact, term))
        self.ids, self.document, self.impact = ids, document[order].astype(np.int32), impact[order]
        self.terms, begins = np.unique(term[order], return_index=True)
        self.begins = np.append(begins, len(order))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, kth: int = 0):
        """Documents (places in ``ids``) and scores of the k best, best first, among those that reach ``kth``."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        held = (self.terms[at] == terms) & (weights > 0) if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[held], weights[held]
        begins, ends = self.begins[at].copy(), self.begins[at + 1]
        n, lists = len(self.ids), len(at)
        lower = np.zeros(n, np.int64)
        met = np.zeros((lists, n), bool)
        alive = np.zeros(n, bool)  # met and still able to reach the k-th place
        out = np.zeros(n, bool)
        read, last = FIRST_READ, weights * self.impact[begins]
        while lists:
            for j in range(lists):
                a, b = begins[j], min(begins[j] + read, ends[j])
                if a < b:
                    documents = self.document[a:b]  # no document comes twice in a list
                    lower[documents] += weights[j] * self.impact[a:b]
                    met[j, documents] = True
                    alive[documents] = True
                    begins[j], last[j] = b, weights[j] * self.impact[b - 1] if b < ends[j] else 0
            read *= 2
            alive &= ~out
            candidates = np.flatnonzero(alive)
            floor = lower[candidates]
            if len(candidates) >= k:
                kth = max(kth, int(np.partition(floor, -k)[-k]))
            unmet = int(last.sum()) - last @ met[:, candidates]
            gone = floor + unmet < kth
            out[candidates[gone]] = True
            alive[candidates[gone]] = False
            # bounds meet where nothing is left to come; a tie with the k-th score must be read to its end
            if not last.any() or (int(last.sum()) < kth and not unmet[~gone].any()):
                break
        documents = np.flatnonzero(alive & (lower > 0) & (lower >= kth))
        best = documents[np.lexsort((self.ids[documents], -lower[documents]))][:k]
        return best, lower[best]


def _search(items, k: int):
    """Shards of counted documents to the k best of each for every item (item_id, terms, weights)."""

    def rank(shard, kth):
        ids = np.concatenate([s[0] for s in shard])
        document = np.repeat(np.arange(len(ids)), np.concatenate([s[1] for s in shard]))
        lists = ImpactLists(ids, document, *(np.concatenate([s[c] for s in shard]) for c in (2, 3)))
        found = []
        for i, (item, terms, weights) in enumerate(items):
            best, scores = lists.search(terms, weights, k, int(kth[i]))
            if len(best) == k:
                kth[i] = max(kth[i], scores[-1])
            found += zip([item] * len(best), ids[best].tolist(), scores.tolist())
        item, doc, score = zip(*found) if found else ((), (), ())
        doc = pa.array([None if d == NULL_ID else d for d in doc], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), doc, pa.array(score, pa.int64())], names=["item_id", "doc_id", "score"])

    def run(batches):
        shard, held, kth = [], 0, np.zeros(len(items), np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            shard.append((ids, lengths, batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()))
            held += len(shard[-1][2])
            if held >= SHARD_POSTINGS:
                yield rank(shard, kth)
                shard, held = [], 0
        if shard:
            yield rank(shard, kth)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (doc_id, text) for each item (item_id, text)."""
    spark, path = ship(docs.sparkSession), scratch(docs.sparkSession, "lexical")

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{path}/{name}")

    asked = items.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    asked = asked.mapInArrow(_item_terms, "item_id long, term long").groupBy("item_id", "term").agg(F.count("*").alias("times"))
    asked = keep(asked, "items")
    passes = max(1, -(-asked.count() // TERMS_PER_PASS))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for i in range(passes):
        own = asked.where(F.col("pass") == i)
        wanted = np.sort(own.select("term").distinct().toArrow()["term"].to_numpy().view(np.uint64))
        if not len(wanted):
            continue
        counted = keep(rows.mapInArrow(_count(wanted), COUNTED).where("n_terms > 0"), f"counted-{i}")
        total = counted.agg(F.count("*").alias("n"), F.sum("n_terms").alias("l")).first()
        per_term = counted.select(F.explode("terms").alias("place")).groupBy("place").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(wanted), np.int64)
        df[per_term["place"].to_numpy()] = per_term["df"].to_numpy()
        weight = np.floor(1000 * np.log((2 * total.n + 2) / (2 * df + 1))).astype(np.int64)
        of_item = own.groupBy("item_id").agg(F.collect_list("term").alias("terms"), F.collect_list("times").alias("times"))
        queries = []
        for row in of_item.orderBy("item_id").toArrow().to_pylist():
            place = np.searchsorted(wanted, np.array(row["terms"], np.int64).view(np.uint64))
            queries.append((row["item_id"], place, weight[place] * np.array(row["times"], np.int64)))
        # whole numbers all the way: 100 - 75 + (75 n N) div L, then the impact of each count
        length = F.expr(f"25 + (75 * n_terms * {total.n}L) div {total.l or 1}L").alias("m")
        impacts = counted.select("doc_id", "terms", "times", length).select(
            "doc_id", "terms", F.expr("transform(times, tf -> (1000000000L * tf) div (1000 * tf + 8 * m))").alias("impacts"))
        part = impacts.mapInArrow(_search(queries, k), "item_id long, doc_id long, score long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return _best(found, k)
