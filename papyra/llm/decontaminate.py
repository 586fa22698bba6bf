"""Benchmark items inside documents: size-partitioned MinHash containment search.

An item (a short text) is contained in a document when at least ``THRESHOLD`` of its different
``SHINGLE``-word shingles occur in the document. A MinHash of a whole long document says nothing
about a short item, so, as containment search partitions its sets by size, the search is
partitioned by item size: class c holds the items of up to 2**c shingles, and they are compared with
windows of 2**(c+1) consecutive shingles that start at every multiple of 2**c. A passage of
the item's length lies within one window, and both sets are of like size. Minima of a class come
from those of the class before, so each shingle is hashed once per function.

A window and an item are candidates when they agree in any of ``HASHES`` minima (bands of one row).
An item found whole has a similarity of at least 1/4 with its window and is missed with a
chance of 0.75**64 = 1e-8; one with 0.8 of its shingles in one place, below 2e-7. Each candidate
is then counted exactly, over all shingles of the document; whole items are never sampled.

Items are taken ``ITEMS_AT_ONCE`` at a time: that bounds what is sent to the tasks, and each block of
items scans the documents once. Documents are not shuffled. Items of fewer than ``SHINGLE`` words
are one shingle of all their words, and are looked for with shingles of that many words; items
without words match nothing. Null texts are empty. Rows of equal ids are searched one by one and
give one result row each. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 64
ITEMS_AT_ONCE = 20_000
ITEM_BYTES_AT_ONCE = 64 << 20
_MULTIPLIERS = np.random.default_rng(0xD5).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
RESULT = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least hash of each run of values, one row per function."""
    out = np.empty((HASHES, len(starts)), np.uint32)
    high = (values >> np.uint64(32)).astype(np.uint32)
    low = values.astype(np.uint32)
    h = np.empty_like(low)
    for i in range(HASHES):
        # a pairwise independent function of the upper and the lower half
        np.multiply(low, _MULTIPLIERS[i], out=h)
        h += high
        np.minimum.reduceat(h, starts, out=out[i])
    return out


class Items:
    """One block of items, by words per shingle and size class."""

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        word, first = tb.words(*tb.text_buffer(texts))
        counts = np.diff(first)
        self.ids = ids
        self.groups = []
        for k in sorted({min(SHINGLE, c) for c in counts.tolist() if c}):
            values, places = tb.distinct(*tb.shingles(word, first, k, whole_if_short=False))
            own = np.flatnonzero(np.minimum(counts, SHINGLE) == k)
            sizes = np.diff(places)[own]
            owner = np.repeat(own, sizes)
            held = values[tb.gather_ranges(places[:-1][own], sizes)]
            order = np.argsort(held, kind="stable")
            classes = {}
            size_class = np.ceil(np.log2(sizes)).astype(int)
            for c in sorted(set(size_class.tolist())):
                members = own[size_class == c]
                lengths = np.diff(places)[members]
                runs = values[tb.gather_ranges(places[:-1][members], lengths)]
                minima = _minima(runs, np.cumsum(lengths) - lengths)
                place = np.argsort(minima, axis=1, kind="stable")
                classes[c] = members[place], np.take_along_axis(minima, place, axis=1)
            self.groups.append((k, classes, held[order], owner[order], np.diff(places)))

    def search(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, item, shingles of the item, shared ones) of all matches."""
        data, offsets = tb.text_buffer(texts)
        word, first = tb.words(data, offsets)
        for k, classes, held, owner, sizes in self.groups:
            values, places = tb.shingles(word, first, k, whole_if_short=False)
            n = np.diff(places)
            pairs, minima, blocks = [], None, None
            for c in range(min(classes), max(classes) + 1):
                if minima is None:
                    block = 1 << c
                    blocks = -(-n // block)
                    start = np.repeat(places[:-1], blocks) + block * tb.gather_ranges(np.zeros(len(n), np.int64), blocks)
                    if not len(start):
                        break
                    minima = _minima(values, start)
                else:
                    minima, blocks = _halved(minima, blocks)
                if c not in classes:
                    continue
                doc = np.repeat(np.arange(len(n)), blocks)
                last = np.cumsum(blocks)[blocks > 0] - 1
                windows = minima.copy()
                inner = np.ones(len(doc), bool)
                inner[last] = False
                at = np.flatnonzero(inner)
                windows[:, at] = np.minimum(minima[:, at], minima[:, at + 1])
                pairs += _agreements(windows, doc, *classes[c])
            if pairs:
                yield from self._verified(np.unique(np.concatenate(pairs)), values, places, held, owner, sizes)

    def _verified(self, pairs, values, places, held, owner, sizes):
        """Exact counts for candidate pairs, document by document."""
        doc, item = pairs >> 32, pairs & 0xFFFFFFFF
        for d in np.unique(doc).tolist():
            own = np.unique(values[places[d] : places[d + 1]])
            low = np.searchsorted(held, own, "left")
            high = np.searchsorted(held, own, "right")
            shared = np.bincount(owner[tb.gather_ranges(low, high - low)], minlength=len(sizes))
            for i in item[doc == d].tolist():
                if shared[i] >= THRESHOLD * sizes[i] - 1e-9:
                    yield d, i, int(sizes[i]), int(shared[i])


def _halved(minima, blocks):
    """Minima of blocks twice as long."""
    first = np.cumsum(blocks) - blocks
    new = -(-blocks // 2)
    start = np.repeat(first, new) + 2 * tb.gather_ranges(np.zeros(len(new), np.int64), new)
    pair = np.minimum(start + 1, np.repeat(first + blocks - 1, new))
    return np.minimum(minima[:, start], minima[:, pair]), new


def _agreements(windows, doc, members, minima):
    """Pairs (document << 32 | item) that agree in some minimum."""
    for i in range(HASHES):
        # most windows agree with no item: look at 16 bits first
        seen = np.zeros(1 << 16, bool)
        seen[minima[i] & 0xFFFF] = True
        hit = np.flatnonzero(seen[windows[i].astype(np.uint16)])
        low = np.searchsorted(minima[i], windows[i][hit])
        count = np.searchsorted(minima[i], windows[i][hit], "right") - low
        hit, low, count = hit[count > 0], low[count > 0], count[count > 0]
        if len(hit):
            item = members[i][tb.gather_ranges(low, count)]
            yield np.unique(np.repeat(doc[hit], count) << 32 | item)


def _item_blocks(items: DataFrame):
    """Blocks of items with a bounded number of rows and bytes, in a fixed order."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids, texts, size = [], [], 0
    for row in rows.toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text or "")
        if len(ids) >= ITEMS_AT_ONCE or size >= ITEM_BYTES_AT_ONCE:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item that it contains. ``items`` has item_id and text."""
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for ids, texts in _item_blocks(items):
        sent = spark.sparkContext.broadcast((ids, texts))

        def search(batches, sent=sent):
            ids, texts = sent.value
            block = Items(np.arange(len(ids)), pa.array(texts, pa.string()))
            for batch in batches:
                for part in tb.slices(batch, "text"):
                    hits = list(block.search(part.column(1)))
                    if hits:
                        d, i, n, k = (np.array(x) for x in zip(*hits))
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(d)), pa.array([ids[x] for x in i], pa.int64()),
                             pa.array(n), pa.array(k), pa.array(k / n)],
                            names=[x.split()[0] for x in RESULT.split(", ")])

        one = rows.mapInArrow(search, RESULT)
        found = one if found is None else found.unionAll(one)
    return found if found is not None else spark.createDataFrame([], RESULT)


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of the documents that contain no item; rows without an id go together."""
    bad = contained_items(docs, items).select("doc_id").distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(bad.doc_id), "left_anti")
