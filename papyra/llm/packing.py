"""Cost-balanced packing of token ids into sequences of at most ``capacity`` tokens.

A piece of n ids costs ``LINEAR * n + QUADRATIC * n * n`` (feed-forward work plus attention within
the piece). Documents longer than the capacity are cut into pieces of it and a rest. Pieces go in
descending cost to the sequence with the lowest cost so far that has room for them; when none
has, the piece is cut and the cheapest is filled, and its rest waits its turn. Open sequences lie in heaps by
the room they have left, and a tree over these finds the cheapest with at least so much room.
As many sequences are opened as the ids fill completely; what is left over (under one capacity)
goes to sequences whose lengths are powers of two, which need no padding.

Each Spark task packs its own documents in groups of ``GROUP_IDS`` ids, so nothing is shuffled and
memory is bounded. sequence_id joins the task's partition and a number counted within it: the
same input partition always gets the same ids.

Null or empty texts are packed as their end id alone. Repeated rows are packed as often as they
occur. Ties in cost keep the order of the rows. An empty table gives no pieces. Columns other than
id and text are not read.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm import bpe
from papyra.llm.ship import ship

CAPACITY = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 512
GROUP_IDS = 1 << 21
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, cost double"
)


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


class _Open:
    """Open sequences by the room they have left: one heap for each, and a tree of the least (cost, sequence)."""

    def __init__(self, count: int, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps = [[] for _ in range(capacity + 1)]
        self.heaps[capacity] = [(0.0, s) for s in range(count)]
        self.least = [_NONE] * (2 * self.size)
        self._renew(capacity)

    def _renew(self, room: int) -> None:
        i, least = room + self.size, self.least
        least[i] = self.heaps[room][0] if self.heaps[room] else _NONE
        while i > 1:
            i >>= 1
            least[i] = min(least[2 * i], least[2 * i + 1])

    def cheapest(self, n: int):
        """(cost, sequence) of the cheapest with room for n, or _NONE."""
        best, i = self.least[n + self.size], n + self.size
        while i > 1:
            if not i & 1:
                best = min(best, self.least[i + 1])
            i >>= 1
        return best

    def take(self, room: int):
        heapq.heappop(self.heaps[room])
        self._renew(room)

    def put(self, room: int, entry) -> None:
        heapq.heappush(self.heaps[room], entry)
        self._renew(room)


_NONE = (float("inf"), -1)


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; every token is in exactly one."""
    total = sum(lengths)
    waiting = []  # (-length, order, document, start): the dearest piece first
    for doc, n in enumerate(lengths):
        for start in range(0, n, capacity):
            waiting.append((-min(capacity, n - start), len(waiting), doc, start))
    heapq.heapify(waiting)
    order = len(waiting)
    used = [0] * (total // capacity)
    open_ = _Open(len(used), capacity)
    pieces = []

    def put(doc, start, n, sequence):
        pieces.append((doc, start, n, sequence, used[sequence]))
        used[sequence] += n

    while waiting:
        size, _, doc, start = waiting[0]
        n = -size
        c, s = open_.cheapest(n)
        if s < 0:
            c, s = open_.cheapest(1)
            if s < 0:
                break
        heapq.heappop(waiting)
        room = capacity - used[s]
        open_.take(room)
        if room < n:
            order += 1
            heapq.heappush(waiting, (room - n, order, doc, start + room))
            n = room
        put(doc, start, n, s)
        if used[s] < capacity:
            open_.put(capacity - used[s], (c + cost(n), s))

    left, room = total - len(used) * capacity, 0
    for size, _, doc, start in sorted(waiting):
        n = -size
        while n:
            if not room:
                room = 1 << (left.bit_length() - 1)
                used.append(0)
            k = min(n, room)
            put(doc, start, k, len(used) - 1)
            start, n, room, left = start + k, n - k, room - k, left - k if room == k else left
            if not room:
                left = total - sum(used)
    return pieces


def pack_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of all documents, one row each."""

    def packed(group, base):
        doc_ids = np.concatenate([g[0] for g in group])
        valid = np.concatenate([g[1] for g in group])
        ids = np.concatenate([g[2] for g in group]).astype("<u4")
        lengths = np.concatenate([g[3] for g in group])
        first = np.concatenate([[0], np.cumsum(lengths)])
        pieces = np.array(pack(lengths.tolist(), capacity), np.int64).reshape(-1, 5)
        doc, start, n, sequence, offset = pieces.T
        raw = memoryview(ids.tobytes())
        at = (first[doc] + start) * 4
        crc = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), n.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids[doc], mask=~valid[doc]), *map(pa.array, (start, n)),
             pa.array(crc, pa.int64()),
             *map(pa.array, (lengths[doc], sequence + base, offset, LINEAR * n + QUADRATIC * n * n))],
            names=[x.split()[0] for x in PIECES.split(", ")]), int(sequence.max()) + 1

    def run(batches):
        group, size, base = [], 0, TaskContext.get().partitionId() << 40
        for part, ids, places in bpe.encoded(batches, "text", bpe.vocabulary(vocabulary)):
            column = part.column(0)
            group.append((column.fill_null(0).to_numpy(zero_copy_only=False),
                          np.asarray(column.is_valid()), ids, np.diff(places)))
            size += len(ids)
            if size >= GROUP_IDS:
                out, n = packed(group, base)
                yield out
                group, size, base = [], 0, base + n
        if group:
            yield packed(group, base)[0]

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)
