"""Periodic runs of words: block convolution at dyadic scales, then exact extension.

A run is a stretch of at least ``max(LEAST_LENGTH, 3 * period)`` words in which words one period apart are the
same, that has no smaller period and that no neighbouring word extends.

Scale B looks for periods from B to 2B - 1 (8 is the smallest scale, which has a second pass for periods 1 to 7).
Every text is cut into blocks of B words. A run with such a period holds a whole block and its next
copy, because it has three periods. Words become residues modulo a prime; for each block b the
sums of squared differences with its following window, at all distances at once, are
sum b^2 + sum w^2 - 2 (b correlated with w), the last by number-theoretic transforms of length 2B. A sum of zero is
an occurrence. Occurrences of neighbouring blocks at one distance are one chain, and a chain is extended by less than a block at each
end, as the next block there did not match. The words themselves are compared in that extension and over every
run found; should a zero have come from different words (a chance of one in two billion per sum), the text is
searched again with other residues, so the result is exact.

A block is transformed only if some of its words, probed one by one, come again in the window, and not if
block and window lie in a run of half the scale's period or less, which explains all its
occurrences. Occurrences at multiples of a known run's period inside that run are dropped, so a
text of one repeated word costs no more than any other. Time is about n log(n)^2 in the words of a text, memory a few dozen bytes per word.

A null text or one without words has no runs and an empty collapsed text. Rows are independent:
repeated rows each give a row, rows without doc_id too; an empty table gives no rows; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship

LEAST_LENGTH = 24
SMALLEST = 8
SLICE_BYTES = 1 << 20
CHUNK = 1 << 17  # residues in one batch of transforms
# The prime 15 * 2**27 + 1 and a primitive root of it.
PRIME, PRIMITIVE_ROOT = 2013265921, 31
LARGEST_SCALE = 1 << 26  # its transforms are the longest the prime has

U64 = np.uint64
_P = U64(PRIME)
_twiddles: dict[tuple[int, bool], list[np.ndarray]] = {}


def _roots(size: int, inverse: bool) -> list[np.ndarray]:
    """Factors of each halving step of a transform; only short ones are kept."""
    if (size, inverse) in _twiddles:
        return _twiddles[size, inverse]
    root = pow(PRIMITIVE_ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    half = size // 2
    powers = np.ones(max(half, 1), np.uint64)
    done = 1
    while done < half:
        more = min(done, half - done)
        powers[done : done + more] = powers[:more] * U64(pow(root, done, PRIME)) % _P
        done += more
    steps, step = [], 1
    while step < size:
        steps.append(powers[::step][:, None])
        step *= 2
    if size <= 4096:
        _twiddles[size, inverse] = steps
    return steps


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row; the length is a power of two. Not scaled when inverse."""
    n, size = rows.shape
    held, other = np.array(rows, np.uint64), np.empty((n, size), np.uint64)
    step = 1
    for factor in _roots(size, inverse):
        half = size // (2 * step)
        source, target = held.reshape(n, 2, half, step), other.reshape(n, half, 2, step)
        a, b = source[:, 0], source[:, 1]
        total = a + b
        np.minimum(total, total - _P, out=target[:, :, 0])  # below the prime the difference wraps round
        total = a + (_P - b)
        total *= factor
        np.remainder(total, _P, out=target[:, :, 1])
        held, other = other, held
        step *= 2
    return held


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences modulo the prime of each block (B) with its window (2B) at distances 0..B-1."""
    n, size = blocks.shape
    # the block turned round in a cycle of 2B: its product with the window is the correlation
    turned = np.zeros((n, 2 * size), np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, size + 1 :] = blocks[:, :0:-1]
    product = transform(turned)
    product *= transform(windows)
    product %= _P
    shared = transform(product, inverse=True)[:, :size]
    scale = U64((PRIME - 2) * pow(2 * size, PRIME - 2, PRIME) % PRIME)
    shared = shared * scale % _P  # minus two times the correlation
    sums = np.zeros((n, 2 * size + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=sums[:, 1:])
    own = (blocks * blocks % _P).sum(axis=1)
    return (own[:, None] + (sums[:, size : 2 * size] - sums[:, :size]) + shared) % _P


class _Found:
    """Runs found so far, in places of the whole slice."""

    def __init__(self):
        self.start, self.end, self.period = (np.empty(0, np.int64) for _ in range(3))

    def add(self, start, end, period) -> None:
        start, end, period = (np.concatenate(x) for x in ((self.start, start), (self.end, end), (self.period, period)))
        # a stretch found with several periods is a run of the smallest
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        self.start, self.end, self.period = start[first], end[first], period[first]

    def around(self, start, end, longest: int) -> np.ndarray:
        """Period of the run that holds each stretch, among periods up to ``longest``; 0 for none."""
        short = self.period <= longest
        s, e, p = self.start[short], self.end[short], self.period[short]
        if not len(s) or not len(start):
            return np.zeros(len(start), np.int64)
        best = np.maximum.accumulate(e)
        # the place of the run that reaches furthest so far
        which = np.maximum.accumulate(np.where(e == best, np.arange(len(e)), 0))
        at = np.searchsorted(s, start, side="right") - 1
        got = which[np.maximum(at, 0)]
        return np.where((at >= 0) & (e[got] >= end), p[got], 0)


def _blocks(first: np.ndarray, size: int, shift: int) -> np.ndarray:
    """Starts of the blocks that have a whole copy at distance ``shift`` or more in their text."""
    n = np.diff(first)
    count = np.where(n >= max(LEAST_LENGTH, 3 * shift), (n - max(shift, 1)) // size, 0)
    return np.repeat(first[:-1], count) + size * tb.gather_ranges(np.zeros(len(n), np.int64), count)


class _Places:
    """Where each word comes, for the question whether it comes again within some distances."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.span = ids, len(ids) + 1
        self.keys = np.sort(ids * self.span + np.arange(len(ids)))

    def again(self, at: np.ndarray, low: int, high: int) -> np.ndarray:
        wanted = self.ids[at] * self.span + at
        place = np.searchsorted(self.keys, wanted + low)
        place[place == len(self.keys)] = 0
        got = self.keys[place] - wanted
        return (got >= low) & (got <= high) if len(self.keys) else np.zeros(len(at), bool)


def _occurrences(places, values, blocks, size: int, shift: int, found: _Found):
    """Starts and distances of the occurrences of blocks at distances shift .. shift + size - 1."""
    if size > SMALLEST:
        blocks = blocks[found.around(blocks, blocks + 3 * size, size // 2) == 0]
    low, high = max(shift, 1), shift + size - 1
    for probe in (0, size - 1, size // 2, size // 4, size // 4 * 3):
        blocks = blocks[places.again(blocks + probe, low, high)]
    starts, distances = [], []
    step = max(1, CHUNK // (2 * size))
    for i in range(0, len(blocks), step):
        own = blocks[i : i + step, None]
        left = mismatches(values[own + np.arange(size)], values[own + shift + np.arange(2 * size)])
        row, distance = np.nonzero(left == 0)
        starts.append(own[row, 0])
        distances.append(distance + shift)
    start = np.concatenate(starts) if starts else np.empty(0, np.int64)
    distance = np.concatenate(distances) if distances else np.empty(0, np.int64)
    real = distance > 0
    start, distance = start[real], distance[real]
    known = found.around(start, start + size + distance, size)
    fresh = (known == 0) | (distance % np.maximum(known, 1) != 0)
    return start[fresh], distance[fresh]


def _reach(ids, at, distance, limit, step: int) -> np.ndarray:
    """How many words from ``at`` on (step 1) or back (-1) equal the word a distance on, at most ``limit``."""
    reach, active, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    while len(active):
        goes_on = []
        for part in np.array_split(active, max(1, len(active) * width // CHUNK)):
            steps = reach[part, None] + np.arange(width)
            inside = steps < limit[part, None]
            place = np.where(inside, at[part, None] + step * steps, 0)
            same = inside & (ids[place] == ids[np.where(inside, place + distance[part, None], 0)])
            run = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
            reach[part] += run
            goes_on.append(part[run == width])
        active = np.concatenate(goes_on)
        width = min(2 * width, 4096)
    return reach


def _extended(ids, first, start, distance, size: int):
    """Longest stretches around the occurrences: start, end and distance."""
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    opens = np.ones(len(start), bool)
    opens[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size)
    text = np.searchsorted(first, start, side="right") - 1
    opens[1:] |= text[1:] != text[:-1]
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(start)) - 1
    begin, end, distance, text = start[heads], start[tails] + size, distance[heads], text[heads]
    left = _reach(ids, begin - 1, distance, np.minimum(begin - first[text], size), -1)
    right = _reach(ids, end, distance, np.minimum(first[text + 1] - end - distance, size), 1)
    return begin - left, end + right + distance, distance


def _all_equal(ids, start, end, period) -> bool:
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
        if not np.array_equal(ids[s : e - p], ids[s + p : e]):
            return False
    return True


def find_runs(ids: np.ndarray, first: np.ndarray):
    """Start, end and period of every run, by start and period.

    ``ids`` are the words of several texts one after the other as numbers from 0 to their count, no number in two texts; ``first``
    has the n + 1 places where the texts begin.
    """
    longest = int(np.diff(first).max()) if len(first) > 1 else 0
    if longest >= 6 * LARGEST_SCALE:
        raise ValueError(f"a text of {longest} words is too long")
    places, seed = _Places(ids), 0
    while True:
        found, top = _Found(), max(longest, LEAST_LENGTH)
        marks = tb.mix((np.arange(len(ids) + 1, dtype=np.uint64) + U64(1)) * U64(2 * seed + 1)) % _P
        values = np.concatenate([marks[ids], np.full(3 * top, marks[-1])])
        size, shift = SMALLEST, 0
        while max(LEAST_LENGTH, 3 * shift) <= longest:
            start, distance = _occurrences(places, values, _blocks(first, size, shift), size, shift, found)
            if len(start):
                begin, end, period = _extended(ids, first, start, distance, size)
                long = end - begin >= np.maximum(LEAST_LENGTH, 3 * period)
                found.add(begin[long], end[long], period[long])
            size, shift = (size, size) if shift == 0 else (2 * size, 2 * size)
        if _all_equal(ids, found.start, found.end, found.period):
            order = np.lexsort((found.period, found.start))
            return found.start[order], found.end[order], found.period[order]
        seed += 1


def word_ids(texts: list[list[bytes]]):
    """Numbers of the words and the n + 1 places of the texts; equal words of a text have equal numbers."""
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=first[1:])
    ids = np.empty(int(first[-1]), np.int64)
    for text, a in zip(texts, first.tolist()):
        number = dict(zip(reversed(text), range(a + len(text) - 1, a - 1, -1)))
        ids[a : a + len(text)] = np.fromiter(map(number.__getitem__, text), np.int64, len(text))
    return ids, first


def _runs(batches):
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for part in tb.slices(batch, "text", SLICE_BYTES):
            data, offsets = tb.text_buffer(part.column(1))
            whole = data.tobytes()
            # bytes.split cuts at the six white-space bytes of the word rule and nothing else
            texts = [whole[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            ids, first = word_ids(texts)
            start, end, period = find_runs(ids, first)
            edge = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, end, -1)
            kept = np.cumsum(edge[:-1]) == 0
            at = np.searchsorted(start, first)
            collapsed = []
            for i, text in enumerate(texts):
                if at[i] < at[i + 1]:
                    text = [text[j] for j in np.flatnonzero(kept[first[i] : first[i + 1]]).tolist()]
                collapsed.append(b" ".join(text))
            own = np.repeat(first[:-1], np.diff(at))
            runs = pa.StructArray.from_arrays(
                [pa.array(start - own), pa.array(end - start), pa.array(period)], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), runs),
                 pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed: the words that no run
    repeats, joined by one space. One row per row of docs."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_runs, RESULT)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period. Null for no run."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.reduce(runs, none, lambda best, run: F.when(better(best, run), run).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by h = crc32(doc_id) is made periodic from word g % n on, with
    g = h // 10 and a period of 1 + (n - g % n) // (3 + g % 8) words."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", h).withColumn("words", F.when((F.col("h") % 10 == 0), words))
    g, n = F.expr("h div 10"), F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(F.size("words") > 0, g % n))
    rows = rows.withColumn("p", F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)"))
    woven = F.expr("""array_join(transform(words, (w, i) ->
        CASE WHEN i < a THEN w ELSE words[cast(a + (i - a) % p as int)] END), ' ')""")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), woven).otherwise(F.col("text")).alias("text"))
