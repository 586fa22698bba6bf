"""Language of whole texts: a small convolutional network over bytes, trained and run in numpy.

Input: windows of ``WINDOW`` bytes (A-Z as a-z) that follow each other without gaps, the last one padded
with spaces. Filters of each width in ``WIDTHS`` see consecutive bytes, one weight per byte value,
offset and filter; the highest response of each filter in a window (max pooling) feeds one softmax
layer. A document's score is the mean of its windows' probabilities, each weighted by its bytes, so
every byte of the text counts.

Training uses at most about ``PER_LABEL`` rows of each label (all rows if there are fewer; the share
of a larger label is taken by a hash of doc_id) and ``TRAIN_WINDOWS`` windows of each. That sample
is the only bounded one; a label that occurs once is still learned.

Texts that are null or hold no letter are ``und`` with score 0. If there is nothing to learn from,
every text is ``und``. Ties go to the label that sorts first. Repeated rows are predicted alike; an
empty table gives no rows. lang, source and doc_id never enter a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LABEL = 1500
TRAIN_WINDOWS = 4
STEPS, BATCH, RATE = 1500, 96, 0.02
UNKNOWN = "und"

_LOWER = np.arange(256)
_LOWER[65:91] += 32


class Network:
    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.filters = [rng.normal(0, 0.15, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def fit(self, windows: np.ndarray, label: np.ndarray, seed: int = 7) -> "Network":
        """Stochastic gradient steps with per-weight rates (Adagrad) on windows (n x WINDOW bytes)."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(label == i) for i in range(len(self.labels))]
        weights = [*self.filters, self.out, self.bias]
        sums = [np.full_like(w, 1e-4) for w in weights]
        for _ in range(STEPS):
            # all labels alike, however rare
            own = np.array([rng.choice(by_label[i]) for i in rng.integers(0, len(by_label), BATCH)])
            x, y = windows[own].astype(np.int64), label[own]
            pooled, where = [], []
            for w, f in zip(WIDTHS, self.filters):
                n = WINDOW - w + 1
                response = f[0][x[:, :n]]
                for j in range(1, w):
                    response = response + f[j][x[:, j : j + n]]
                at = response.argmax(axis=1)
                where.append(at)
                pooled.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            hidden = np.concatenate(pooled, axis=1)
            active = np.maximum(hidden, 0)
            p = _softmax(active @ self.out + self.bias)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ self.out.T) * (hidden > 0)
            gradients = []
            for g, (w, f) in enumerate(zip(WIDTHS, self.filters)):
                d = np.zeros_like(f)
                part = back[:, g * FILTERS : (g + 1) * FILTERS]
                for j in range(w):
                    byte = np.take_along_axis(x, where[g] + j, axis=1)
                    np.add.at(d[j], (byte, np.arange(FILTERS)), part)
                gradients.append(d)
            gradients += [active.T @ p, p.sum(axis=0)]
            for value, total, d in zip(weights, sums, gradients):
                total += d * d
                value -= RATE * d / np.sqrt(total)
        return self

    def tables(self):
        """Responses to pairs and to single bytes as whole numbers of 8 bits, all filters of a width
        in one 64-bit entry: a filter of width 4 costs two look-ups. No sum can leave 8 bits."""
        out = []
        for w, f in zip(WIDTHS, self.filters):
            parts = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, w - 1, 2)]
            parts += [f[w - 1]] * (w % 2)
            scale = 124 / sum(float(np.abs(p).max()) for p in parts)
            packed = [np.ascontiguousarray(np.rint(p * scale).astype(np.int8)).view(np.uint64)[:, 0] for p in parts]
            out.append((w, packed, scale))
        return out

    def probabilities(self, windows: np.ndarray, tables=None) -> np.ndarray:
        x = windows.astype(np.int32)
        pair = (x[:, :-1] << 8) | x[:, 1:]
        pooled = []
        for w, packed, scale in tables or self.tables():
            n = WINDOW - w + 1
            response = None
            for j, table in enumerate(packed):
                at = (pair if len(table) == 65536 else x)[:, 2 * j : 2 * j + n]
                part = np.take(table, at).view(np.int8).reshape(len(x), n, FILTERS)
                response = part if response is None else np.add(response, part, out=response)
            pooled.append(response.max(axis=1) / np.float32(scale))
        return _softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def text_windows(data: np.ndarray, offsets: np.ndarray):
    """All windows of all texts, the text of each, and its bytes."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), count)
    start = np.repeat(offsets[:-1], count) + WINDOW * tb.gather_ranges(np.zeros(len(count), np.int64), count)
    held = np.minimum(WINDOW, np.repeat(offsets[1:], count) - start)
    padded = np.concatenate([_LOWER[data].astype(np.uint8), np.full(WINDOW, 32, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start].copy() if len(start) else np.empty((0, WINDOW), np.uint8)
    windows[np.arange(WINDOW) >= held[:, None]] = 32
    return windows, text, held


def train(rows: DataFrame, label: str = "lang", text: str = "text", by: str = "doc_id") -> Network | None:
    """Learn from the rows with a label and a letter; None if there are none."""
    ship(rows.sparkSession)
    usable = rows.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, PER_LABEL / n))])
    spot = F.pmod(F.xxhash64(F.lit("langid"), by), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(spot < share[F.col(label)])
    labels = sorted(counts)
    windows, owners = [], []

    def pick(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                found, owner, held = text_windows(*tb.text_buffer(part.column(1)))
                rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
                total = np.bincount(owner, minlength=part.num_rows)[owner]
                # the first windows of TRAIN_WINDOWS equal stretches of the text
                step = np.maximum(total / TRAIN_WINDOWS, 1)
                chosen = np.flatnonzero(np.floor(rank / step) != np.floor((rank - 1) / step))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner[chosen])), pa.array([x.tobytes() for x in found[chosen]], pa.binary())],
                    names=["label", "window"])

    chosen = sample.select(F.col(label).alias("label"), F.col(text).alias("text")).mapInArrow(pick, "label string, window binary")
    for row in chosen.orderBy(F.xxhash64("window", "label")).collect():
        windows.append(np.frombuffer(bytes(row.window), np.uint8))
        owners.append(labels.index(row.label))
    return Network(labels).fit(np.array(windows), np.array(owners))


def predict(rows: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The rows with lang_pred and score added (or replaced)."""
    spark = ship(rows.sparkSession)
    sent = spark.sparkContext.broadcast(network)

    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("lang_pred", "score")]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    shaped = rows.select(*kept, F.when(letters, F.col(text)).alias("__text"))
    schema = shaped.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        network = sent.value
        tables = network.tables() if network else None
        for batch in batches:
            for part in tb.slices(batch, "__text", 1 << 19):
                column = part.column(part.num_columns - 1)
                names, scores = _guesses(network, tables, column)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score"])

    return shaped.mapInArrow(run, schema)


def _guesses(network, tables, column):
    n = len(column)
    if network is None:
        return [UNKNOWN] * n, np.zeros(n)
    data, offsets = tb.text_buffer(column)
    windows, owner, held = text_windows(data, offsets)
    total = np.zeros((n, len(network.labels)))
    for i in range(0, len(windows), 512):
        p = network.probabilities(windows[i : i + 512], tables) * held[i : i + 512, None]
        np.add.at(total, owner[i : i + 512], p)
    size = np.diff(offsets)
    total /= np.maximum(size, 1)[:, None]
    best = total.argmax(axis=1)
    score = np.minimum(total[np.arange(n), best], 1.0)
    names = np.array(network.labels, object)[best]
    names[size == 0] = UNKNOWN
    score[size == 0] = 0.0
    return names.tolist(), score


def held_out(by: Column) -> Column:
    """Rows that are kept for measuring: the CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(by.cast("string")) % 4 == 2, F.lit(False))
