"""Cross-entropy difference of whole texts under two matched bigram models of tokens.

Tokens are the ids of a public byte-level vocabulary, so all scripts count alike. Both models share one vocabulary:
the V different tokens that all documents hold. The target model counts the tokens of the target documents, the
background model those of all documents, its counts scaled to the target's total, so that smoothing weighs alike.
With c the counts, N the target's total, h the token before w (or the start of the text) and S = ``STRENGTH``:

    p(w)     = (c(w) + S / V) / (N + S)
    p(w | h) = (c(h w) + S * p(w)) / (c(h) + S)

A document's score is the mean over its tokens of target loss less background loss, in nats: the lower, the more it
is like the target.

All documents are encoded once and written as chunks of about ``CHUNK_TOKENS`` tokens (a text is never cut). Bigrams
are counted within tasks before they are shuffled, and their table, which grows with the corpus, stays distributed.
To score, each chunk asks for each of its different bigrams once; the join gives their loss differences, which go
to the chunk's own group. So a frequent bigram has one row per chunk, and as it is one of very many in each, no
key holds a large share of the join. Token counts have at most one row per vocabulary entry, which is why they may be
broadcast. Nothing else is, and the driver sees three numbers.

Null and empty texts have 0 tokens and no score (null). Without target documents all scores are 0, as the models
are equal. Repeated rows are counted and scored as often as they occur; a document is a target if any row of the
targets names it, and null ids name nothing. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm import bpe
from papyra.llm import textbytes as tb
from papyra.llm.ship import ship
from papyra.session import scratch

STRENGTH = 8.0
CHUNK_TOKENS = 1 << 20
START = (1 << 31) - 1  # stands before the first token of a text
_HELD = 1 << 21


def _width(path: str):
    """Smallest type that holds every id of the vocabulary."""
    return np.uint16 if bpe.Encoder.of(path).tokenizer.get_vocab_size() <= 1 << 16 else np.uint32


def _binary(values: np.ndarray, places: np.ndarray) -> pa.Array:
    """One binary value per text; a slice's ids stay far below the 2 GiB that its offsets can tell."""
    offsets = pa.py_buffer((places * values.itemsize).astype(np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, offsets, pa.py_buffer(values)]).cast(pa.binary())


def tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """chunk, doc_id, ids: every whole text as the bytes of its token ids; written and read again."""
    spark = ship(docs.sparkSession)

    def run(batches):
        path = bpe.vocabulary(vocabulary)
        encoder, width = bpe.Encoder.of(path), _width(path)
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in tb.slices(batch, "text"):
                ids, places = encoder.encode(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, chunk, np.int64)), part.column(0), _binary(ids.astype(width), places)],
                    names=["chunk", "doc_id", "ids"])
                size += len(ids)
                if size >= CHUNK_TOKENS:
                    chunk, size = chunk + 1, 0
            tb.give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    path = scratch(spark, "lm_tokens")
    schema = f"chunk long, doc_id {kind}, ids binary"
    docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def grams(column: pa.Array | pa.ChunkedArray, width) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of all texts in a row, the token before in the upper half, and the n + 1 places of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]
    word = np.frombuffer(data.tobytes(), width).astype(np.int64)
    places = (places - places[0]) // np.dtype(width).itemsize
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[places[:-1][np.diff(places) > 0]] = START
    return before << 32 | word, places


def _merged(parts):
    codes = np.concatenate([p[0] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, int)
    sums = [np.add.reduceat(np.concatenate([p[i] for p in parts])[order], first) if len(first) else np.empty(0, np.int64) for i in (1, 2)]
    return codes[first], *sums


def _rows(codes, target, every):
    for i in range(0, len(codes), 1 << 16):
        own = slice(i, i + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes[own]), pa.array(target[own]), pa.array(every[own])], names=["gram", "target", "every"])


def gram_counts(encoded: DataFrame, targets: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """gram, target, every: counts of all bigrams; ``targets`` holds the doc_id of the target documents."""
    ship(encoded.sparkSession)

    def run(batches):
        width = _width(bpe.vocabulary(vocabulary))
        parts, size = [], 0
        for batch in batches:
            # a batch's texts one run of rows after the other, so that memory follows a run and not the batch
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                code, places = grams(part.column(0), width)
                wanted = np.repeat(part.column(1).to_numpy(zero_copy_only=False), np.diff(places)).astype(np.int64)
                parts.append(_merged([(code, wanted, np.ones(len(code), np.int64))]))
                size += len(parts[-1][0])
                if size > _HELD:
                    parts = [_merged(parts)]
                    size = len(parts[0][0])
                    if size > _HELD // 2:  # too many different ones to be held: the shuffle sums them up
                        yield from _rows(*parts[0])
                        parts, size = [], 0
        if parts:
            yield from _rows(*_merged(parts))
        tb.give_back()

    wanted = targets.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("is_target", F.lit(True))
    # the targets grow with the documents, so they are joined by a shuffle and never broadcast
    flagged = encoded.join(wanted.hint("merge"), "doc_id", "left").select("ids", F.coalesce("is_target", F.lit(False)).alias("target"))
    return flagged.mapInArrow(run, "gram long, target long, every long").groupBy("gram").agg(
        F.sum("target").alias("target"), F.sum("every").alias("every"))


def loss_differences(counts: DataFrame) -> DataFrame:
    """gram, loss: target loss less background loss of every bigram of ``counts``, a written table."""
    token, before = F.expr("cast(gram & 4294967295 as int)"), F.expr("cast(gram >> 32 as int)")
    rows = counts.select("gram", "target", "every", token.alias("token"), before.alias("before"))
    of_token = rows.groupBy("token").agg(F.sum("target").alias("token_target"), F.sum("every").alias("token_every"))
    of_before = rows.groupBy("before").agg(F.sum("target").alias("before_target"), F.sum("every").alias("before_every"))
    n_target, n_every, size = of_token.agg(F.sum("token_target"), F.sum("token_every"), F.count("*")).first()
    if not n_target:
        return counts.select("gram", F.lit(0.0).alias("loss"))

    def log_p(kind, scale):
        low = (F.col(f"token_{kind}") * scale + STRENGTH / size) / (n_target + STRENGTH)
        return F.log((F.col(kind) * scale + STRENGTH * low) / (F.col(f"before_{kind}") * scale + STRENGTH))

    joined = rows.join(F.broadcast(of_token), "token").join(F.broadcast(of_before), "before")
    return joined.select("gram", (log_p("every", n_target / n_every) - log_p("target", 1.0)).alias("loss"))


def score_tokens(encoded: DataFrame, losses: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, n_tokens and score of every row of ``encoded``."""
    ship(encoded.sparkSession)

    def different(batches):
        width = _width(bpe.vocabulary(vocabulary))
        chunk, parts = None, []

        def found():
            codes = np.unique(np.concatenate(parts))
            for i in range(0, len(codes), 1 << 16):
                own = codes[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), chunk, np.int64)), pa.array(own)], names=["chunk", "gram"])

        for batch in batches:
            chunks = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])) if len(chunks) else []
            for a, b in zip(edges, [*edges[1:], len(chunks)]):
                if chunks[a] != chunk:
                    if parts:
                        yield from found()
                    chunk, parts = int(chunks[a]), []
                parts.append(np.unique(grams(batch.column(1).slice(a, b - a), width)[0]))
        if parts:
            yield from found()
        tb.give_back()

    def means(texts: pa.Table, known: pa.Table) -> pa.Table:
        width = _width(bpe.vocabulary(vocabulary))
        code, places = grams(texts.column("ids"), width)
        gram, loss = known.column("gram").to_numpy(), known.column("loss").to_numpy()
        order = np.argsort(gram)
        total = np.zeros(len(code) + 1)
        if len(code):
            np.cumsum(loss[order][np.searchsorted(gram, code, sorter=order)], out=total[1:])
        n = np.diff(places)
        mean = (total[places[1:]] - total[places[:-1]]) / np.maximum(n, 1)
        return pa.Table.from_arrays(
            [texts.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(mean, mask=n == 0)], names=["doc_id", "n_tokens", "score"])

    asked = encoded.select("chunk", "ids").mapInArrow(different, "chunk long, gram long")
    answers = asked.join(losses, "gram").select("chunk", "gram", "loss")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        means, f"doc_id {kind}, n_tokens long, score double")


def score(docs: DataFrame, targets: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, n_tokens and score of every document; ``targets`` holds the doc_id of the target documents."""
    spark = docs.sparkSession
    encoded = tokens(docs, vocabulary)
    path = scratch(spark, "lm_counts")
    gram_counts(encoded, targets, vocabulary).write.parquet(path)
    counts = spark.read.schema("gram long, target long, every long").parquet(path)
    return score_tokens(encoded, loss_differences(counts), vocabulary)
