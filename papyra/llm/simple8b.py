"""Token ids in shard files of Simple-8b words.

A word has 64 bits: a selector in the upper 4 and ids of one width in the lower 60. A writer takes
the selector with the most ids that fit. Every block of ``BLOCK_IDS`` ids starts with a new word, so
a reader finds each block by its offset and decodes many blocks at once with array operations. An
id of more than 60 bits is an escape: a word of selector 0 whose payload counts into a list of whole
64-bit ids of its block.

File, all numbers little-endian: words; whole ids of escapes; per block the first word and the first
escape (one more entry than blocks); per document its id, and its first id in the file (one more
entry than documents); then ``FOOTER``. Shards follow each other in ascending document id.

Null texts are empty, a document always has at least its end id, equal document ids stand in the
order of their texts, a null document id comes first. An empty table gives no shard and no row.
Columns other than id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyra.llm import bpe
from papyra.llm.ship import ship

BLOCK_IDS = 1024
# Fixed values of the code: ids per word and bits per id, for selectors 1 to 14.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8BW"
FOOTER = struct.Struct("<4sIQQQQQ")  # magic, ids per block, words, escapes, blocks, documents, ids

U64 = np.uint64
_LIMITS = np.array([1 << w for w in WIDTHS.tolist()], np.uint64)
_CLASS = np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), side="right").astype(np.uint8)
_PAYLOAD = U64((1 << 60) - 1)
_BLOCKS_AT_ONCE = 512


def encode_blocks(ids: np.ndarray):
    """Words, words per block, escaped ids, escapes per block, for ids cut into blocks."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    room = BLOCK_IDS + int(COUNTS.max())
    value = np.zeros((blocks, room), np.uint64)
    flat = np.zeros(blocks * BLOCK_IDS, np.uint64)
    flat[:n] = ids
    value[:, :BLOCK_IDS] = flat.reshape(blocks, BLOCK_IDS)
    if n and int(ids.max()) < len(_CLASS):
        kind = _CLASS[value]
    else:
        kind = np.searchsorted(_LIMITS, value, side="right").astype(np.uint8)

    # largest class among the next 1, 2, 4, .. ids, then among the ids of each selector
    doubled = {1: kind}
    while (k := max(doubled)) < 32:
        wide = doubled[k].copy()
        np.maximum(wide[:, :-k], doubled[k][:, k:], out=wide[:, :-k])
        doubled[2 * k] = wide
    chosen = np.full((blocks, BLOCK_IDS), len(COUNTS), np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[s])
        k = 1 << (count.bit_length() - 1)
        near, far = doubled[k][:, :BLOCK_IDS], doubled[k][:, count - k : count - k + BLOCK_IDS]
        np.copyto(chosen, np.uint8(s), where=np.maximum(near, far) <= s)

    # walk all blocks in step: each step adds one word to every block that has ids left
    length = np.full(blocks, BLOCK_IDS)
    if blocks:
        length[-1] = n - (blocks - 1) * BLOCK_IDS
    live, at, found = np.arange(blocks), np.zeros(blocks, np.int64), []
    counts = np.append(COUNTS, 1)
    while len(live):
        s = chosen[live, at]
        found.append((live, at, s))
        at = at + counts[s]
        more = at < length[live]
        live, at = live[more], at[more]
    if not found:
        empty = np.empty(0, np.uint64)
        return empty, np.empty(0, np.int64), empty, np.empty(0, np.int64)
    block, start, selector = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(block * BLOCK_IDS + start, kind="stable")
    block, start, selector = block[order], start[order], selector[order]

    words, flat_value = np.empty(len(block), np.uint64), value.ravel()
    for s in range(len(COUNTS)):
        own = np.flatnonzero(selector == s)
        if len(own):
            packed = np.full(len(own), (s + 1) << 60, np.uint64)
            at = block[own] * room + start[own]
            for j in range(COUNTS[s]):
                packed |= flat_value[at + j] << U64(j * int(WIDTHS[s]))
            words[own] = packed
    own = np.flatnonzero(selector == len(COUNTS))
    escapes = value[block[own], start[own]]
    per_block = np.bincount(block[own], minlength=blocks)
    rank = np.arange(len(own)) - np.repeat(np.cumsum(per_block) - per_block, per_block)
    words[own] = rank.astype(np.uint64)
    return words, np.bincount(block, minlength=blocks), escapes, per_block


def decode_blocks(words, first_word, escapes, first_escape, n_ids: int) -> np.ndarray:
    """Ids of consecutive blocks; the offsets have one more entry than blocks, n_ids is their sum."""
    selector = (words >> U64(60)).astype(np.int64)
    count = np.concatenate([[1], COUNTS])[selector]
    width = np.concatenate([[60], WIDTHS])[selector].astype(np.uint64)
    per_block = np.diff(first_word)
    ends = np.cumsum(count)
    # the last word of a block may have room left over: keep BLOCK_IDS ids of each
    before = np.concatenate([[0], ends])
    starts = before[first_word[:-1] - first_word[0]]
    place = np.arange(before[-1]) - np.repeat(before[:-1], count)
    wide = np.repeat(width, count)
    ids = (np.repeat(words, count) & _PAYLOAD) >> (place.astype(np.uint64) * wide)
    ids &= (U64(1) << wide) - U64(1)
    if len(escapes):
        own = np.flatnonzero(selector == 0)
        block = np.repeat(np.arange(len(per_block)), per_block)[own]
        ids[before[own]] = escapes[first_escape[:-1][block] - first_escape[0] + words[own].astype(np.int64)]
    held = np.minimum(BLOCK_IDS, n_ids - np.arange(len(per_block)) * BLOCK_IDS)
    lengths = np.diff(np.append(starts, before[-1]))
    inside = np.arange(before[-1]) - np.repeat(starts, lengths)
    return ids[inside < np.repeat(held, lengths)]


# Spark's names of object stores and those of the file layer that writes the shards
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs",
           "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


def known_uri(uri: str) -> str:
    """The location as the file layer names it; raises for a scheme that it does not know."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme.lower() not in SCHEMES:
        raise ValueError(f"no file layer for {uri!r}; known are {', '.join(filter(None, SCHEMES))}")
    rest = "//" + rest if scheme == "file" and not rest.startswith("//") else rest
    return f"{SCHEMES[scheme.lower()]}:{rest}"


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(known_uri(uri))


class ShardWriter:
    """Appends documents to one file, whose name belongs to one attempt of a task.

    Nothing is renamed, which no object store does in one step: a file counts once the index names it."""

    def __init__(self, uri: str):
        self.fs, self.path = _file_system(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path)
        self.rest = np.empty(0, np.uint32)
        self.words, self.escapes, self.doc_ids, self.doc_lengths = [], [], [], []
        self.raw = []
        self.n_ids = 0

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.doc_lengths.append(np.diff(places))
        self.n_ids += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // BLOCK_IDS * BLOCK_IDS
        self._flush(self.rest[:whole])
        self.rest = self.rest[whole:]

    def _flush(self, ids: np.ndarray) -> None:
        step = _BLOCKS_AT_ONCE * BLOCK_IDS
        for i in range(0, len(ids), step):
            words, per_block, raw, raw_per_block = encode_blocks(ids[i : i + step])
            self.out.write(words.astype("<u8").tobytes())
            self.words.append(per_block)
            self.escapes.append(raw_per_block)
            self.raw.append(raw)

    def close(self) -> int:
        self._flush(self.rest)
        first = lambda x: np.concatenate([[0], *x]).cumsum()
        words, escapes, docs = first(self.words), first(self.escapes), first(self.doc_lengths)
        for raw in self.raw:
            self.out.write(raw.astype("<u8").tobytes())
        for table in (words, escapes, np.concatenate(self.doc_ids), docs):
            self.out.write(table.astype("<i8").tobytes())
        self.out.write(FOOTER.pack(
            MAGIC, BLOCK_IDS, words[-1], escapes[-1], len(words) - 1, len(docs) - 1, self.n_ids))
        self.out.close()
        return self.n_ids


class ShardReader:
    """Tables of one shard, and its ids a bounded number of blocks at a time."""

    def __init__(self, uri: str):
        fs, path = _file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, block_ids, n_words, n_escapes, blocks, docs, self.n_ids = FOOTER.unpack(
            self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or block_ids != BLOCK_IDS:
            raise ValueError(f"{uri} is no file of this format")
        at = n_words * 8
        tables = []
        for n, kind in ((n_escapes, "<u8"), (blocks + 1, "<i8"), (blocks + 1, "<i8"), (docs, "<i8"), (docs + 1, "<i8")):
            tables.append(np.frombuffer(self.file.read_at(n * 8, at), kind))
            at += n * 8
        self.escapes, self.first_word, self.first_escape, self.doc_ids, self.doc_first = tables

    def ids(self) -> Iterator[np.ndarray]:
        for b in range(0, len(self.first_word) - 1, _BLOCKS_AT_ONCE):
            e = min(b + _BLOCKS_AT_ONCE, len(self.first_word) - 1)
            w, x = self.first_word[b : e + 1], self.first_escape[b : e + 1]
            words = np.frombuffer(self.file.read_at(int(w[-1] - w[0]) * 8, int(w[0]) * 8), "<u8")
            n = min(self.n_ids, e * BLOCK_IDS) - b * BLOCK_IDS
            yield decode_blocks(words, w, self.escapes[x[0] : x[-1]], x, n)

    def documents(self) -> Iterator[int]:
        """The CRC-32 of the ids of each document, as unsigned 32-bit integers."""
        ends, doc, crc, at = self.doc_first[1:].tolist(), 0, 0, 0
        for ids in self.ids():
            raw, base = memoryview(ids.astype("<u4").tobytes()), at
            while doc < len(ends) and ends[doc] <= base + len(ids):
                yield zlib.crc32(raw[(at - base) * 4 : (ends[doc] - base) * 4], crc)
                at, crc, doc = ends[doc], 0, doc + 1
            if at < base + len(ids):
                crc = zlib.crc32(raw[(at - base) * 4 :], crc)
                at = base + len(ids)


INDEX = "shard long, path string, n_docs long, n_ids long"


def write_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
) -> DataFrame:
    """Encode all texts into shards below ``path``; the returned index is stored with them.

    One range shuffle by document id and text hash; the range boundaries spread any id distribution, also many
    rows of one id, and a partition's texts stream through in slices. Files of lost attempts stay, unnamed by the
    index, until the folder is cleared."""
    known_uri(path)

    def write(batches):
        writer, n_docs, shard = None, 0, TaskContext.get().partitionId()
        uri = f"{path}/shard-{shard:08d}-{uuid.uuid4().hex}.s8b"
        for part, ids, places in bpe.encoded(batches, "text", bpe.vocabulary(vocabulary)):
            writer = writer or ShardWriter(uri)
            doc_ids = part.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            writer.add(doc_ids, ids, places)
            n_docs += part.num_rows
        if writer:
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "path": [uri], "n_docs": [n_docs], "n_ids": [writer.close()]})

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    dealt = rows.withColumn("h", F.xxhash64("text"))
    ordered = dealt.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    ordered.select("doc_id", "text").mapInArrow(write, INDEX).write.mode("overwrite").parquet(f"{path}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, decoded from the shards: doc_id, start, n_tokens, ids_crc32, shard."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["path"])
                first = reader.doc_first
                ids = pa.array(reader.doc_ids, mask=reader.doc_ids == np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(first[:-1] + row["base"]), pa.array(np.diff(first)),
                     pa.array(list(reader.documents()), pa.int64()),
                     pa.array(np.full(len(ids), row["shard"]))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    index = ship(spark).read.schema(INDEX).parquet(f"{path}/index")
    shards = index.count()  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return based.repartition(max(shards, 1)).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")
