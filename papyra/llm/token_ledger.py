"""Token totals by source, language and tokenizer version, maintained from signed changes.

A batch of changes is committed once under its own name:

* insert: a document with its count (of a known document: a revision);
* revise: a new count, source or language of a document (of an unknown one: an insert);
* delete: the document's id and tokenizer version only (of an unknown one: no change).

A commit looks up what the ledger holds of the changed documents and writes signed rows: the old state
negative, the new one positive. Rows lie in ``BUCKETS`` folders by a hash of document and version, and a commit reads
only the buckets it touches, cut down to its own documents before anything is summed: a small batch does not
pay for the history of all others. Rows and the sums over them, by group, go into folders named by the
batch; the last step writes the batch's commit record. Readers see committed batches only, a batch that is
committed again does nothing, and one that broke off is written anew over its remains. Totals are sums
over the small per-batch sums, never over documents. ``compact`` folds the document rows of all batches into
one per document and version; totals do not change by it.

If a batch names a document and version more than once, the change with the highest ``seq`` counts, then
delete before revise before insert, then the highest count. Rows without doc_id or tokenizer version
are left out. A null source or language is a group of its own; a null count is 0. Groups without
documents are not reported. Columns other than those named are not read. An empty batch commits.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm import bpe
from papyra.llm.ship import ship

GROUP = ["source", "lang", "tokenizer"]
ROWS = "doc_id long, tokenizer string, source string, lang string, sign int, tokens long, chars long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long, chars long"
COMMITS = "batch string, rows long"
KEY = ["doc_id", "tokenizer"]
BUCKETS = 64


def _bucket():
    return F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int").alias("bucket")


def _held(rows: DataFrame) -> DataFrame:
    sums = [F.sum(F.col("sign") * F.col(c)).alias(c) for c in ("tokens", "chars")]
    return rows.groupBy("doc_id", *GROUP).agg(F.sum("sign").alias("held"), *sums).where("held > 0").drop("held")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self) -> list[str]:
        """Names of the committed batches: one small record each."""
        try:
            return sorted(r.batch for r in self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits/*").collect())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _read(self, part: str, schema: str) -> DataFrame:
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path}/{part}"
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/batch={b}" for b in batches])

    def documents(self) -> DataFrame:
        """What the ledger holds now: one row per document and tokenizer version."""
        return _held(self._read("rows", f"{ROWS}, bucket int"))

    def documents_of(self, keys: DataFrame) -> DataFrame:
        """What the ledger holds of some documents (doc_id, tokenizer, bucket); other buckets are not read."""
        touched = [r.bucket for r in keys.select("bucket").distinct().collect()]  # BUCKETS numbers at most
        rows = self._read("rows", f"{ROWS}, bucket int").where(F.col("bucket").isin(touched))
        return _held(rows.join(keys.select("bucket", *KEY), ["bucket", *KEY], "left_semi"))

    def totals(self) -> DataFrame:
        return self._read("totals", TOTALS).groupBy(*GROUP).agg(
            *[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")]).where("docs <> 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """``changes`` has doc_id, tokenizer, op, seq, source, lang, tokens and chars."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch is named by letters, digits, - and _")
        if batch in self.committed():
            return False
        rank = F.when(F.col("op") == "delete", 2).when(F.col("op") == "revise", 1).otherwise(0)
        value = F.struct("seq", rank.alias("rank"), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("tokens", "chars")],
                         F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
        last = changes.where("doc_id IS NOT NULL AND tokenizer IS NOT NULL").groupBy(
            F.col("doc_id").cast("long").alias("doc_id"), "tokenizer").agg(F.max(value).alias("new"))
        last = last.select("*", _bucket())
        pending = f"{self.path}/pending/{batch}"
        last.write.mode("overwrite").parquet(pending)
        last = self.spark.read.schema(last.schema).parquet(pending)
        old = self.documents_of(last).select(
            "doc_id", "tokenizer", F.struct("tokens", "chars", "source", "lang").alias("old"))
        both = last.join(old, ["doc_id", "tokenizer"], "left")
        row = lambda s, sign: F.struct(
            F.lit(sign).alias("sign"), *[F.col(f"{s}.{c}").alias(c) for c in ("source", "lang", "tokens", "chars")])
        parts = F.array(
            F.when(F.col("old").isNotNull(), row("old", -1)), F.when(F.col("new.rank") < 2, row("new", 1)))
        signed = both.select("doc_id", "tokenizer", F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("r")).select(
            "doc_id", "tokenizer", "r.source", "r.lang", "r.sign", "r.tokens", "r.chars")
        own = f"{self.path}/rows/batch={batch}"
        signed.select("*", _bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(own)
        written = self.spark.read.schema(ROWS).parquet(own)
        written.groupBy(*GROUP).agg(
            F.sum("sign").cast("long").alias("docs"), *[F.sum(F.col("sign") * F.col(c)).alias(c) for c in ("tokens", "chars")]
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals/batch={batch}")
        record = written.agg(F.lit(batch).alias("batch"), F.count("*").alias("rows"))
        record.write.mode("overwrite").parquet(f"{self.path}/commits/{batch}")
        return True

    def compact(self, path: str) -> "Ledger":
        """A ledger at another place with one batch that holds the present state."""
        new = Ledger(self.spark, path)
        state = self.documents().withColumns({"op": F.lit("insert"), "seq": F.lit(0)})
        new.commit("compacted", state)
        return new


def count_tokens(docs: DataFrame, texts: list[str], vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """The rows of docs with the number of tokens of each named text column as ``<name>_tokens``.

    Counts are without end id; null texts have 0. The text columns themselves are left out, and a column that has
    the name of a count gives way to it."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in texts and c not in {f"{t}_tokens" for t in texts}]
    schema = docs.select(*kept).schema
    for t in texts:
        schema = schema.add(f"{t}_tokens", "long")
    ordered = docs.select(*kept, *texts)

    def run(batches):
        for batch in batches:
            for part, n in _counted(batch, texts, vocabulary):
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *n], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _counted(batch, texts, vocabulary):
    encoder = bpe.Encoder.of(bpe.vocabulary(vocabulary))
    for part in bpe.tb.slices(batch, texts[0]):
        counts = []
        for t in texts:
            _, places = encoder.encode(part.column(part.schema.get_field_index(t)))
            counts.append(pa.array(places[1:] - places[:-1], pa.int64()))
        yield part, counts
