"""Near-duplicate groups: fast similarity sketches, banding, exact verification of links.

Sketch: coordinate b of ``COORDINATES`` holds the least (round, hash) of the elements that some round
placed into bin b. Rounds 1 to t place each element by a hash of the round; rounds t+1 to 2t put
all elements into one bin each, so every coordinate is filled. Two sets agree in a coordinate with
a chance of their similarity, and, as one element seldom fills two coordinates, the share of agreeing
coordinates is more concentrated than that of independent minima.

Documents with equal shingle sets are one class; links are searched between classes, and copies are
never expanded into pairs. ``BANDS`` bands of ``ROWS`` coordinates give the buckets: a pair of similarity
0.8 shares none with a chance of (1 - 0.8**4)**24 = 3e-6. Within a bucket, links are found in rounds:

1. every class is compared with the least class that it meets in any of its buckets;
2. in each bucket that holds more than one component, with the least and then with the greatest
   class of the bucket;
3. what still meets in buckets without being in one component is grouped anew by rare shingles. Of a set of n
   shingles at least need = ceil(0.8 n) are in any set that is similar enough, so two such sets share one of the
   n - need + 1 shingles that come first in the order of how many of these classes hold them (exact prefix
   filtering). A shingle of one class leads nowhere: texts of one template, half alike, have none in common there
   and need no comparison;
4. classes that meet in such a shingle without being in one component are a family; its classes are dealt in
   blocks of about ``BLOCK``, and each pair of blocks is compared by an inverted index of one of them.

A comparison reads both whole shingle sets. Pairs that are in one component already need no
comparison: they cannot change the result. No pair is written unless it is a link that joins two
components. Components are the least class reachable: every class points to its least neighbour, the
pointers are followed, and the links are drawn again between what they lead to, until none is left.

Large groups are dealt by (centre, salt), the centre's text once per ``MEMBERS_PER_TASK_GROUP`` members,
and compared as a stream that holds one centre's set at a time. Texts are shuffled once, and only
those that share a bucket go on; links and labels are rows of two or three numbers.

Null and empty texts, and those without words, have an empty set, are linked with nothing and are
kept. Rows of equal doc_id are one document: each gets a row, all get one component, and if their
texts differ links are confirmed on the least one. Rows without doc_id have a null component and are
kept. An empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship
from papyra.session import scratch

COORDINATES = 96
BANDS, ROWS = 24, 4
MEMBERS_PER_TASK_GROUP = 256
BLOCK = 512
HOT_SHARE = 1000  # shingles with a thousandth of all rows: at most so many, sent to all tasks
U64 = np.uint64


def sketch(values: np.ndarray, places: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """One row of t coordinates per non-empty set, given all sets as hashes with n + 1 places."""
    n = len(places) - 1
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * t, empty, np.uint64)
    row = np.repeat(np.arange(n), np.diff(places))
    live = values
    for r in range(2 * t):
        if not len(live):
            break
        h = tb.mix(live ^ tb.mix(np.array([r + 1], np.uint64))[0])
        if r < t:
            bin_ = ((h >> U64(40)) * U64(t)) >> U64(24)
        else:
            bin_ = np.full(len(h), r - t, np.uint64)
        value = (U64(r) << U64(56)) | (h & U64((1 << 40) - 1))
        at = row * t + bin_.astype(np.int64)
        np.minimum.at(out, at, value)
        missing = (out.reshape(n, t) == empty).any(axis=1)
        go_on = missing[row]
        live, row = live[go_on], row[go_on]
    return out.reshape(n, t)


SKETCHED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sketches(k: int):
    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                values, places = tb.shingle_sets(part.column(1), k)
                sizes = np.diff(places)
                full = sizes > 0
                coordinates = sketch(values, np.append(places[:-1][full], places[-1]))
                hashes = np.zeros((int(full.sum()), BANDS), np.uint64)
                for b in range(BANDS):
                    h = np.full(len(hashes), b + 1, np.uint64)
                    for j in range(ROWS):
                        h = tb.mix(h + coordinates[:, b * ROWS + j])
                    hashes[:, b] = h
                # two sums over the set stand for the set itself: 128 bits
                total = np.zeros((2, len(values) + 1), np.uint64)
                np.cumsum(tb.mix(values ^ U64(0xA5A5A5A5A5A5A5A5)), out=total[0, 1:])
                np.cumsum(tb.mix(values + U64(0x1234567812345678)), out=total[1, 1:])
                a, b_ = (total[:, places[1:]] - total[:, places[:-1]]).view(np.int64)
                offsets = np.zeros(len(sizes) + 1, np.int32)
                np.cumsum(full * BANDS, out=offsets[1:])
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(a), pa.array(b_), bands],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return run


def _sets(k: int):
    """The set of each text: id, label, n, shingles."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                values, places = tb.shingle_sets(part.column(2), k)
                sets = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(places)), sets], names=["id", "label", "n", "shingles"])
    return run


def _compare(k: int, percent: int):
    """Rows (centre, salt, kind, id, text) sorted so: a centre's row (kind 0), then its members."""

    def run(batches):
        centre, values = None, None
        for batch in batches:
            for part in tb.slices(batch, "text"):
                sets, places = tb.shingle_sets(part.column(4), k)
                centres, kinds, ids = (part.column(i).to_pylist() for i in (0, 2, 3))
                at = places.tolist()
                links = []
                for i, kind in enumerate(kinds):
                    own = sets[at[i] : at[i + 1]]
                    if kind == 0:
                        centre, values = centres[i], own
                        continue
                    if centre != centres[i]:
                        raise ValueError(f"no text for {centres[i]}")
                    place = np.searchsorted(values, own)
                    place[place == len(values)] = 0
                    shared = int((values[place] == own).sum()) if len(values) else 0
                    if shared and 100 * shared >= percent * (len(values) + len(own) - shared):
                        links.append((centre, ids[i]))
                a, b = zip(*links) if links else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


class _Block:
    """Sets of one block and their inverted index."""

    def __init__(self):
        self.ids, self.components, self.sets, self.index = [], [], [], None

    def add(self, id_, component, values):
        self.ids.append(id_)
        self.components.append(component)
        self.sets.append(values)

    def similar(self, values: np.ndarray, percent: int) -> list[int]:
        """Places of the members whose sets are similar enough to this one."""
        if self.index is None:
            sizes = np.array([len(v) for v in self.sets])
            held = np.concatenate(self.sets)
            order = np.argsort(held, kind="stable")
            self.index = held[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes
        held, owner, sizes = self.index
        low, high = np.searchsorted(held, values, "left"), np.searchsorted(held, values, "right")
        shared = np.bincount(owner[tb.gather_ranges(low, high - low)], minlength=len(sizes))
        return np.flatnonzero((shared > 0) & (100 * shared >= percent * (sizes + len(values) - shared))).tolist()


def _compare_blocks(k: int, percent: int):
    """Rows (family, i, j, side, id, component, text) sorted so: side 0 is held, side 1 goes by it; where i
    is j, side 0 is compared with itself."""

    def run(batches):
        key, block, links, joined = None, None, [], {}

        def find(x):
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        def compare(id_, component, values):
            for place in block.similar(values, percent):
                a, b = find(component), find(block.components[place])
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    links.append((block.ids[place], id_))

        def finish():
            if key is not None and key[1] == key[2]:
                for member in zip(block.ids, block.components, block.sets):
                    compare(*member)

        for batch in batches:
            for part in tb.slices(batch, "text"):
                sets, places = tb.shingle_sets(part.column(6), k)
                at = places.tolist()
                for r, (family, i, j, side, id_, component) in enumerate(zip(*(part.column(c).to_pylist() for c in range(6)))):
                    if key != (family, i, j):
                        finish()
                        key, block, joined = (family, i, j), _Block(), {}
                    own = sets[at[r] : at[r + 1]]
                    if side == 0:
                        block.add(id_, component, own.copy())
                    elif block.ids:
                        compare(id_, component, own)
        finish()
        a, b = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


class _Job:
    """Working tables of one run, below one folder."""

    def __init__(self, spark, k: int, percent: int):
        self.spark, self.k, self.percent = spark, k, percent
        self.root, self.made = scratch(spark, "near-dedup"), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:03d}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """Those pairs (a, b) whose whole sets are similar enough; texts has id and text."""
        per_a = pairs.groupBy("a").agg(F.count("*").alias("members"))
        salts = F.ceil(F.col("members") / MEMBERS_PER_TASK_GROUP).cast("int")
        salted = pairs.join(per_a.withColumn("salts", salts), "a").select(
            "a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
        centres = per_a.select("a", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
        rows = (
            centres.join(texts, centres.a == texts.id)
            .select("a", "salt", F.lit(0).alias("kind"), "id", "text")
            .unionAll(
                salted.join(texts, salted.b == texts.id)
                .select("a", "salt", F.lit(1).alias("kind"), "id", "text"))
        )
        dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind", "id")
        return self.keep(dealt.mapInArrow(_compare(self.k, self.percent), "a long, b long"))

    def rare_groups(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Classes (id, label, least) by the rare shingles that they share with a class of another component."""
        classes = members.select("id", "label").distinct().join(texts, "id").select("id", "label", "text")
        sets = self.keep(classes.mapInArrow(_sets(self.k), "id long, label long, n long, shingles array<long>"))
        held = sets.select("id", "n", F.explode("shingles").alias("shingle"))
        shared = self.keep(held.groupBy("shingle").agg(F.count("*").alias("classes")).where("classes > 1"))
        total = shared.agg(F.coalesce(F.sum("classes"), F.lit(0)).alias("t")).first()["t"]
        hot = F.broadcast(shared.where(F.col("classes") * HOT_SHARE >= total))
        counted = held.join(hot, "shingle").unionAll(
            held.join(hot.select("shingle"), "shingle", "left_anti")
            .join(shared.where(F.col("classes") * HOT_SHARE < total), "shingle").select("shingle", "id", "n", "classes"))
        # shingles of one class come first in the order and take places of the prefix
        length = F.col("n") - F.expr(f"({self.percent} * n + 99) div 100") + 1
        first = length - (F.col("n") - F.size("common"))
        prefix = counted.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("classes", "shingle"))).alias("common"))
        rare = self.keep(prefix.where(first > 0).select(
            "id", F.explode(F.slice("common", F.lit(1), first.cast("int"))).alias("s")
        ).select("id", "s.shingle").join(sets.select("id", "label"), "id"))
        groups = rare.groupBy("shingle").agg(
            F.min("id").alias("least"), F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1")
        return self.keep(rare.join(groups, "shingle").select("id", "label", "least"))

    def links_in_families(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Links between components among classes that meet in groups: (id, label, least)."""
        alone = members.select("id").distinct().withColumn("label", F.col("id"))
        meets = members.select(F.col("least").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()
        families = self.components(self.keep(alone), meets).withColumnRenamed("label", "family")
        blocks = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        labels = members.groupBy("id").agg(F.min("label").alias("component"))
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        dealt = (
            families.join(labels, "id").join(blocks, "family").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(texts, "id")
            .select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "component", "text")
            .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "side", "id"))
        return self.keep(dealt.mapInArrow(_compare_blocks(self.k, self.percent), "a long, b long"))

    def components(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """Labels (id, label) after joining what the links join; links may repeat."""
        ends = links.join(labels.select(F.col("id").alias("a"), F.col("label").alias("x")), "a").join(
            labels.select(F.col("id").alias("b"), F.col("label").alias("y")), "b").select("x", "y")
        ends = ends.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        edges, moved = self.keep(ends), None
        while not edges.isEmpty():
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = self.keep(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")))
            # follow the pointer of the pointer, then draw the links between what is left
            up = least.select(F.col("u").alias("p"), F.col("p").alias("root"))
            step = self.keep(least.join(up, "p").select(F.col("u"), "root"))
            other = step.select(F.col("u").alias("v"), F.col("root").alias("other"))
            if moved is None:
                moved = step.select(F.col("u").alias("label"), "root")
            else:
                onward = step.select(F.col("u").alias("root"), F.col("root").alias("next"))
                moved = self.keep(moved.join(onward, "root", "left").select(
                    "label", F.coalesce("next", "root").alias("root")))
            edges = self.keep(
                edges.join(step, "u").join(other, "v").where("root <> other")
                .select(F.greatest("root", "other").alias("u"), F.least("root", "other").alias("v")).distinct())
        if moved is None:
            return labels
        return self.keep(labels.join(moved, "label", "left").select(
            "id", F.coalesce("root", "label").alias("label")))


def near_duplicate_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text)."""
    spark = ship(docs.sparkSession)
    job = _Job(spark, k, percent)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = job.keep(rows.mapInArrow(_sketches(k), SKETCHED))
    key = ["set_a", "set_b", "n_shingles"]

    classes = job.keep(
        sketched.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key)
        .agg(F.min(F.struct("doc_id", "bands")).alias("m"))
        .select(*key, F.col("m.doc_id").alias("id"), F.col("m.bands").alias("bands")))
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(
        F.min("id").alias("least"), F.max("id").alias("greatest")).where("least < greatest")
    buckets = job.keep(banded.join(shared, "bucket"))
    labels = job.keep(buckets.select("id").distinct().withColumn("label", F.col("id")))
    if not labels.isEmpty():
        wanted = labels.select("id")
        texts = job.keep(
            rows.join(wanted, rows.doc_id == wanted.id).groupBy("id").agg(F.min("text").alias("text")))
        least = buckets.groupBy("id").agg(F.min("least").alias("a")).where("a < id")
        tried = job.keep(least.select("a", F.col("id").alias("b")))
        labels = job.components(labels, job.verified(tried, texts))
        for step in ("least", "greatest", "all"):
            named = buckets.join(labels, "id")
            split = named.groupBy("bucket").agg(
                F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1").select("bucket")
            members = job.keep(named.join(split, "bucket"))
            if members.isEmpty():
                break
            if step == "all":
                members = job.rare_groups(members, texts)
                if not members.isEmpty():
                    labels = job.components(labels, job.links_in_families(members, texts))
                break
            other = labels.select(F.col("id").alias(step), F.col("label").alias("x"))
            pairs = members.join(other, step).where("x <> label").select(
                F.least("id", step).alias("a"), F.greatest("id", step).alias("b"))
            fresh = job.keep(pairs.distinct().join(tried, ["a", "b"], "left_anti"))
            labels = job.components(labels, job.verified(fresh, texts))
            tried = tried.unionAll(fresh)

    of_set = classes.select(*key, "id").join(labels, "id", "left").select(
        *key, F.coalesce("label", "id").alias("component"))
    return sketched.join(of_set, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of the documents that stay, one of each group."""
    gone = near_duplicate_groups(docs, k, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
