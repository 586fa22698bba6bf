"""Research-paper records derived from the supplied order tables, one paper per order.

Every order, line item and document takes part. The switches on the order key only empty or spoil
single fields, so that each cleaning rule has rows to act on; no order is left out.
``parts`` names what a query needs, because Catalyst cannot remove an unused left join itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions.dates import version_time
from papyra.schema import FORMATS, METADATA, RECORD, VERSIONS

AS_OF = "2024-01-31"
RUN_TS = "2024-01-31 00:00:00"
ALL_PARTS = ("text", "place", "items", "people")
VERSION_TIME_PATTERN = "EEE, d MMM yyyy HH:mm:ss 'GMT'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def _by_order(items: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Line items nested in ship order. A record holds its own list, so the list is as long as the
    order, just as it is in a JSON record."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    nested = F.sort_array(F.collect_list(F.struct(*order, *fields)))
    return items.groupBy("l_orderkey").agg(nested.alias(name))


def orders(spark: SparkSession, sf_dir: str, parts=ALL_PARTS) -> DataFrame:
    """Orders with the wanted parts: text of a document, nation, version items, author items."""
    read = lambda name: table(spark, sf_dir, name)
    frame = read("orders").withColumn("id", F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
    if "place" in parts:
        customers = read("customer").join(
            read("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        frame = frame.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    items = read("lineitem")
    if "items" in parts:
        frame = frame.join(
            _by_order(items, [], "items"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
        ).drop("l_orderkey")
    if "people" in parts:
        named = items.join(read("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
            read("part"), F.col("l_partkey") == F.col("p_partkey")
        )
        frame = frame.join(
            _by_order(named, ["s_name", "p_brand"], "people"),
            F.col("o_orderkey") == F.col("l_orderkey"), "left",
        ).drop("l_orderkey")
    if "text" in parts:
        documents = read("documents")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # the how-manieth paper of its document: texts are blanked by it, so that every document
        # is whole in most of its papers
        held = documents.count()
        # the text makes narrow rows wide: it comes last, so that no later join shuffles it, and
        # the rows are spread before it comes. They stay spread by the merge: a broadcast of the
        # narrow rows would leave all work on papers to the few tasks that scan the documents
        frame = frame.withColumns({
            "doc_id": F.col("o_orderkey") % held, "repeat": F.floor(F.col("o_orderkey") / held),
        }).repartition(tasks, "doc_id").join(
            documents.select("doc_id", "text", "lang", "source").hint("merge"), "doc_id"
        )
    return frame


def _title() -> Column:
    """First line of the text, then source and language, with white space to be cleaned."""
    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    title = F.concat(first_line, F.lit("\n  "), F.col("source"), F.lit("  "), F.col("lang"))
    return F.when(F.col("repeat") % 50 == 7, F.lit("")).otherwise(title)


def _versions() -> Column:
    def version(item: Column, i: Column) -> Column:
        hours = F.make_interval(hours=item["l_linenumber"])
        created = F.date_format(item["l_shipdate"] + hours, VERSION_TIME_PATTERN)
        spoiled = _every(90) & (i == 0)
        return F.struct(
            F.concat(F.lit("v"), (i + 1).cast("string")).alias("version"),
            F.when(spoiled, F.lit("not a date")).otherwise(created).alias("created"),
        )

    return F.transform("items", version)


def _authors() -> Column:
    pairs = F.transform(
        "people",
        lambda p: F.struct(p["s_name"].alias("last_name"), p["p_brand"].alias("first_name")),
    )
    return F.when(~_every(70), pairs)


def _submitter() -> Column:
    """A name, mostly with its address in brackets; some have none, some a bare one."""
    address = F.concat(
        F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@"), F.lower("n_name"),
        F.lit(".example.edu"),
    )
    return (
        F.when(_every(5), F.col("c_name"))
        .when(F.col("o_orderkey") % 5 == 1, F.concat_ws(" ", "c_name", address))
        .otherwise(F.concat(F.col("c_name"), F.lit(" <"), address, F.lit(">")))
    )


def snapshot(spark: SparkSession, sf_dir: str, parts=ALL_PARTS) -> DataFrame:
    """Typed snapshot records; fields of parts left out are null."""
    available = {
        "title": ("text", _title),
        "abstract": ("text", lambda: F.when(F.col("repeat") % 40 == 3, F.lit("")).otherwise(F.col("text"))),
        "categories": ("place", lambda: F.when(_every(60), F.lit("")).otherwise(F.concat(
            F.lower("c_mktsegment"), F.lit("."), F.substring("o_orderpriority", 1, 1),
            F.lit("  "), F.lower("n_name"),
        ))),
        "submitter": ("place", _submitter),
        "versions": ("items", _versions),
        "authors": ("people", _authors),
    }
    columns = {
        "id": F.col("id"),
        "doi": F.when(
            _every(3), F.concat(F.lit("10.1000/"), F.col("o_orderkey").cast("string"))
        ).otherwise(""),
        "journal_ref": F.when(
            F.col("o_orderstatus") == "F", F.concat(
                F.lit("J. "), F.split_part("o_orderpriority", F.lit("-"), F.lit(2)),
                F.concat_ws(":", (F.col("o_orderkey") % 90 + 1).cast("string"), "o_orderkey"),
                F.date_format("o_orderdate", " (yyyy)"),
            )
        ).otherwise(""),
        # most are ISO days; some are missing, followed by other text, or in the basic form
        "update_date": F.when(_every(80), F.lit(""))
        .when(F.col("o_orderkey") % 80 == 1, F.date_format("o_orderdate", "yyyy-MM-dd 'or so'"))
        .when(F.col("o_orderkey") % 80 == 2, F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "problem": F.lit(None).cast("string"),
    }
    for name, (part, make) in available.items():
        columns[name] = make() if part in parts else F.lit(None).cast(RECORD[name].dataType)
    return orders(spark, sf_dir, parts).select(
        *[columns[c].alias(c) for c in RECORD.fieldNames()],
        "o_orderkey", "o_orderdate", "o_orderpriority",
    )


def _author_lists() -> Column:
    return F.transform(
        "authors", lambda a: F.array(a["last_name"], a["first_name"], F.lit(""))
    )


def _unless_empty(name: str) -> Column:
    return F.when(F.col(name) != "", F.col(name))


def snapshot_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The snapshot as JSON lines; null fields are left out of the object."""
    record = F.struct(
        "id", "title", "abstract", _unless_empty("doi").alias("doi"), "categories",
        F.col("journal_ref").alias("journal-ref"), _author_lists().alias("authors_parsed"),
        "submitter", "versions", "update_date",
    )
    return snapshot(spark, sf_dir).select(F.to_json(record).alias("value"), *keep)


def unreadable(spark: SparkSession, path: str) -> None:
    """A file whose name promises gzip and whose content is none."""
    from papyra.sources import files

    files.write_new(spark, path, "this is no gzip file")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records of both formats, with format and day; delivered on the first of the month.

    Orders of the 31st have no metadata delivery and orders of the 30th no version delivery;
    high-priority orders are delivered again a day later with a new title.
    """
    ordered, day = F.dayofmonth("o_orderdate"), F.to_date(F.trunc("o_orderdate", "month"))

    def delivery(on: Column, name: str, day: Column, again: bool = False) -> Column:
        return F.when(on, F.struct(
            F.lit(name).alias("format"), F.date_format(day, "yyyy-MM-dd").alias("ds"), F.lit(again).alias("again")))

    # a record is made once and gives all of its deliveries
    sent = F.array_compact(F.array(
        delivery(ordered != 31, METADATA, day),
        delivery((ordered != 31) & (F.col("o_orderpriority") == "2-HIGH"), METADATA, F.date_add(day, 1), again=True),
        delivery(ordered != 30, VERSIONS, day)))
    records = snapshot(spark, sf_dir).withColumns({"authors_parsed": _author_lists(), "doi": _unless_empty("doi")})
    each = records.select("*", F.inline(sent))
    only = lambda name, column: F.when(F.col("format") == name, column)
    title = F.when(F.col("again"), F.concat(F.lit("rev "), F.col("title"))).otherwise(F.col("title"))
    return each.select(
        "format", "ds", "id", only(METADATA, title).alias("title"),
        *[only(METADATA, F.col(c)).alias(c) for c in ("categories", "abstract", "update_date")],
        F.col("ds").alias("datestamp"),
        *[only(METADATA, F.col(c)).alias(c) for c in ("doi", "journal_ref", "authors_parsed")],
        *[only(VERSIONS, F.col(c)).alias(c) for c in ("submitter", "versions")],
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as nested harvest responses, to be saved as XML.

    Every author whose first name repeats the one before it comes without forenames.
    """
    d = deliveries(spark, sf_dir)
    parsed = F.col("authors_parsed")
    authors = F.transform(parsed, lambda a, i: F.struct(
        a[0].alias("keyname"),
        F.when((i == 0) | (F.get(parsed, i - 1)[1] != a[1]), a[1]).alias("forenames"),
    ))
    many = lambda name: F.when(
        F.col(name).isNotNull(), F.array(name)
    )
    metadata = F.struct(
        many("id").alias("id"), many("update_date").alias("updated"), many("title").alias("title"),
        many("categories").alias("categories"), many("journal_ref").alias("journal-ref"),
        many("doi").alias("doi"), many("abstract").alias("abstract"),
        F.when(F.size(parsed) > 0, F.struct(authors.alias("author"))).alias("authors"),
    )
    history = F.struct(
        many("id").alias("id"), many("submitter").alias("submitter"),
        F.transform("versions", lambda v: F.struct(
            v["version"].alias("_version"), v["created"].alias("date")
        )).alias("version"),
    )
    header = F.struct(
        F.concat(F.lit("oai:"), F.col("id")).alias("identifier"), "datestamp",
        F.when(F.col("categories") != "", F.split(F.regexp_replace("categories", "\\s+", " "), " "))
        .alias("setSpec"),
    )
    return d.select(
        header.alias("header"),
        F.struct(
            F.when(F.col("format") == METADATA, metadata).alias(METADATA),
            F.when(F.col("format") == VERSIONS, history).alias(VERSIONS),
        ).alias("metadata"),
    )


def delivery_days(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Half-open range that covers every delivery."""
    low, high = table(spark, sf_dir, "orders").agg(
        F.trunc(F.min("o_orderdate"), "month"), F.date_add(F.max("o_orderdate"), 2)
    ).first()
    return low.isoformat(), high.isoformat()


def cut_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot lines that end too early, one for every 30th order."""
    cut = F.concat(F.lit('{"id": "'), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").filter(_every(30)).select(cut.alias("value"))


def nameless_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record without an id per format and delivery day."""
    return broken_lines(spark, sf_dir).withColumn("value", F.lit('{"id": "", "title": "No id"}'))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cut-off line per format and delivery day."""
    days = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("day")).distinct()
    formats = F.explode(F.array(*[F.lit(f) for f in FORMATS])).alias("format")
    return days.select(
        formats, F.date_format("day", "yyyy-MM-dd").alias("ds"), F.lit('{"id": ').alias("value")
    )


def damaged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of harvest records that are none, one for every 30th order: cut off, of a format unknown here, deleted
    (no metadata), without a day, or with one that is no day."""
    key = F.col("o_orderkey").cast("string")
    stamp = F.concat(F.lit("<datestamp>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</datestamp>"))
    kind = F.floor(F.col("o_orderkey") / 30) % 5
    day = F.when(kind == 3, F.lit("")).when(kind == 4, F.lit("<datestamp>soon</datestamp>")).otherwise(stamp)
    head = F.concat(F.lit("<header><identifier>oai:bad-"), key, F.lit("</identifier>"), day, F.lit("</header>"))
    body = (
        F.when(kind == 0, F.concat(F.lit("<metadata><arXiv><id>"), key))
        .when(kind == 1, F.concat(F.lit("<metadata><oai_dc><id>"), key, F.lit("</id></oai_dc></metadata>")))
        .when(kind == 2, F.lit(""))
        .otherwise(F.concat(F.lit("<metadata><arXivRaw><id>"), key, F.lit("</id></arXivRaw></metadata>"))))
    text = F.concat(F.lit("<record>"), head, body, F.lit("</record>"))
    return table(spark, sf_dir, "orders").filter(_every(30)).select(text.alias("value"))


def stored_side(records: DataFrame) -> DataFrame:
    """What the state knew before: all but urgent orders, two versions, one category, old doi."""
    known = records.filter("o_orderpriority <> '1-URGENT' and size(versions) > 0")
    return known.withColumns({
        "versions": F.slice("versions", 1, 2),
        "categories": F.get(F.split("categories", " "), F.lit(0)),
        "doi": F.concat(F.lit("old-"), F.col("o_orderkey").cast("string")),
    })


def update_side(records: DataFrame) -> DataFrame:
    """What arrives now: all but low-priority orders, versions from the second on, the second
    with a time one day later."""
    later = F.col("items_versions")
    newer = records.filter("o_orderpriority <> '5-LOW' and size(versions) > 1")
    return newer.withColumn("items_versions", F.expr("slice(versions, 2, size(versions) - 1)")).withColumn(
        "versions",
        F.transform(later, lambda v, i: F.struct(
            v["version"].alias("version"),
            F.when(i == 0, _a_day_later(v["created"])).otherwise(v["created"]).alias("created"),
        )),
    ).drop("items_versions")


def _a_day_later(created: Column) -> Column:
    return F.date_format(
        version_time(created) + F.expr("interval 1 day"), VERSION_TIME_PATTERN
    )
