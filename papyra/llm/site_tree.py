"""Main text of web pages: a style tree per site, entropy-based importance, removal of branches.

The pages of a host are merged into one tree of elements, named by tag, class, id and role along
their path. An element's presentation is the sequence of its children; its content is the text of
its blocks. With m different pages that hold an element,

* presentation importance: the entropy of its child sequences over the pages, to base m;
* content importance: 1 less the mean, over its texts, of log(pages that hold the text) / log(m): 1 if
  every page has a text of its own, 0 if all share it;
* importance of a branch: the mean over the elements in it (content where there is text, else
  presentation, which weighs 1 - ``DECAY`` as much), each weighted by its pages and by ``DECAY`` per level.

Branches under ``LEAST_IMPORTANCE`` in which no element's own text reaches it are removed from each page. Little can be said from few pages, so
an element's importance on m pages of a host is a mean, weighted m - 1 to ``BACK_OFF``, of what the host says and
of what the other hosts say of the same path: their importances, weighted by m - 1 each, and ``UNKNOWN`` with
``BACK_OFF``. Two pages of a host are enough to remove what both share; single pages rest on other hosts.

Copies of a page (mirrors, print views, session ids) are no template. A page is known by its longest blocks, those
that make up half of its text outside elements with noise names; pages of a host that agree in them are one page,
which each element enters as it stands in one of the copies.

The tree holds all elements, and names only weigh on an element's importance: ``NOISE_WEIGHT`` in elements whose
tag, role, class or id names a menu, advert, notice, form and so on (``NOISE_*``), ``OUTSIDE_WEIGHT`` outside the article
or main element of a page, both multiplied. A class or id is such a name if all its words are noise words or say
only where or how (``PLACE_WORDS``): "site-footer" and "ad-box" are, "no-sidebar", "legal-news" and "side-by-side" are not.
A name says nothing about an element that holds a landmark, an h1 or more than half of the page's text: it is a
wrapper. Articles that hold less text than what stands outside of them under no noise name are teasers: then no
place is outside. What nothing is known of has importance
``UNKNOWN``, which a noise name alone brings under the least and a place outside a landmark does not. A noise name and
a place outside the landmark together do so for any importance, as adverts have texts of their own on every page
and no statistic tells them from a story; either alone leaves important text.
Headings and paragraphs that stand right in an article are kept, as the same article may be published many times.

An element weighs on the branches up to ``REACH`` levels above it; farther up its weight is under a thousandth and
counts as none. Parsing takes time and memory in proportion to the page, however deep or unclosed its elements are.

Blocks are the text between block-level tags: character references decoded, white space turned into
one space, trimmed, joined in page order by an empty line. Broken mark-up never fails: what does not
close ends with its parent, scripts and comments that do not end reach to the end of the page. Null
html is empty; a page without main text has an empty text. A null url, or one without a host, counts
as host ''. Rows that repeat count as one page in the statistics and give a row each. An empty table
gives no rows. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm import textbytes as tb
from papyra.llm.ship import ship
from papyra.session import scratch

LEAST_IMPORTANCE = 0.3
UNKNOWN = 0.55
BACK_OFF = 1.0
NOISE_WEIGHT, OUTSIDE_WEIGHT = 45, 60  # hundredths, so that their sums are exact
DECAY = 0.9
REACH = 64

RAW = "script|style|noscript|template|textarea|iframe|title|svg|math|object|audio|video|canvas"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul li dd dt".split()
)
CLOSES_SELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
SCOPES = set("ul ol dl table div article section main body nav aside footer header select".split())
NOISE_TAGS = set("head nav footer aside form button select input dialog menu".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NOISE_WORDS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside widget widgets footer masthead "
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup "
    "comment comments disqus discussion reply replies respond share sharing social related recommended "
    "login search toolbar pagination pager copyright legal disclaimer header topbar skip".split()
)
PLACE_WORDS = set(
    "site page main top bottom left right inner outer wrapper wrap container box block area bar list item items section "
    "panel primary secondary global mobile desktop fixed sticky row col column link links button buttons icon icons "
    "group holder slot unit zone module form user users reader readers posts articles policy media google thread "
    "image text inline small large first last".split()
)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LANDMARKS = {"article", "main"}
FLOW = set("h1 h2 h3 h4 h5 h6 p blockquote pre figure figcaption".split())


class _Element:
    __slots__ = ("tag", "key", "path", "parent", "noise", "main", "flow", "inline", "holds", "chars", "weight", "children",
                 "block", "gone")

    def __init__(self, tag, key, path, parent, noise, main, flow, inline=False):
        self.tag, self.key, self.path, self.parent = tag, key, path, parent
        self.noise, self.main, self.flow, self.inline = noise, main, flow, inline
        self.holds, self.chars, self.weight = False, 0, 100
        self.children = []
        self.block, self.gone = parent.block if inline else self, False


def _noise_name(words: list[str]) -> bool:
    words = [w.lower() for w in words if len(w) > 1]
    return any(w in NOISE_WORDS for w in words) and all(w in NOISE_WORDS or w in PLACE_WORDS for w in words)


def _name(tag: str, attributes: str, inside_main: bool) -> tuple[str, bool, bool]:
    """Name within the path, whether it is known noise, whether it is a landmark."""
    noise = tag in NOISE_TAGS or tag == "header" and not inside_main
    if not attributes or attributes.isspace():
        return tag, noise, tag in LANDMARKS
    names, landmark = [], tag in LANDMARKS
    for m in ATTRIBUTE.finditer(attributes):
        which, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if which == "hidden" or which == "aria-hidden" and value.lower() == "true":
            noise = True
        elif which == "role":
            noise = noise or value.lower() in NOISE_ROLES
            landmark = landmark or value.lower() == "main"
            names.append("@" + value.lower())
        elif which in ("class", "id"):
            words = NAME_WORDS.findall(value)
            if tag not in ("html", "body") and not landmark:
                noise = noise or any(_noise_name(NAME_WORDS.findall(name)) for name in value.split())
            names.append(("." if which == "class" else "#") + "-".join(words).lower())
    return tag + "".join(sorted(names)), noise, landmark


def parse(page: str):
    """Blocks (element, text, line, gap) in page order, and all elements with their weights.

    An element within a line that has a noise name is one of the tree, so it divides the line into blocks with one
    line number; gap tells whether white space stands before the block."""
    root = _Element("", 0, (), None, False, False, False)
    stack, elements, blocks, text = [root], [root], [], []
    line, gap = 0, False
    open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of each tag
    scopes = [0]

    def push(e):
        open_at.setdefault(e.tag, []).append(len(stack))
        if e.tag in SCOPES:
            scopes.append(len(stack))
        stack.append(e)

    def last_open(tags):
        """Place of the last open element of these tags within the scope, or 0."""
        i = max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)
        return i if i > scopes[-1] else 0

    def end_block(within_line=False):
        nonlocal line, gap
        if text:
            raw = entities.unescape("".join(text))
            if joined := " ".join(raw.split()):
                owner = stack[-1].block
                blocks.append((owner, joined, line, gap or raw[0].isspace()))
                gap = raw[-1].isspace()
                owner.chars += len(joined)
            else:
                gap = gap or bool(raw)
            text.clear()
        if not within_line:
            line, gap = line + 1, False

    def pop_to(i):
        closed = [e for e in stack[i:] if not e.inline]
        if closed:
            end_block(all(e.tag in INLINE for e in closed))
        while len(stack) > i:
            tag = stack.pop().tag
            open_at[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag = tag.lower()
        if m[2] or m[5]:
            if open_at.get(tag):
                pop_to(open_at[tag][-1])
            continue
        top = stack[-1]
        if tag in INLINE and tag not in VOID and not (m[4] or m[7] or "").strip():
            push(_Element(tag, top.key, top.path, top, False, top.main, top.flow, True))
            continue
        if tag in CLOSES_P and (i := last_open(("p",))):
            pop_to(i)
        if tag in CLOSES_SELF:
            while i := last_open(CLOSES_SELF[tag]):
                pop_to(i)
                if tag != "tr":
                    break
        if tag in VOID:
            if tag not in INLINE:
                end_block()
            else:
                text.append(" ")
            continue
        top = stack[-1]
        name, noise, landmark = _name(tag, m[4] or m[7] or "", top.main)
        if noise or tag not in INLINE:
            end_block(tag in INLINE)
        if tag in INLINE and not noise:
            push(_Element(tag, top.key, top.path, top, False, top.main, top.flow, True))
            continue
        key = xxhash.xxh64_intdigest(f"{top.key}/{name}") - (1 << 63)
        parent = top.block
        child = _Element(tag, key, (*top.path[1 - REACH :], key), parent, noise, top.main or landmark,
                         top.main and tag in FLOW and (top.flow or top.tag in LANDMARKS) or landmark)
        if landmark or tag == "h1":
            (child if landmark else parent).holds = True
        parent.children.append(name)
        push(child)
        elements.append(child)
    if at < len(page):
        text.append(page[at:])
    end_block()
    inside = {id(e): e.chars for e in elements if e.chars}
    for e in reversed(elements[1:]):  # parents come before what is in them
        e.parent.chars += e.chars
        e.parent.holds = e.parent.holds or e.holds
    within = outside = 0
    for e in elements:
        if e is not root:
            e.noise = e.parent.noise or e.noise and not e.holds and 2 * e.chars <= root.chars
        e.flow = e.flow and not e.noise
        if not e.noise:
            within += inside.get(id(e), 0) if e.main else 0
            outside += 0 if e.main else inside.get(id(e), 0)
    landmarks = within > 0 and within >= outside
    for e in elements[1:]:
        e.weight = (NOISE_WEIGHT if e.noise else 100) * (OUTSIDE_WEIGHT if landmarks and not e.main else 100) // 100
    return blocks, elements


def main_text(page: str, removed: set[int]) -> str:
    """Text of the blocks that stay; ``removed`` has the keys of unimportant branches."""
    out, last, index = [], None, None
    blocks, elements = parse(page)
    if removed:
        for e in elements[1:]:
            e.gone = e.parent.gone or e.key in removed
    for i, (e, text, line, gap) in enumerate(blocks):
        if e.gone and not e.flow:
            continue
        if out:
            out.append("\n\n" if line != last else " " if gap or index != i - 1 else "")
        out.append(text)
        last, index = line, i
    return "".join(out)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def page_identity(page: str, blocks) -> int:
    """Hash of the longest blocks that make up half of the text outside noise names; of the page if there are none."""
    texts = sorted({text for e, text, *_ in blocks if not e.noise}, key=lambda t: (-len(t), t))
    held, half = 0, sum(map(len, texts)) / 2
    for n, text in enumerate(texts, 1):
        held += len(text)
        if held >= half:
            return _hash("\n".join(texts[:n]))
    return _hash(page)


FEATURES = "host string, page long, copy long, key long, path array<long>, weight long, style long, texts array<long>"


def _features(batches):
    for batch in batches:
        for part in tb.slices(batch, "html"):
            out = {x.split()[0]: [] for x in FEATURES.split(", ")}
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                blocks, elements = parse(page)
                merged: dict[int, list] = {}
                for e in elements[1:]:
                    own = merged.setdefault(e.key, [e.path, 0, [], []])
                    runs = [c for c, before in zip(e.children, [None, *e.children]) if c != before]
                    own[1] = max(own[1], e.weight)
                    own[2].append(",".join(runs))
                for e, text, *_ in blocks:
                    if e.key in merged:
                        merged[e.key][3].append(_hash(text))
                identity, whole = page_identity(page, blocks), _hash(page)
                for key, (path, weight, styles, texts) in merged.items():
                    row = host, identity, whole, key, path, weight, _hash("|".join(dict.fromkeys(styles))), sorted(set(texts))
                    for name, value in zip(out, row):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                names=list(out))


def branch_importance(pages: DataFrame) -> DataFrame:
    """host, key, pages, importance of every branch, and the best of its texts, from (host, html)."""
    ship(pages.sparkSession)
    seen = pages.select("host", "html").mapInArrow(_features, FEATURES)
    # an element counts once per different page, as it stands in one of the page's copies
    once = seen.groupBy("host", "key", "page").agg(
        F.min(F.struct("copy", "weight", "style", "texts", "path")).alias("e"))
    spread = once.select(
        "host", "key", "e.path", "e.weight",
        F.explode(F.concat(
            F.array(F.struct(F.lit(0).alias("kind"), F.col("e.style").alias("value"))),
            F.transform("e.texts", lambda t: F.struct(F.lit(1).alias("kind"), t.alias("value"))))).alias("f"),
    ).select("host", "key", "path", "weight", F.col("f.kind").alias("kind"), F.col("f.value").alias("value"))
    counts = spread.groupBy("host", "key", "kind", "value").agg(
        F.count("*").cast("double").alias("n"), F.sum("weight").alias("weight"), F.any_value("path").alias("path"))
    per_key = counts.groupBy("host", "key").agg(
        F.any_value("path").alias("path"),
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("weight"))).alias("weight"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("style"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("content"))
    log_m = F.log("m")
    importance = F.when(F.col("m") < 2, 0.0).when(
        F.col("texts").isNotNull(), 1 - F.col("content") / (F.col("texts") * log_m)
    ).otherwise((log_m - F.col("style") / F.col("m")) / log_m)
    here = per_key.select(
        "host", "key", "m", "path", "weight", F.col("texts").isNotNull().alias("has_text"), (F.col("m") - 1).alias("seen"),
        (importance * (F.col("m") - 1)).alias("sum"))
    # written once, as it is read for the sums over hosts and again to be joined with them
    path = scratch(pages.sparkSession, "site-paths")
    here.write.parquet(path)
    here = pages.sparkSession.read.schema(here.schema).parquet(path)
    # an element on one page of its host adds nothing to the sums, and text and structure are kept apart
    over_hosts = here.where("seen > 0").groupBy("key", "has_text").agg(
        F.sum("seen").alias("all_seen"), F.sum("sum").alias("all_sum"))
    others = F.coalesce(F.col("all_seen"), F.lit(0.0)) - F.col("seen")
    pooled = (F.when(others > 0, F.col("all_sum") - F.col("sum")).otherwise(0.0) + BACK_OFF * UNKNOWN) / (others + BACK_OFF)
    own = (F.col("sum") + BACK_OFF * pooled) / (F.col("seen") + BACK_OFF)
    leaf = here.join(over_hosts, ["key", "has_text"], "left").select(
        "host", "m", "path", (own * F.col("weight") / (100 * F.col("m"))).alias("own"), "has_text")
    above = leaf.select(
        "host", "m", "own", "has_text", F.size("path").alias("depth"), F.posexplode("path").alias("at", "above"))
    weight = F.col("m") * F.pow(F.lit(DECAY), F.col("depth") - 1 - F.col("at")) * F.when(
        F.col("has_text"), 1.0).otherwise(1 - DECAY)
    return above.groupBy("host", F.col("above").alias("key")).agg(
        F.max(F.when(F.col("at") == F.col("depth") - 1, F.col("m"))).alias("pages"),
        (F.sum(weight * F.col("own")) / F.sum(weight)).alias("importance"),
        F.coalesce(F.max(F.when(F.col("has_text"), F.col("own"))), F.lit(0.0)).alias("best"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text and n_chars of every page."""
    spark = ship(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    # written, so that Spark knows the size: a small table goes to all tasks, a large one is joined
    # by host, where adaptive execution splits the pages of a large host
    path = scratch(spark, "site-tree")
    branch_importance(rows).where(
        (F.col("importance") < LEAST_IMPORTANCE) & (F.col("best") < LEAST_IMPORTANCE)
    ).groupBy("host").agg(F.collect_list("key").alias("removed")).write.parquet(path)
    removed = spark.read.schema("host string, removed array<long>").parquet(path)

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "html"):
                texts = [
                    main_text(page, set(keys or ()))
                    for page, keys in zip(part.column(3).to_pylist(), part.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                    names=["page_id", "url", "host", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.join(removed, "host", "left").select("page_id", "url", "host", "html", "removed").mapInArrow(
        run, f"page_id {kind}, url string, host string, text string, n_chars long")
