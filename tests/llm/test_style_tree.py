"""Style tree: importance against brute force, copies of pages, names, deep and unclosed mark-up."""

import collections
import math
import time
import tracemalloc

import pytest

from papyra.llm import site_tree

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows):
    return {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_copies_of_a_page_are_no_template(spark):
    story = "<div class='story'><p>One story that two addresses of a host show in the same words</p></div>"
    rows = [(i, f"http://mirror.com/?s={i}", f"<body>{story}<div>u{i}</div></body>") for i in range(2)]
    rows += [(10 + i, "http://many.com/", f"<body>{story}<div>{i}</div></body>") for i in range(30)]
    out = texts(spark, rows)
    assert all(text.startswith("One story that two addresses") for text in out.values()) and len(out) == 32


def test_names_that_only_resemble_noise(spark):
    body = "<p>The body of the page stands here, as long as bodies are.</p>"
    rows = [
        (0, "http://a.com/", f"<article class='teaser'><p>Teaser</p></article><div class='legal-news'>{body}</div>"
                             f"<div class='comments-free'>{body}</div>"),
        (1, "http://b.com/", f"<div class='content'><p>First of all a long word about it</p><div class='side-by-side'>{body}</div></div>"),
        (2, "http://c.com/", f"<div id='search-results-guide'>{body}</div><div><p>And more of a longer text besides, up to the half.</p></div>"),
        (3, "http://d.com/", f"<article>{body}</article><div class='site-footer'>f</div><div class='ad-box'>Buy</div>"
                             "<div id='cookie-consent-banner'>ok</div><ul class='nav-links'><li>n</ul>"),
    ]
    out = texts(spark, rows)
    plain = body[3:-4]
    assert out[0].count(plain) == 2 and plain in out[1] and plain in out[2] and out[3] == plain


@pytest.mark.parametrize("html", ["<b><p>x" * 14000, "<div>" * 20000 + "x", "<div>x" * 17000, "<p><select>" + "<b><p>x</p>" * 9000,
                                  "<ul><li><ul>" + "<b><li>x</li>" * 8000, "</i>" * 25000 + "x"])
def test_deep_and_unclosed_pages_take_linear_time(html):
    began = time.process_time()
    site_tree.main_text(html, {1})
    assert time.process_time() - began < 3  # about half a second; quadratic work took minutes
    tracemalloc.start()
    site_tree.parse(html)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def made_pages():
    pages = []
    for i in range(50):
        host = f"h{i % 4 if i < 44 else i}"
        shared = f"<div class='slogan'><p>Slogan of {i % 2}</p><div>{'x' * (i % 3)}</div></div>"
        own = f"<div class='story'><p>Story number {i // 2} told at some length</p>{'<p>More of it</p>' * (i % 4)}</div>"
        pages.append((host, f"<body>{shared}<ul>{'<li>Entry</li>' * (i % 5 + 1)}</ul>{own}<div>{'<div>' * (70 if i % 9 == 0 else 2)}deep {i % 7}"))
    return pages + pages[:5]


def brute_force(pages):
    """The definition in the module's words, page by page and element by element."""
    seen = collections.defaultdict(dict)  # (host, key) -> page -> (copy, weight, style, texts, path)
    for host, html in pages:
        blocks, elements = site_tree.parse(html)
        page, copy = site_tree.page_identity(html, blocks), site_tree._hash(html)
        for key in {e.key for e in elements[1:]}:
            own = [e for e in elements[1:] if e.key == key]
            runs = ["|".join(dict.fromkeys(",".join(c for c, b in zip(e.children, [None, *e.children]) if c != b) for e in own))]
            said = frozenset(text for e, text, *_ in blocks if e.key == key)
            entry = copy, max(e.weight for e in own), runs[0], said, own[0].path
            if page not in seen[host, key] or copy < seen[host, key][page][0]:
                seen[host, key][page] = entry
    raw = {}
    for (host, key), held in seen.items():
        m = len(held)
        said = collections.Counter(t for e in held.values() for t in e[3])
        styles = collections.Counter(e[2] for e in held.values())
        if m < 2:
            value = 0.0
        elif said:
            value = 1 - sum(n * math.log(n) for n in said.values()) / (sum(said.values()) * math.log(m))
        else:
            value = -sum(n / m * math.log(n / m) for n in styles.values()) / math.log(m)
        raw[host, key] = m, value, bool(said), sum(e[1] for e in held.values()) / (100 * m), next(iter(held.values()))[4]
    own = {}
    for (host, key), (m, value, has_text, weight, _) in raw.items():
        others = [(m2 - 1, v2) for (h2, k2), (m2, v2, t2, *_) in raw.items() if k2 == key and h2 != host and t2 == has_text]
        pooled = (sum(a * v for a, v in others) + site_tree.BACK_OFF * site_tree.UNKNOWN) / (sum(a for a, _ in others) + site_tree.BACK_OFF)
        own[host, key] = weight * ((m - 1) * value + site_tree.BACK_OFF * pooled) / (m - 1 + site_tree.BACK_OFF)
    up = collections.defaultdict(list)
    for (host, key), (m, _, has_text, _, path) in raw.items():
        for level, above in enumerate(reversed(path)):
            w = m * site_tree.DECAY**level * (1 if has_text else 1 - site_tree.DECAY)
            up[host, above].append((w, own[host, key], has_text))
    return {at: (raw[at][0], sum(w * v for w, v, _ in xs) / sum(w for w, *_ in xs), max((v for _, v, t in xs if t), default=0.0))
            for at, xs in up.items()}


def test_importance_equals_brute_force(spark):
    pages = made_pages()
    want = brute_force(pages)
    got = {(r.host, r.key): (r.pages, r.importance, r.best)
           for r in site_tree.branch_importance(spark.createDataFrame(pages, "host string, html string")).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    for at, values in want.items():
        assert got[at] == pytest.approx(values, abs=1e-9), at
    assert any(v < site_tree.LEAST_IMPORTANCE for _, v, _ in want.values())
