"""Operators over pages, vectors and personal data against plain Python."""

from __future__ import annotations

import collections
import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadlens.llm import disclosure, prefix_forest, url_families, url_filter, wrappers
from roadlens.llm.common import table

# -- pages ------------------------------------------------------------------


def article_of(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"</?(?:h1|p)>", re.sub(r"<br>", " ", inner))
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_wrappers_query(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    out = entry.queries()["op1_wrappers"](spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.url == pages[r.page_id].url
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text)


SITE = """<!doctype html><html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body>
<header><div class="logo">Site name</div></header><ul class="main-menu"><li><a href="/a">Home</a><li><a href="/b">News</a></ul>
<div class="cookie-notice"><p>We use cookies.</p></div><div id="sidebar"><p>Popular now</p></div>
{body}<div class="comments"><p>First!</p></div><form><p>Search</p></form><aside><p>More</p></aside><footer><p>&copy; Us</p></footer></body>"""


def site_page(body):
    return SITE.replace("{body}", body)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><header><h1>A  title</h1></header><p>One &amp; <b>two</b><i>three</i>.\n four<p>Five<br>six</article>", "A title\nOne & twothree. four\nFive six"),
        ("<main><h2>Head</h2><ul><li>x</li><li>y</li></ul><div class=ad><p>Buy</p></div>tail</main>", "Head\nx\ny\ntail"),
        ('<div class="post-content"><p title="a>b">Some &lt;text&gt; here</p></div>', "Some <text> here"),
        ("<div><p>No marks at all</p></div>", "No marks at all"),
        ("<article><!-- <p>gone</p> --><style>p{}</style><p>&#233;&eacute;&nbsp;z</p><nav>in</nav></article>", "éé z"),
    ],
)
def test_article_is_found_among_boilerplate(spark, body, text):
    pages = [(i, f"http://h.test/{i}", site_page(body)) for i in range(2)]
    out = wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert [r.text for r in out] == [text, text]


def test_template_text_without_marks_is_dropped(spark):
    page = "<body><div>Welcome to us</div><div><p>Story {i}</p><p>Told {i} times</p></div><div>All rights</div></body>"
    pages = [(i, "http://h.test/", page.replace("{i}", str(i))) for i in range(8)]
    out = wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"Story {i}\nTold {i} times" for i in range(8)}


def extracted(spark, pages, host="h.test"):
    rows = [(i, f"http://{host}/{i}", page) for i, page in enumerate(pages)]
    out = wrappers.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single post has-sidebar"><article><p>{}</p></article></body>',
        '<body><main class="overflow-hidden"><p>{}</p></main></body>',
        '<body><article class="post comments-open"><p>{}</p></article></body>',
        '<body><div class="content no-sidebar"><p>{}</p></div></body>',
        "<html><head><title>T</title><meta charset=utf-8><body><article><p>{}</p></article>",
        "<head><title>T</title><p>{}</p>",
        '<body><div class="comment-page"><p>{}</p><p>and {}</p></div><div class="ads">Buy</div></body>',  # the name of the page, not of a part
        '<main><h1>{}</h1><p>{} at length, with more to say</p><article class="teaser">t{}</article></main>',
    ],
)
def test_names_of_classes_do_not_empty_ordinary_pages(spark, page):
    got = extracted(spark, [page.replace("{}", f"story {i}") for i in range(6)])
    assert all(f"story {i}" in text and "Buy" not in text and "tstory" not in text for i, text in enumerate(got))


def test_region_is_told_by_its_text_not_its_name(spark):
    """No marks at all: text equal on different pages is template, subheads between own blocks are not, and the wrapper decides."""
    page = "<body><div>Welcome to us</div><section><p>Story {i}</p><p>Method</p><p>Told {i} times</p></section><div>All rights</div></body>"
    copies = [page.replace("{i}", "7")] * 9  # copies of one page are one page
    assert extracted(spark, copies) == ["Welcome to us\nStory 7\nMethod\nTold 7 times\nAll rights"] * 9
    pages = [page.replace("{i}", str(i)) for i in range(12)]
    assert extracted(spark, [*pages, *copies]) == [f"Story {i}\nMethod\nTold {i} times" for i in [*range(12), *[7] * 9]]


def test_many_streams_of_a_host_meet_level_by_level(spark):
    """More different streams than one task aligns; the wrapper still finds the template around all of them."""
    rng = np.random.default_rng(6)
    pages, want = [], []
    for i in range(150):
        blocks = [(("h2", "p", "blockquote", "pre", "dt")[k], f"t{i} {n}") for n, k in enumerate(rng.integers(0, 5, 12))]
        pages.append("<body><div>Site head</div><section>" + "".join(f"<{b}>{t}</{b}>" for b, t in blocks) + "</section><div>Site foot</div></body>")
        want.append("\n".join(t for _, t in blocks))
    assert extracted(spark, pages) == want


def test_alignment_of_long_mixed_streams():
    """Divided alignment finds as long a common subsequence as the whole table, in little memory."""
    rng = np.random.default_rng(7)
    a, b = ([str(k) for k in rng.integers(0, 4, 600)] for _ in range(2))
    whole = wrappers.matches(a, b)
    assert whole == sorted(whole) and all(a[i] == b[j] for i, j in whole)
    small, wrappers.LARGEST_TABLE = wrappers.LARGEST_TABLE, 1000
    try:
        divided = wrappers.matches(a, b)
    finally:
        wrappers.LARGEST_TABLE = small
    assert len(divided) == len(whole) and all(a[i] == b[j] for i, j in divided)
    x, y = (rng.integers(0, 5, 8_000).astype(str).tolist() for _ in range(2))
    assert len(wrappers.matches(x, y)) > 4_000
    page = "<section>" + "".join(f"<{t}>x{i}</{t}>" for i, t in enumerate(rng.choice(["h2", "p", "pre", "dt", "td"], 4_000))) + "</section>"
    pattern, held, texts = wrappers.folded_page(page)
    assert sorted(i for h in held for i in h) == list(range(4_000)) and len(texts) == 4_000


def test_wrapper_has_optional_and_repeated_groups():
    pages = ["<article><h1>a</h1>" + "<p>x</p>" * n + "</article>" + "<div>d</div>" * (n % 2) for n in (1, 2, 5)]
    parts = []
    for page in pages:
        pattern, held, _ = wrappers.folded_page(page)
        parts.append(wrappers.to_items(pattern, [[1, i, i, 1] for i in range(len(held))]))
    wrapper = wrappers.infer(parts)
    assert [(x.key, x.optional) for x in wrapper] == [
        ("article", False), ("h1", False), ("#", False), ("(p #)+", False), ("/article", False), ("div", True), ("#", True), ("/div", True),
    ]


def test_wrappers_awkward_rows(spark):
    schema = "page_id long, url string, html string, host string, slots string"
    long_page = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    rows = [
        (1, None, None, "h", "s"), (1, None, None, "h", "s"), (None, "no url", "", None, None), (2, "http://a.test", "plain <", None, None),
        (3, "http://a.test", "<p>unclosed <b>x <script>y", None, None), (4, "http://a.test", long_page, None, None),
        (5, "http://a.test", "<!-- open <p>x</p>", None, None), (6, "http://b.test", "<article><p a='>x</p>", None, None),
    ]
    out = wrappers.extract_text(spark.createDataFrame(rows, schema))
    got = collections.Counter((r.page_id, r.text) for r in out.collect())
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert got[(1, "")] == 2 and got[(None, "")] == 1 and got[(2, "plain <")] == 1 and got[(3, "unclosed x")] == 1
    assert got[(4, "\n".join(["word"] * 30_000))] == 1 and got[(5, "")] == 1 and sum(got.values()) == 8
    assert wrappers.extract_text(spark.createDataFrame([], schema)).collect() == []


# -- urls -------------------------------------------------------------------


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_for(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in table(spark, sf_dir, "pages").collect()}
    out = entry.queries()["op6_urls"](spark, sf_dir).collect()
    assert len(out) == len(urls)
    bad = ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm", "ads-track")
    for r in out:
        assert (r.host, r.path) == url_parts(urls[r.page_id])
        rule, verdict = rule_for(r.host, r.path)
        assert r.rule == rule
        if verdict:
            assert r.verdict == verdict
        else:  # no fixed rule: the hosts that say what they sell are blocked, and no others
            assert r.verdict == ("block" if any(b in r.host for b in bad) else "allow")


def test_url_awkward_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Org/ES/1", "http://x.example.org/es/1", "http://example.org/en/12", "http://notexample.org",
            "x://É.com/fr/?q", "http://a.com/de/#x", "http://a.com/de", "http://a.com?x=/fr/", "http://" + "a" * 50_000, "a://b://c/d", "http://org/"]
    rows = [(i, u, "clash", 1) for i, u in enumerate(urls)] + [(None, urls[4], "clash", 1)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string, p_block int")
    model = url_filter.fit(url_filter.default_labels(spark))
    out = url_filter.judge(df, model).collect()
    assert len(out) == len(rows)
    for r in out:
        url = urls[4 if r.page_id is None else r.page_id]
        assert (r.host, r.path) == url_parts(url)
        rule, verdict = rule_for(*url_parts(url))
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert url_filter.judge(df.limit(0), model).collect() == []
    one_sided = url_filter.fit(spark.createDataFrame([("http://a.test/", 0)], "url string, blocked int"))
    assert {r.verdict for r in url_filter.judge(df, one_sided).collect() if r.rule is None} == {"allow"}


def test_url_model_on_words_held_out_of_training(spark):
    """A quarter of all words, and of the invented names, is kept from each of two models."""
    rows = list(url_families.labelled_urls())
    assert len(rows) <= url_filter.MAX_TRAINING_ROWS and 0.2 < np.mean([r[1] for r in rows]) < 0.3
    blocked = collections.defaultdict(list)
    for fold in (0, 1):
        held = [[zlib.crc32(w.encode()) % 4 == fold for w in words or [url]] for url, _, words in rows]
        model = url_filter.fit(spark.createDataFrame([r[:2] for r, h in zip(rows, held) if not any(h)], "url string, blocked int"))
        tested = [(i, r[0]) for i, (r, h) in enumerate(zip(rows, held)) if any(h)]
        for r in url_filter.judge(spark.createDataFrame(tested, "page_id long, url string"), model, rules=()).collect():
            _, label, words = rows[r.page_id]
            kind = "invented" if not words else "unknown" if all(held[r.page_id]) else "half known"
            blocked[kind, label].append(r.verdict == "block")
    rate = {k: np.mean(v) for k, v in blocked.items()}
    assert rate["half known", 1] > 0.7 and rate["half known", 0] == 0 and rate["invented", 0] < 0.005
    assert rate["unknown", 0] < 0.08 and rate["unknown", 1] > rate["unknown", 0]


def test_url_hosts_that_are_not_in_the_table(spark):
    junk = "poker-kings roulette-wheel warez-zone free-torrents blackjack-live porn-hd cheap-viagra payday-loan replica-bags online-slots".split()
    # clean names with a whole blocked word inside (alphabets, tracking-parcels) are the method's known mistakes
    clean = "winery lecture-notes mountain-bike farmhouse-cheese garden-tools bookbinding swimwear tax-office children-hospital astro-club".split()
    rows = list(enumerate(f"https://{n}.test/x" for n in junk + clean))
    model = url_filter.fit(url_filter.default_labels(spark))
    out = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), model, rules=()).collect()}
    assert sum(out[i] == "block" for i in range(len(junk))) >= 8
    assert sum(out[i] == "block" for i in range(len(junk), len(rows))) <= 1


def test_url_scores_equal_sums_of_weights(spark):
    rng = np.random.default_rng(0)
    model = url_filter.UrlModel(rng.normal(size=url_filter.BUCKETS), 0.3)
    hosts, paths = ["a.test", "", "xy"], ["/p/1", "/", ""]
    row, bucket = url_filter.gram_buckets(pa.array(hosts), pa.array(paths))
    expected_counts = [sum(max(0, len(h) + 2 - n + 1) + max(0, len(p) - n + 1) for n in url_filter.SIZES) for h, p in zip(hosts, paths)]
    assert np.bincount(row, minlength=3).tolist() == expected_counts
    alone = [url_filter.UrlModel(model.weights, 0.3).logit(pa.array([h]), pa.array([p]))[0] for h, p in zip(hosts, paths)]
    assert np.allclose(model.logit(pa.array(hosts), pa.array(paths)), alone)


# -- vectors ----------------------------------------------------------------


def nearest_by_force(vectors, query_ids, k=5):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        at = np.flatnonzero(ids == q)[0]
        score = x @ x[at]
        order = np.lexsort((ids, -np.round(score, 12)))
        out[q] = [int(ids[i]) for i in order if ids[i] != q][:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_forest_query(spark, sf):
    rows = table(spark, f"/root/testdata/{sf}", "embeddings").collect()
    out = entry.queries()["op10_forest"](spark, f"/root/testdata/{sf}").collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    expected = nearest_by_force([(r.vec_id, r.embedding) for r in rows], [r.vec_id for r in rows if r.vec_id % 50 == 0])
    hits = sum(len(set(expected[q]) & set(got[q])) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    vectors = {r.vec_id: np.array(r.embedding, float) for r in rows}
    for r in out:
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_forest_recall_when_prefixes_decide(spark):
    """Far more vectors than a query's candidates: the trees, not the whole table, are searched."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(300, 32))
    x = np.repeat(centres, 20, axis=0) + 0.35 * rng.normal(size=(6000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = prefix_forest.search(df, F.col("vec_id") % 50 == 0, candidates=300).collect()
    got = collections.defaultdict(set)
    for r in out:
        got[r.query_id].add(r.vec_id)
    expected = nearest_by_force([(i, v.astype(np.float32)) for i, v in enumerate(x)], range(0, 6000, 50))
    assert sum(len(set(expected[q]) & got[q]) for q in expected) >= 0.9 * 5 * len(expected)


def test_forest_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]),
        (7, [float("inf"), 1.0]), (8, [0.0, 1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (50, [0.0, 1.0]), (100, None), (150, [0.0, 0.0]),
        (1, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, entry string, rank int")
    out = prefix_forest.search(df, F.col("vec_id") % 50 == 0, trees=4)
    got = collections.defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    assert dict(got) == {
        0: [(1, 1, 1.0), (2, 1, 1.0), (3, 2, 1.0), (4, 8, 0.0), (5, 50, 0.0)],
        50: [(1, 8, 1.0), (2, 0, 0.0), (3, 1, 0.0), (4, 1, 0.0), (5, 2, 0.0)],
    }
    assert prefix_forest.search(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_forest_many_equal_vectors(spark):
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0), F.lit(2.0))).otherwise(
        F.array(F.cos("id"), F.sin("id"), F.cos(F.col("id") * 2))).alias("embedding"))
    out = prefix_forest.search(df, F.col("vec_id") % 50 == 0, trees=4).where("query_id % 3 = 0").collect()
    for r in out:
        expected = [i for i in range(0, 18, 3) if i != r.query_id][:5]
        assert r.vec_id == expected[r.rank - 1] and r.score == pytest.approx(1.0)


def test_forest_dense_group_of_scaled_and_near_copies(spark):
    """Hundreds of entries closer to each other than the 8-bit form can tell apart."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    near = [base + 1e-3 * rng.normal(size=16) for _ in range(400)]
    scaled = [2.0 ** (i % 40) * base for i in range(400, 440)]
    x = [*near, *scaled, *rng.normal(size=(560, 16))]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in sorted(prefix_forest.search(df, F.col("vec_id") % 50 == 0, trees=4).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert dict(got) == nearest_by_force(list(enumerate(x)), range(0, 1000, 50))


def test_cosines_of_huge_and_tiny_vectors():
    a = np.array([[3e160, 4e160], [3e-170, 4e-170], [3.0, 4.0], [5e-324, 0.0]])
    b = np.array([[4e-300, 3e-300], [4e300, 3e300], [4.0, 3.0], [1e308, 1e308]])
    assert np.allclose(prefix_forest.cosines(a, b), [0.96, 0.96, 0.96, 0.5**0.5], rtol=1e-15)


def test_forest_finds_enough_in_a_far_group_of_few(spark):
    """Three entries far from all others share every run; the answer still has five rows."""
    rng = np.random.default_rng(4)
    x = [*(1000 + 0.001 * rng.normal(size=(3, 12))), *(rng.normal(size=(2000, 12)) - 3)]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = prefix_forest.search(df, F.col("vec_id") == 0).collect()
    assert sorted(r.rank for r in out) == [1, 2, 3, 4, 5] and {1, 2} == {r.vec_id for r in out if r.rank <= 2}


# -- personal data ----------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base_by_force(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def test_disclosure_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    out = entry.queries()["op8_disclosure"](spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        expected = base_by_force(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in expected) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(joined(expected).encode()).hexdigest()
        assert set(joined(expected).split(",")) - {""} <= set(r.spans.split(","))


def test_base_spans_on_awkward_texts(spark):
    texts = [
        "", "a@b.c_x@d.e é +1 (499) 555-6503. 1.2.3.4.5 0.0.0.256 4111 1111 1111 1111x 4111-1111-1111-1111\n\n\U0001d4b3 x@y.zz@q.r",
        "+1 2 3 +12345678901234567", "1.2.3.4\n5.6.7.8@a.b-c.d 255.255.255.255 001.2.3.04", "a@b.c" * 300, "9" * 5000 + " a.a@" + "b." * 3000,
        "x" * 200_000 + "@", "1 " * 50_000, "+1" * 1000, "1." * 5000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", disclosure.base_spans(F.col("text")).alias("s")).collect():
        assert [(s.start, s.order, s.end, s.kind) for s in r.s] == base_by_force(texts[r.doc_id])


def disclosing_by_force(texts):
    """(entity, word) pairs by their definition."""
    texts = [t or "" for t in texts]
    spans = [[(a, b) for a, _, b, _ in base_by_force(t)] for t in texts]
    entities = [{t[a:b].lower() for a, b in own} for t, own in zip(texts, spans)]
    words = [
        {m[0].lower() for m in re.finditer(r"[^\W_]+", t) if not any(a < m.end() and m.start() < b for a, b in own)}
        for t, own in zip(texts, spans)
    ]
    pairs = sum(len(e) * len(w) for e, w in zip(entities, words))
    needed = disclosure.MARGIN + np.log2(max(pairs, 1))
    n, out = len(texts), set()
    n_word = collections.Counter(w for own in words for w in own)
    for e in set().union(*entities):
        holding = [i for i in range(n) if e in entities[i]]
        ic = np.log2(n / len(holding))
        for w in set().union(*(words[i] for i in holding)):
            both = [i for i in holding if w in words[i]]
            pmi = np.log2(n * len(both) / n_word[w] / len(holding))
            if pmi >= disclosure.DISCLOSURE * ic - 1e-9 and len({texts[i] for i in both}) * pmi >= needed - 1e-9:
                out.add((e, w))
    return out


@pytest.fixture(scope="module")
def told_rows():
    texts = [f"Quirin the baker\nstall {i}\nWrite to jo@x.org, room {i}\nask for Quirin" for i in range(9)]
    texts += ["Call the office at +1 499 555 6503\nthe end of Mabel"] * 9  # copies disclose nothing
    texts += [f"the words and the room {i} of a stall" for i in range(60)]
    return [(i, t) for i, t in enumerate(texts)]


def test_disclosing_words(spark, told_rows):
    df = spark.createDataFrame(told_rows, "doc_id long, text string")
    spanned = disclosure.with_base_spans(df)
    got = {(r.entity, r.word) for r in disclosure.disclosing_words(df, spanned, disclosure.free_words(spanned)).collect()}
    assert got == disclosing_by_force([t for _, t in told_rows])
    assert ("jo@x.org", "quirin") in got and not any(e.startswith("+1") for e, _ in got) and ("jo@x.org", "room") not in got
    out = {r.doc_id: r for r in disclosure.sanitise_spans(df).collect()}
    text = told_rows[0][1]
    marked = [(s.start, text[s.start : s.end]) for s in out[0].spans if s.kind == "term"]
    # on other lines than the address, before and after it, as often as they stand there
    assert (0, "Quirin") in marked and (text.rindex("Quirin"), "Quirin") in marked and "baker" in dict(map(reversed, marked)) and "room" not in dict(map(reversed, marked))
    clean = df.join(spark.createDataFrame([(0, out[0].spans)], f"doc_id long, spans {disclosure.SPANS}"), "doc_id")
    text = clean.select(disclosure.sanitised(F.col("text"), F.col("spans"))).first()[0]
    assert "Quirin" not in text and "jo@x.org" not in text and "<EMAIL>" in text and "<TERM>" in text and "room 0" in text


def test_random_corpora_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    names, common = [f"name{i}" for i in range(12)], [f"word{i}" for i in range(30)]
    rows = []
    for i in range(160):
        who = int(rng.integers(0, 12))
        lines = [" ".join(rng.choice(common, 5)) for _ in range(3)]
        if i % 4 == 1 and rng.random() < 0.9 or rng.random() < 0.02:
            lines.insert(int(rng.integers(0, 3)), f"{names[who]} {names[who][::-1]}")
        if i % 4 == 1:
            lines.insert(int(rng.integers(0, 3)), f"{names[who]}@mail.org 10.0.0.{who}")
        rows.append((i, None if i == 7 else "\n".join(lines)))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spanned = disclosure.with_base_spans(df)
    got = {(r.entity, r.word) for r in disclosure.disclosing_words(df, spanned, disclosure.free_words(spanned)).collect()}
    assert got == disclosing_by_force([t for _, t in rows]) and len(got) > 10


def test_words_that_are_part_of_the_entity_disclose_it(spark):
    texts = [f"ask Anna Smith\nanna.smith@mail.org for {i}" for i in range(8)] + ["write to anna.smith@mail.org"] * 2
    texts += [f"ask the office for {i}" for i in range(70)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in disclosure.sanitise_spans(df).collect()}
    for i, text in enumerate(texts):
        marked = [text[s.start : s.end] for s in out[i].spans if s.kind == "term"]
        assert marked == (["Anna", "Smith"] if i < 8 else [])
    spanned = disclosure.with_base_spans(df)
    got = {r.word: (r.pmi, r.ic) for r in disclosure.disclosing_words(df, spanned, disclosure.free_words(spanned)).collect()}
    assert set(got) == {"anna", "smith"} and all(pmi == pytest.approx(ic) for pmi, ic in got.values())


def test_words_that_meet_base_spans_are_left_out(spark):
    text = "aaaaa bbb ccccc ddd eeeee fff ggggg"
    base = [("email", 2, 7), ("ip", 4, 18), ("card", 17, 18), ("phone", 28, 29)]
    rows = [(s, disclosure.KINDS.index(k), e, k, "x") for k, s, e in base]
    spanned = spark.createDataFrame([(1, text, rows, ["x"]), (2, text, [], [])], f"row_id long, text string, spans {disclosure.SPANS}, entities array<string>")
    got = [(w.start, w.end, w.word) for r in disclosure.free_words(spanned).collect() for w in r.free]
    want = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\w+", text) if not any(s < m.end() and m.start() < e for _, s, e in base)]
    assert sorted(got) == want == [(20, 25, "eeeee"), (30, 35, "ggggg")]


def test_disclosure_awkward_rows(spark):
    rows = [(1, None), (1, None), (None, "a@b.cc\na@b.cc"), (2, ""), (3, "line\n" * 20_000 + "q@r.ss" + " 1.2.3.4" * 2_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, row_id int")
    out = disclosure.sanitise_spans(df).collect()
    assert collections.Counter((r.doc_id, len(r.base)) for r in out) == {(1, 0): 2, (None, 2): 1, (2, 0): 1, (3, 2001): 1}
    assert disclosure.sanitise_spans(df.limit(0)).collect() == []
