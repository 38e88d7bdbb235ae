"""WARC archives and HTML extraction."""

import gzip
import math
import os
import random
import tempfile
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlens.llm.html_text import Page, Paths, extract, main_text, path_scores
from eventlens.llm.warc import Slice, WarcReader, archive_round_trip, digest_of, member, read_warc, record_bytes, register, write_warc
from eventlens.session import scratch_path

PAGES = [(1, "http://a/ü\nx", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 300_000), (6, "u", "<p>same</p>"), (6, "u", "<p>same</p>"), (7, "u", "tail\r\n\r\n")]


def table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, sha string, payload string").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = archive_round_trip(table(spark), least).collect()
    expected = Counter()
    for i, _, h in PAGES:
        data = (h or "").encode()
        first = min(j for j, _, g in PAGES if (g or "") == (h or ""))
        again = first != i and len(data) >= least
        expected[(str(i), "revisit" if again else "response", len(data), digest_of(data), str(first) if again else None)] += 1
    assert Counter((r["record_id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got) == expected


def test_payloads_and_pushdown(spark):
    path = scratch_path(spark, "t-warc")
    archive_round_trip(table(spark), 0, path)
    full = {r["record_id"]: r for r in read_warc(spark, path).collect() if r["record_type"] == "response"}
    assert bytes(full["5"]["payload"]) == ("é" * 300_000).encode() and bytes(full["7"]["payload"]) == b"tail\r\n\r\n"
    assert full["1"]["target_uri"] == "http://a/ü x"
    some = read_warc(spark, path, "skip").filter((F.col("record_type") == "response") & F.col("record_id").isin("1", "5"))
    assert sorted(r["record_id"] for r in some.collect()) == ["1", "5"]
    reader = WarcReader(path, "skip")
    from pyspark.sql.datasource import EqualTo, GreaterThan

    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 3)]))
    assert len(rest) == 1 and sum(len(b) for p in reader.partitions() for b in reader.read(p)) == 4


def test_empty(spark):
    assert archive_round_trip(table(spark, [])).count() == 0


def test_foreign_archives(spark):
    """Plain and gzipped archives without sidecars, manifests or extra fields."""
    records = [{"record_id": str(i), "record_type": "response", "target_uri": "u", "refers_to": None, "payload": b"p%d" % i * 5000} for i in range(5)]
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "a.warc"), "wb") as f:
        f.write(b"".join(record_bytes(r) for r in records[:2]))
    with open(os.path.join(folder, "b.warc.gz"), "wb") as f:
        f.write(b"".join(gzip.compress(record_bytes(r)) for r in records[2:]))
    for mode in ("full", "skip"):
        assert sorted(r["record_id"] for r in read_warc(spark, folder, mode).collect()) == list("01234")
    assert {bytes(r["payload"]) for r in read_warc(spark, folder).collect()} == {r["payload"] for r in records}


def test_uncommitted_files_are_not_read(spark):
    path = scratch_path(spark, "t-warc-part")
    register(spark)
    rows = spark.createDataFrame([("1", "response", "u", None, b"x")], "record_id string, record_type string, target_uri string, refers_to string, payload binary")
    write_warc(rows, path)
    local = path.removeprefix("file:")
    with open(os.path.join(local, "part-lost.warc.gz"), "wb") as f:
        f.write(member(record_bytes({"record_id": "2", "record_type": "response", "target_uri": "u", "refers_to": None, "payload": b"y"})))
    assert [r["record_id"] for r in read_warc(spark, path).collect()] == ["1"]


def test_payload_of_unwanted_records_is_not_inflated(tmp_path):
    big = os.urandom(1 << 20)
    data = b"".join(member(record_bytes({"record_id": str(i), "record_type": "response", "target_uri": "u", "refers_to": None, "payload": big})) for i in range(3))
    (tmp_path / "x.warc.gz").write_bytes(data)
    reader = WarcReader(str(tmp_path), "skip")
    calls = []
    import eventlens.llm.warc as warc

    original = warc._Record._more
    warc._Record._more = lambda self: calls.append(1) or original(self)
    try:
        assert sum(len(b) for b in reader.read(Slice(str(tmp_path / "x.warc.gz"), 0, None))) == 3
    finally:
        warc._Record._more = original
    assert not calls


ARTICLE = "<article><h1>Head &amp; line</h1><p>First paragraph, with <b>bo</b>ld words;\n and more text in it.</p><p>Second one. It also says things, at length.<br>Next line.</article>"
FRAME = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) { x = '</p>' }</script></head><body><header>Site name</header><nav><ul><li><a href=x>Menu</a></li></ul></nav>%s<aside>Other stories, many of them, all of them long enough to fool a ratio.</aside><form><label>Mail</label><input><button>Go</button></form><footer>&copy; all rights, reserved.</footer></body></html>"
TEXT = "Head & line First paragraph, with bold words; and more text in it. Second one. It also says things, at length. Next line."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), (" \n", ""), ("plain &lt;text&gt;\n only", "plain <text> only"), ("<p></p><script>x</script>", ""), (FRAME % ARTICLE, TEXT),
        (FRAME % ("<div class='cookie-notice'>We use cookies, as all do, sorry.</div>" + ARTICLE + "<section id=comments><p>Great article, I liked it, thanks a lot, really.</p></section>"), TEXT),
        (FRAME % ARTICLE.replace("article", "div"), TEXT),
        (FRAME % ARTICLE.replace("</article>", "<div class=comments>I disagree, strongly, with all of it.</div></article>"), TEXT),
        ("<article>a<!-- b > c --><textarea>no</textarea>d", "a d"), ("<article><p title='a > b'>x &#233;&hellip;</p>\x00", "x é… \x00"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


LONG = "Long sentences, with commas, fill this paragraph; they say things, and say them again, at length, number %d."


def test_every_element_with_content():
    """Several articles of other ids and classes, and content paths beside the main element of the text, are all kept."""
    texts = [LONG % i for i in range(24)]
    articles = "".join(f"<article id=post-{i} class='post c{i}'><p>{t}</p></article>" for i, t in enumerate(texts))
    assert main_text(FRAME % articles) == " ".join(texts)
    most = "".join(f"<p>{t}</p>" for t in texts[:-1])
    assert main_text(FRAME % f"<div id=a class=text>{most}</div><section id=b><blockquote>{texts[-1]}</blockquote></section>") == " ".join(texts)


@pytest.mark.parametrize("name", ["layout no-sidebar", "has-sidebar", "sidebar", "share-price-report", "page widget"])
def test_names_around_the_article(name):
    texts = [LONG % i for i in range(6)]
    paragraphs = "".join(f"<p>{t}</p>" for t in texts)
    assert main_text(FRAME % f"<div class='{name}'><article>{paragraphs}</article></div>") == " ".join(texts)
    assert main_text(FRAME % f"<div class='{name}'>{paragraphs}</div>") == " ".join(texts)


def test_names_on_every_block_and_on_a_section():
    texts = [LONG % i for i in range(6)]
    blocks = "".join(f"<div class='elementor-widget'><p>{t}</p></div>" for t in texts)
    assert main_text(FRAME % blocks) == " ".join(texts)
    section = f"<p>{texts[0]}</p><p>{texts[1]}</p><section class=share-price-report><h2>Price</h2><p>{texts[2]}</p></section>"
    advert = f"<div class=ad><p>{texts[3]}</p></div>"
    assert main_text(FRAME % f"<article>{section}{advert}</article>{advert}") == " ".join([*texts[:2], "Price", texts[2]])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p title=it's>Hello world text here.</p><p>Second, Don't stop.</p><p>Third one's fine.</p>", "Hello world text here. Second, Don't stop. Third one's fine."),
        ("<p class=a\"b>One, two.</p><p>Three \"four\".</p>", 'One, two. Three "four".'), ('<div><a href="x>link</a><p>Text, here.</p></div>', "Text, here."),
        ("<p '>Text, here.</p><p>It's more.</p>", "Text, here. It's more."), ("<p title='a > b' class = \"c>d\">Text, here.</p>", "Text, here."),
        ("a < b and <c", "a < b and <c"), ("<p>One, two.</p><![CDATA[ no ]]><p>Three, four.</p><!-- never closed <p>x", "One, two. Three, four."),
        ("<p>One, two.<svg/>Three, four.</p>", "One, two. Three, four."), ("<p>x.</b></i></p>y, z.</div>", "x. y, z."),
    ],
)
def test_faulty_tags(page, text):
    assert main_text(page) == text


SIX = [LONG % i for i in range(6)]


@pytest.mark.parametrize("name", ["comments", "user-comments", "disqus_thread", "post-comments-area", "commentList", "x reader_comments"])
@pytest.mark.parametrize("item", ["<p>%s</p>", "<div class=c><p>%s</p></div>", "<article><p>%s</p></article>", "<li class='comment even'><p>%s</p></li>"])
def test_comments_are_left_out_whatever_their_size(name, item):
    six = "".join(f"<p>{t}</p>" for t in SIX)
    for n in (1, 3, 7, 30, 200):
        said = "".join(item % f"I agree, mostly, with number {i}; still, it could be better, or longer." for i in range(n))
        for tag in ("section class", "div id"):
            section = f"<{tag}='{name}'><h3>Comments</h3>{said}</{tag.split()[0]}>"
            for around in ("<article>%s</article>", "<div class=post>%s</div>", "<main><div>%s</div></main>"):
                assert main_text(FRAME % (around % six + section)) == " ".join(SIX)
                assert main_text(FRAME % (around % (six + section))) == " ".join(SIX)


@pytest.mark.parametrize("name", ["no-comments", "comments-open", "has-comments", "comment-count"])
def test_names_about_comments_are_not_comments(name):
    six = "".join(f"<p>{t}</p>" for t in SIX)
    assert main_text(FRAME % f"<div class='{name}'><article>{six}</article></div>") == " ".join(SIX)
    assert main_text(FRAME % f"<div class='{name}'>{six}</div>") == " ".join(SIX)
    assert main_text(FRAME % f"<article class='content--type-comment'>{six}</article>") == " ".join(SIX)


def test_a_menu_in_an_article_is_below_the_threshold():
    six = "".join(f"<p>{t} <a href=x>A link</a></p>" for t in SIX)
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Topic {i}</a></li>" for i in range(9)) + "</ul>"
    text = " ".join(f"{t} A link" for t in SIX)
    assert main_text(FRAME % f"<article><h1>Title</h1>{menu}{six}</article>") == f"Title {text}"
    listed = "<ul><li>plain item</li><li>another <a href=x>linked</a> item</li></ul>"
    assert main_text(FRAME % f"<article>{six}{listed}</article>") == f"{text} plain item another linked item"


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000, "<! " * 300_000, '<a x="' * 150_000, "<p title='>" * 100_000, "<" * 1_000_000, "<font>" * 120_000 + "x", "</" * 300_000,
        "<font>" * 50_000 + "</b>" * 150_000, "<font>" * 40_000 + "<p>x" * 80_000, "<![CDATA[>" * 100_000, "<div class=comments>" * 40_000 + "x", "<svg>" * 100_000,
    ],
    ids=range(12),
)
def test_faulty_pages_take_time_in_proportion(page):
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 8


def plain_scores(page):
    """The ratios of unnamed paths by their definition, one node after another."""
    nodes = [(tuple(path(n.inside)), n) for n in page.nodes if n.size]
    per = {p: [n for q, n in nodes if q == p] for p, _ in nodes}
    points = lambda n: sum(c in ".,;:!?…。，、！？" for c in n.text)
    ratio = {p: (sum(n.size for n in ns) / len(ns), sum(map(points, ns)) / len(ns)) for p, ns in per.items()}
    scores = {}
    for p, ns in per.items():
        total = 0.0
        for i, (q, _) in enumerate(nodes):
            if q == p:
                near = [(math.exp(-0.5 * (i - j) ** 2), ratio[nodes[j][0]]) for j in range(max(i - 2, 0), min(i + 3, len(nodes)))]
                text, marks = (sum(w * r[k] for w, r in near) / sum(w for w, _ in near) for k in (0, 1))
                total += math.log1p(text) * (1 + math.log1p(marks))
        in_links = sum(n.size for n in ns if "a" in p) / sum(n.size for n in ns)
        scores[p] = total / len(ns) * (1 - in_links) * (2 if {"article", "main"} & set(p) else 1)
    return scores


def path(element):
    return path(element.above) + [element.tag] if element.above is not None else []


@pytest.mark.parametrize("seed", range(20))
def test_ratios_against_their_definition(seed):
    rng = random.Random(seed)
    tags = ["p", "div", "a", "b", "article", "ul", "li", "h2", "span", "section"]
    page = "".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "One word ", "Text, with; marks. ", "long " * rng.randint(1, 40)]) for _ in range(rng.randint(5, 120)))
    read = Page(page)
    if not any(n.size for n in read.nodes):
        return
    paths = Paths(read.elements, {})
    got = path_scores(read.nodes, paths)
    want = plain_scores(read)
    named = {paths.of[n.inside.number]: tuple(path(n.inside)) for n in read.nodes if n.size}
    assert {named[p]: pytest.approx(s) for p, s in got.items()} == want


def test_null_ids_in_archives(spark):
    rows = [(None, "u", "<p>a</p>"), (4, "u", "<p>a</p>"), (None, "u", "<p>b</p>"), (None, "u", "<p>b</p>")]
    got = archive_round_trip(table(spark, rows)).collect()
    assert sorted((r["record_id"] or "", r["record_type"], r["refers_to"]) for r in got if r["payload_digest"] == digest_of(b"<p>a</p>")) == [("", "revisit", "4"), ("4", "response", None)]
    assert [(r["record_id"], r["record_type"]) for r in got if r["payload_digest"] == digest_of(b"<p>b</p>")] == [(None, "response")] * 2


def test_extract_with_columns_of_its_results(spark):
    rows = spark.createDataFrame([(1, "u", FRAME % ARTICLE, "t", 5)], "page_id bigint, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in extract(rows).collect()] == [(1, "u", TEXT, len(TEXT))]


def test_extract(spark):
    rows = [(1, "u", FRAME % ARTICLE), (1, "u", FRAME % ARTICLE), (2, None, None), (None, "u", "x" * 200_000)]
    got = extract(table(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        {(1, "u", TEXT, len(TEXT)): 2, (2, None, "", 0): 1, (None, "u", "x" * 200_000, 200_000): 1}
    )
    assert extract(table(spark, [])).count() == 0


def test_whole_pages_against_their_articles(spark):
    """The given pages put the whole article, and nothing else, in one element."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        assert found[r["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
