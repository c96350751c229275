"""Token counts and main text against the tokenizer itself and against written-out pages."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sievelake.llm import html_text, queries, token_counts

PATH = public_tokenizers.path(queries.TOKENIZER)
ODD = [
    None, "", " ", "\n\n a", "a  b   c\t\td ", "it's we'll I'D", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "<|endoftext|", "x1y22 3.14", "café naïve Ω 漢字 \U0001f600\u200d", "\u0558\ua7ce x", "\x00\x1c\x1d \x85\xa0\u2028", "ab" * 40_000, "word " * 20_000,
]


def counted(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes string, pieces string")
    found = token_counts.token_counts(docs, PATH, public_tokenizers.PATTERN).collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r.doc_id)]


def whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for t in texts:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        out.append((len((t or "").encode()), n, n > 512))
    return out


def test_counts_equal_the_tokenizer(spark):
    assert counted(spark, ODD) == whole(ODD)
    assert counted(spark, []) == []


def test_rows_with_the_same_or_no_id_are_counted_each(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "x y z"), (None, None)], "doc_id long, text string")
    found = token_counts.token_counts(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == sorted(
        (i, n) for i, (_, n, _) in zip([1, 1, 1, 0, 0], whole(["a b", "a b", "c", "x y z", None]), strict=True)
    )


def test_counts_of_the_given_texts(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert counted(spark, texts) == whole(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_pre_tokens_equal_the_tokenizer(text):
    import regex

    tokenizer = Tokenizer.from_file(PATH)
    pieces = token_counts.pre_tokens(tokenizer, regex.compile(public_tokenizers.PATTERN), text)
    assert "".join(pieces) == text
    assert sum(len(tokenizer.encode(p).ids) for p in pieces) == len(tokenizer.encode(text).ids) or "<|" in text


def texts_of(spark, pages):
    rows = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string, hashes string")
    return [r.text for r in sorted(html_text.main_text(rows).collect(), key=lambda r: r.page_id)]


def test_markup_decides(spark):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body><nav><ul><li><a>N</a></ul></nav>'
        '<!-- <p>c</p> --><div class="ad">Ad</div><div id="cookie-notice">We use</div><aside>Side</aside><article><header><h1>Title  &amp;\n one</h1></header>'
        "<p><b>Bold<br>more <i>in</i>line&nbsp;x<p>a&lt;b &#233;&eacute; 3 < 4<ul><li>one<li>two</ul><form>F<input></form>"
        '<section class="comments"><p>Reader says</p></section><p hidden>no</p></article><footer>&copy; f</footer></body></html>'
    )
    assert texts_of(spark, [("http://a.b/c", page)]) == ["Title & one Bold more inline x a<b éé 3 < 4 one two"]


@pytest.mark.parametrize("page,text", [
    ("<div class='content with-sidebar'><article><p>Whole text</p></article></div>", "Whole text"),
    ("<div id='page' class='has-sidebar'><div class='sidebar'>Side</div><p>Whole text</p></div>", "Whole text"),
    ("<div class='sidebar'>Side<main>Whole text</main>Side</div>", "Whole text"),
    ("<article><div class='entry-header'><h1>Title</h1></div><div class='header'>By me</div><p>Text</p></article>", "Title By me Text"),
    ("<article>Text<div class='comments'><article>Reader</article></div><div class='ad'>Ad</div></article>", "Text"),
    ("<div class='related'><article>Teaser</article></div><aside><article>Side</article></aside><p>Text", "Text"),
    ("<div class='wide cookie-banner'>We use</div><div class='main' role='main'>Text</div>", "Text"),
])
def test_wrappers_do_not_take_the_article_with_them(page, text):
    assert " ".join(line for _, line in html_text.lines(page)) == text


@pytest.mark.parametrize("name,head", [
    ("site-footer", "footer"), ("cookie-bar", "cookie"), ("user-comments", "comments"), ("ad-box", "ad"), ("menu-item", "menu"),
    ("comments-list", "comments"), ("adBox1", "ad"), ("main-menu", "menu"), ("share-buttons", "share"), ("with-sidebar", ""), ("has-sidebar", ""),
    ("main-content", "main"), ("social-science", "science"), ("ad-free", "free"), ("widget", "widget"), ("x__footer--dark", "dark"), ("42", ""),
])
def test_head_words(name, head):
    assert html_text.head_word(name) == head


def test_names_are_judged_by_their_head_word():
    page = (
        "<div class='site-footer'>F</div><div id='cookie-bar'>C</div><div class='user-comments'>U</div><div class='main-menu'>M</div><div class='menu-planning'>Week</div>"
        "<article>Text<div class='ad-box'>A</div><div class='menu-item'>I</div><div class='comments-list'>L</div><div class='share-buttons'>S</div><p class='ad-free'>More</p></article>"
    )
    assert html_text.lines(page) == [("open", "Week"), ("keep", "Text"), ("open", "More")]


@pytest.mark.parametrize("page,text", [
    ("<article><p title=it's>Hello world. Don't stop</p><p>second</p></article>", "Hello world. Don't stop second"),
    ("<article><p data-x = 'a > b' \"c>one</p><p class=\"x'y\">two</p></article>", "one two"),
    ("<article><a href=x?a='b>c</a></article>", "c"),
    ("<article><p title=\"never closed>not lost</p>", "not lost"),
    ("<article><div class=ad'>x</div>y</article>", "y"),
])
def test_quotes_count_after_an_equals_sign_only(page, text):
    assert " ".join(line for _, line in html_text.lines(page)) == text


def test_time_and_memory_grow_with_the_page():
    import time
    import tracemalloc

    start = time.perf_counter()
    html_text.lines("<div>" * 20_000 + "</p>" * 20_000 + "<b>" * 20_000 + "<td>" * 5_000)
    assert time.perf_counter() - start < 10
    rng = np.random.default_rng(3)
    a, b = rng.permutation(100_000).astype(np.int64), rng.permutation(100_000).astype(np.int64)
    a[::2] = b[::2] = -1
    tracemalloc.start()
    start = time.perf_counter()
    shared = html_text.common_lines(a, b)
    assert time.perf_counter() - start < 120 and tracemalloc.get_traced_memory()[1] < 1 << 29
    tracemalloc.stop()
    assert shared.sum() >= 50_000


def test_differencing_equals_brute_force(spark):
    """Hosts whose pages share some lines of a template: no longer cut removes fewer lines."""
    import random

    r = random.Random(8)
    pages, own = [], {}
    for host in range(6):
        template = [f"T{host} {i}." for i in range(12)]
        for n in range(20):
            lines = sorted(r.sample(range(12), r.randint(3, 9)))
            body = [template[i] for i in lines] + [f"only {host} {n}."]
            r.shuffle(body)
            url = f"http://h{host}.org/a/{n:03d}"
            pages.append((url, "".join(f"<div>{line}</div>" for line in body)))
            own[url] = (host, n, body)
    found = dict(zip([u for u, _ in pages], texts_of(spark, pages), strict=True))

    def longest(x, y):
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, j in np.ndindex(len(x), len(y)):
            table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    for url, (host, n, body) in own.items():
        text = found[url]
        kept = [line for line in body if line in text]
        assert f"only {host} {n}." in text
        sides = [own[f"http://h{host}.org/a/{m:03d}"][2] for m in (n - 1, n + 1) if 0 <= m < 20]
        lengths = [longest(body, side) for side in sides]
        dropped = len(body) - len(kept)
        assert max(lengths) <= dropped <= sum(lengths)
        assert all(any(line in side for side in sides) for line in body if line not in kept)


def test_odd_pages(spark):
    pages = [(None, None), ("", ""), ("x", "no tags at all"), ("http://a/b", "<p>unclosed <b>text"), ("http://a/c", "<"), ("http://a/d", "<script>x"),
             ("http://a/e", "<p>" + "long text " * 30_000), ("http://a/f", "<article>a</article><article>b</article>"), ("http://a/g", "</p></div>x")]
    assert texts_of(spark, pages) == ["", "", "no tags at all", "unclosed text", "<", "", ("long text " * 30_000).strip(), "a b", "x"]
    assert texts_of(spark, []) == []


@pytest.mark.parametrize("block", [256, 2])
def test_lines_shared_with_neighbours_go(spark, monkeypatch, block):
    monkeypatch.setattr(html_text, "PAGES_PER_BLOCK", block)
    own = [f"<div>Welcome</div><div>Own text {i}</div><div>Shop now</div><div>Last words {i}</div><div>Bye</div>" for i in range(9)]
    pages = [(f"http://h.com/p/{i}", h) for i, h in enumerate(own)] + [("http://other.com/p/1", own[0]), ("http://h.com/p/0", own[0])]
    found = texts_of(spark, pages)
    assert found[:9] == [f"Own text {i} Last words {i}" for i in range(9)]
    # Alone on its host, there is nothing to compare with.
    assert found[9] == "Welcome Own text 0 Shop now Last words 0 Bye"


def test_copies_of_an_article_are_kept(spark):
    page = "<div>Top</div><article><p>Same words</p></article>"
    assert texts_of(spark, [(f"http://h.com/{i}", page) for i in range(5)]) == ["Same words"] * 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_lines_is_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    shared = html_text.common_lines(np.array(a, np.int64), np.array(b, np.int64))
    assert shared.sum() == table[-1][-1]
    rest = iter(b)
    assert all(x in rest for x in np.array(a, np.int64)[shared].tolist())


def test_given_pages_keep_the_article(spark):
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = dict(zip([r.page_id for r in rows], texts_of(spark, [(r.url, r.html) for r in rows]), strict=True))
    import html as entities

    for r in rows:
        article = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        plain = " ".join(entities.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", article))).split())
        assert found[r.page_id] == plain
