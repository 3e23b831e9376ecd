"""Template deduction against brute force, at any partitioning, on hostile pages."""

import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_samples import sentence
from paritas.llm.common import Workspace
from paritas.llm.html import _class_spans, _least_words, _page_tokens, frequent_tokens, main_text, occurrences, templates
from paritas.llm.markup import page_blocks, tags

PAGE = "page_id bigint, url string, html string"


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGE).repartition(3)).collect()}


def test_a_line_on_every_page_goes_inside_the_article_too(spark):
    share = "<div>Share this story with your friends today</div>"
    page = lambda i: f"<body><article><h1>Same title</h1><p>{sentence(i, 30)}</p>{share}<ul><li>one</li><li>two</li></ul></article></body>"
    got = texts(spark, [(i, "http://m.example.org/", page(i)) for i in range(40)])
    assert got == {i: f"Same title\n{sentence(i, 30)}\none\ntwo" for i in range(40)}


def test_a_block_that_is_mostly_template_goes_whole(spark):
    page = lambda i: f"<body><div>Read more about story {i} here</div><p>{sentence(i, 25)}</p></body>"
    got = texts(spark, [(i, "http://n.example.org/", page(i)) for i in range(40)])
    assert got == {i: sentence(i, 25) for i in range(40)}


def test_copies_of_a_page_are_one_page(spark):
    html = f"<body><div>Welcome</div><p>{sentence(1, 25)}</p></body>"
    got = texts(spark, [(i, "http://o.example.org/", html) for i in range(50)] + [(99, "http://p.example.org/", html)])
    assert set(got.values()) == {f"Welcome\n{sentence(1, 25)}"}  # nothing is shared with another page


def test_the_threshold_is_smooth():
    pages = np.arange(2, 400)
    for edges in range(3):
        least = _least_words(np.full(len(pages), edges), pages)
        drop = -np.diff(least)
        assert (drop > 0).all() and (np.diff(drop) < 0).all()
    assert _least_words(np.array([2]), np.array([1]))[0] > 1e9


def host_pages():
    nav = lambda h: f"<nav><a href=/{h}>Home of {h}</a></nav>"
    for i in range(400):
        h = "hot" if i % 3 else f"h{i % 7}"
        extra = "<div>On half of the pages</div>" if i % 2 else ""
        yield i, f"http://{h}.example.org/{i}", f"<body>{nav(h)}<h1>{sentence(i, 4)}</h1>{extra}<p>{sentence(i + 9, 20)}</p><footer>End of {h}</footer></body>"


def frequent_by_hand():
    """Tokens on half of a host's pages and on two, grouped by occurrence vector."""
    on, pages, vectors = defaultdict(Counter), Counter(), defaultdict(dict)
    for i, url, html in host_pages():
        host = url.split("/")[2]
        pages[host] += 1
        data = np.frombuffer(html.encode(), np.uint8)
        for _, _, _, token, *_ in _page_tokens(data, np.array([0, len(data)])):
            for t, n in Counter(token.view(np.int64).tolist()).items():
                on[host][t] += 1
                vectors[host, t][i] = n
    kept = {(h, t): n for h, c in on.items() for t, n in c.items() if n >= 2 and 2 * n >= pages[h]}
    classes = defaultdict(set)
    for h, t in kept:
        classes[h, tuple(sorted(vectors[h, t].items()))].add(t)
    return kept, Counter((h, frozenset(c)) for (h, _), c in classes.items())


@pytest.mark.parametrize("partitions, run_bytes", [(1, 8 << 20), (97, 8 << 20), (5, 3000), (3, 1)])
def test_frequent_tokens_and_classes_equal_brute_force_at_any_partitioning(spark, partitions, run_bytes):
    df = spark.createDataFrame(list(host_pages()), PAGE).repartition(partitions)
    keyed = df.select(F.regexp_extract("url", "//([^/]+)", 1).alias("host"), F.xxhash64("html").alias("page"), "html")
    keyed = keyed.unionByName(keyed.limit(30))  # copies count once
    work = Workspace(spark, "test-html")
    found = frequent_tokens(occurrences(keyed, work, run_bytes), work).collect()
    kept, classes = frequent_by_hand()
    assert {(r["host"], r["token"]): r["pages"] for r in found} == kept
    groups = defaultdict(set)
    for r in found:
        groups[r["host"], r["grp"]].add(r["token"])
    assert Counter((h, frozenset(c)) for (h, _), c in groups.items()) == classes
    assert templates(keyed, Workspace(spark, "test-html"), run_bytes).count() == 8


def straddles_by_hand(at, tokens, group):
    out = {}
    for g in set(group):
        mine = [(a, t) for a, t, h in zip(at, tokens, group) if h == g]
        single = len({t for _, t in mine}) == len(mine)
        first, last = mine[0][0], mine[-1][0]
        bad = False
        for h in set(group) - {g}:
            other = [(a, t) for a, t, k in zip(at, tokens, group) if k == h]
            if single and len({t for _, t in other}) == len(other) and len(other) > len(mine):
                bad |= any(first < a < last for a, _ in other)
        out[g] = bad
    return out


@pytest.mark.parametrize("seed", range(20))
def test_nesting_equals_a_comparison_of_all_classes(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 60))
    group = rng.integers(0, max(2, n // 5), n)
    tokens = group * 1000 + rng.integers(0, 40, n)
    at = np.sort(rng.choice(500, n, replace=False))
    found = {g: bad for g, _, bad in _class_spans(at, tokens, group)}
    assert found == straddles_by_hand(at.tolist(), tokens.tolist(), group.tolist())


TAG = re.compile(rb"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|=\s*"[^"]*"|=\s*'[^']*')*)>""", re.S)


def test_tags_of_well_formed_pages_equal_a_regular_expression():
    page = b"""<!DOCTYPE html><!-- a <p> b --><div class="x>y" id='z'><P>a &lt; b<br/>c</P><a href='/"q"'>t</a><IMG alt="it's"></div><x-y>u</x-y>"""
    found = tags(np.frombuffer(page, np.uint8), np.array([0, len(page)]))[0]
    assert [(a, b, c) for a, b, _, c in found] == [(m.start(), m.end(), m.group(1) == b"/") for m in TAG.finditer(page)]


@pytest.mark.parametrize("html, blocks", [
    ("<p>a<script>if (a<b) x('</p>')</script>b</p>", ["ab"]),
    ("<p>a</p><style>x", ["a"]),
    ("<p title=don't>a</p><p title=\"b>c\">d</p>", ["a", "d"]),
    ("<p title=\"open>a</p><p>b</p>", ["a", "b"]),
    ("<p>a<script>x</scripts></script>b", ["ab"]),
    ("a <!-- > b --> c <!> d", ["a c d"]),
])
def test_odd_markup(html, blocks):
    assert page_blocks(html) == blocks


@pytest.mark.parametrize("piece", ['<a "', "<a b", '<a x="', "<article>t</article>", "<div>", "</x>", "<script>", "<!--", "<nav><article>", "<p class='ad"])
def test_time_is_linear_in_hostile_pages(piece):
    page = "<nav>" + piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    page_blocks(page)
    assert time.perf_counter() - start < 2
