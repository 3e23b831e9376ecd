"""Pages, archives, urls and vectors."""

import gzip
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from paritas.llm.common import Workspace
from paritas.llm.html import main_text, page_blocks
from paritas.llm.topk import _Block, top_k
from paritas.llm.url_filter import RULES, fit, host_and_path, judge, labelled_urls
from paritas.llm.warc import archive_round_trip, normalise, read_records, write_archives
from llm_samples import sentence

PAGE = "page_id bigint, url string, html string"


def page(i, host="a.example.org", article=True, end=True):
    body = f"<h1>Title {i} &amp; more</h1><p>{sentence(i, 30)}<p>Second\n  part&nbsp;{i} <b>bold<i>er</b> x &lt;3<br>y</p><ul><li>one<li>two</ul>"
    return (
        f"<!DOCTYPE html><html><head><title>T {i}</title><script>if (a<b) x('</p>')</script><style>p{{}}</style></head><body>"
        f"<header>Site name</header><nav class=x><ul><li><a href='/>'>Home {i}</a></ul></nav><div class='ad top'>Buy <p>now {i}</div>"
        f"{'<article>' if article else '<div>'}{body}{'</article>' if article else '</div>'}"
        f"<div id=sidebar>side {i}</div><form>mail <input></form><section class='comments'><article><p>comment {i}</article></section>"
        f"<!-- note <p>hidden</p> --><footer>&copy; {host} {i}</footer>" + ("</body></html>" if end else "<div cl")
    )


def want(i):
    return f"Title {i} & more\n{sentence(i, 30)}\nSecond part {i} bolder x <3 y\none\ntwo"


def test_article_text(spark):
    rows = [(i, f"http://a.example.org/{i}", page(i, end=i % 3 > 0)) for i in range(12)]
    rows += [(20, "http://lone.example.org/", page(20)), (21, None, page(21)), (22, "x", None), (23, "y", ""), (23, "y", "")]
    rows += [(24, "http://a.example.org/24", "plain < text & no markup"), (25, "http://b.example.org/", "<p>" + "long words " * 50_000)]
    df = spark.createDataFrame(rows, PAGE).withColumn("text", F.lit("own")).withColumn("host", F.lit("own")).repartition(4)
    got = main_text(df).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    by = {r["page_id"]: r for r in got}
    for i in [*range(12), 20, 21]:
        assert by[i]["text"] == want(i) and by[i]["n_chars"] == len(want(i))
    assert by[22]["text"] == by[23]["text"] == "" and by[24]["text"] == "plain < text & no markup"
    assert by[25]["n_chars"] == 550_000 - 1
    assert by[0]["n_slots"] > 5 and by[20]["n_slots"] == 0
    assert main_text(spark.createDataFrame([], PAGE)).collect() == []


def test_template_text_goes_where_no_article_is_marked(spark):
    rows = [(i, f"http://c.example.org/{i}", f"<body><div>Welcome back</div><p>{sentence(i, 25)}</p><div>Imprint</div></body>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGE).repartition(3)).collect()}
    assert got == {i: sentence(i, 25) for i in range(30)}


def test_chance_words_of_small_hosts_stay(spark):
    texts = {i: f"{sentence(i, 20)} river {sentence(i + 50, 20)} mountain {sentence(i + 90, 20)}" for i in range(4)}
    rows = [(i, "http://s.example.org/", f"<body><div>Sign up here</div><p>{t}</p><p>river {i}</p></body>") for i, t in texts.items()]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got == {i: f"{t}\nriver {i}" for i, t in texts.items()}


@pytest.mark.parametrize("html, blocks", [
    (page(3, article=False), want(3).split("\n")),
    ("<div><p>main</div><aside class=related><article>teaser</article></aside>", ["main"]),
    ("<nav><article>teaser</article></nav><p>main", ["main"]),
    ("<header><div class=ad>x<article>a</article>", ["a"]),
    ("<div class=sidebar><article>a</article></div>", ["a"]),
    ("<body class='has-sidebar ad'><div id=page class='no-sidebar'><p>a<div class=site-menu>m</div>", ["a"]),
    ("<article><h2 class='section-header'>t</h2><div class='entry-header'>e</div><p class='search-results'>r<div class='x ad'>n</div>", ["t", "e", "r"]),
    ("<h1 class='page-header'>t</h1><p class=ad>n</p>", ["t"]),
])
def test_articles_in_asides(html, blocks):
    assert page_blocks(html) == blocks


@pytest.mark.parametrize("html, blocks", [
    ("<article><p>a<nav>n</nav>b</article>", ["a", "b"]),
    ("<nav>n<article>a</article>", ["a"]),
    ("<main><p class=lead>a<p hidden>h</p><div role=dialog>d</div></main>rest", ["a"]),
    ("<article>a<textarea>t</textarea><button>b</button></article>", ["a"]),
    ("<article>a <!-- <b> --> c<![CDATA[x]]></article", ["a c"]),
    ("<article><p>5 < 6 and a<b</p>", ["5 < 6 and a"]),
    ("", []),
])
def test_blocks(html, blocks):
    assert page_blocks(html) == blocks


def warc_rows():
    big = "<p>" + "é" * 700
    rows = [(i, f"http://h/{i}", big if i % 3 == 0 else page(i)) for i in range(40)]
    return rows + [(50, "a\r\nb", "short"), (51, None, "short"), (52, "u", None), (53, "u", ""), (None, "u", big), (54, "u", "\r\n\r\n" * 400),
                   (55, "u", "\r\n\r\n" * 400), (56, "u", "x" * 3_000_000)]


def brute_warc(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            groups[h].append(-1 if i is None else i)
    out = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        top = max(groups.get(h, [-1]))
        revisit = len(raw) >= 1000 and top != (-1 if i is None else i)
        out[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    return out


def test_archives_round_trip(spark):
    rows = warc_rows()
    df = spark.createDataFrame(rows, PAGE).withColumn("payload_digest", F.lit("own")).withColumn("size", F.lit("own")).repartition(3)
    assert Counter(map(tuple, archive_round_trip(df).collect())) == brute_warc(rows)
    assert archive_round_trip(spark.createDataFrame([], PAGE)).collect() == []


def test_every_record_is_a_member_of_its_own(spark):
    work = Workspace(spark, "test-warc")
    df = spark.createDataFrame(warc_rows(), PAGE).coalesce(1)
    whole = write_archives(df, work)
    index = normalise(spark, whole, work)
    rows = index.orderBy("archive", "seq").collect()
    store, path = pafs.FileSystem.from_uri(rows[0]["archive"])
    raw = store.open_input_stream(path, compression=None).read()
    assert sum(r["length"] for r in rows if r["archive"] == rows[0]["archive"]) == len(raw)
    for r in rows:
        record = zlib.decompress(raw[r["offset"] : r["offset"] + r["length"]], 31)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    sidecar = store.open_input_stream(path + ".idx", compression=None).read().decode().splitlines()
    assert [tuple(map(int, line.split("\t")[:2])) for line in sidecar] == [(r["offset"], r["length"]) for r in rows]
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(warc_rows())
    payloads = {r["page_id"]: bytes(r["payload"]) for r in read_records(index).collect() if r["record_type"] == "response"}
    assert payloads["50"] == b"short" and len(payloads["56"]) == 3_000_000


URLS = [
    "http://www.Example.com/en/1?x", "https://example.com/en/", "http://a.example.com/en/x", "http://example.com", "ftp://b.com/p#f", "http://x.net/es/1",
    "http://net/fr/", "http://x.net/en/", "//no.scheme/x", "", None, "http:///path", "http://notcom/en/", "http://casino-bets.org/en/1",
    "http://www.library.org/en/1", "http://www.example.com/en", "http://h.org?q=://x/en/", "http://CASINO-poker.Example.net/de/9",
]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, best[0], best[1]


def test_rules_decide(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(1, URLS[1])], "page_id bigint, url string").withColumn("host", F.lit("own"))
    rows = judge(df).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule, verdict = brute_url(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    by = {r["page_id"]: r["verdict"] for r in rows}
    assert by[13] == by[17] == "block" and by[14] == "allow"
    assert judge(spark.createDataFrame([], "page_id bigint, url string")).collect() == []


def test_model_on_held_out_urls(spark):
    rows = labelled_urls(spark).withColumn("held", F.pmod(F.xxhash64("host", "path"), F.lit(4)) == 0)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    urls = rows.where("held").select(F.concat(F.lit("http://"), "host", "path").alias("url"), "verdict").collect()
    df = spark.createDataFrame([(i, r["url"]) for i, r in enumerate(urls)], "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in judge(df, rules=[], labelled=rows.where("NOT held")).collect()}
    assert np.mean([got[i] == r["verdict"] for i, r in enumerate(urls)]) > 0.95


#: Of neither word list.
UNSEEN = {
    "block": "gambling bingo wagers blackjack xxxvideos camgirls steroids painkiller counterfeit linkspam clickbait trojan spyware phisher lotto freebets",
    "allow": "astronomy biology geology poetry opera orchestra gallery bakery farming sailing chess parliament cathedral botany dictionary gazette",
}


def test_labelled_urls_copy_no_given_table(spark):
    hosts = [r["host"] for r in labelled_urls(spark).select("host").distinct().collect()]
    names = {part for h in hosts for part in h.replace("-", ".").split(".")}
    assert names.isdisjoint({"example", "blog", "m", "the", "there", "than", "thing", "nation", "their", "station"})
    assert names.isdisjoint(" ".join(UNSEEN.values()).split())


def test_without_both_verdicts_all_is_allowed(spark):
    labelled = spark.createDataFrame([("a.org", "/", "block")], "host string, path string, verdict string")
    assert fit(labelled) is None
    df = spark.createDataFrame([(1, "http://b.org/")], "page_id bigint, url string")
    assert judge(df, labelled=labelled).first()["verdict"] == "allow"


def test_rows_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "http://b.org/")], "page_id bigint, url string")
    plan = judge(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    host, _ = host_and_path(F.col("url"))
    assert df.select(host).first()[0] == "b.org"


def brute_top(rows, k=5):
    good = [(i, np.floor(np.array(v, float) * 256).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % 50 == 0:
            scores = sorted((-int(v @ q), j) for j, v in good if j != i and len(v) == len(q))[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return out


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(30)] + [(5000 + i, [1.5, -2.0, 0.0]) for i in range(3)]
    rows += [(3000, None), (3050, [None, 1.0]), (3100, [float("nan")] * 16), (3150, [float("inf")] * 16), (3200, []), (None, [1.0] * 16), (3250, [0.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("own")).repartition(3)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]  # as floats
    assert set(map(tuple, top_k(df).collect())) == brute_top(rows)
    assert top_k(df.limit(0)).collect() == []


def test_top_k_over_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (6, 24))
    rows = [(i, [float(x) for x in centre[i % 6] + rng.normal(0, 0.3, 24)]) for i in range(20_000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(2)
    got = set(map(tuple, top_k(df, every=1000).collect()))
    matrix = np.floor(np.array([v for _, v in rows]) * 256).astype(np.int64)
    for i in range(0, 20_000, 1000):
        score = matrix @ matrix[i]
        order = [j for j in np.lexsort((np.arange(20_000), -score)) if j != i][:5]
        assert {(i, r + 1, int(j), int(score[j])) for r, j in enumerate(order)} <= got
    assert len(got) == 100


def test_postings_are_read_by_segments_until_the_proof(monkeypatch):
    rng = np.random.default_rng(5)
    count, reads = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda *a, **b: reads.append(len(a[0])) or count(*a, **b))

    def segments(matrix, query):
        n, dims = matrix.shape
        order = np.argsort(-matrix, axis=0, kind="stable").T.astype(np.uint16)
        block = _Block(dims, np.arange(n).tobytes(), matrix.astype(np.int32).tobytes(), np.ascontiguousarray(order).tobytes())
        reads.clear()
        ids, score = block.best(query, -1, 5, None)
        exact = np.sort(matrix @ query)[::-1]
        assert np.sort(score)[::-1][:5].tolist() == exact[:5].tolist()
        return list(reads)

    flat = rng.integers(-200, 200, (4000, 24))
    peaked = flat.copy()
    peaked[:20] += 3000
    ones = np.full(24, 7)
    assert len(segments(flat, rng.integers(1, 200, 24))) > 1
    first, *more = segments(peaked, ones)
    assert not more and first < 0.25 * peaked.size
