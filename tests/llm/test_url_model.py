"""The URL model on hosts it has not seen, and against a second implementation."""

import numpy as np
from paritas.llm.url_filter import ORDINARY, UNWANTED, host_and_path, judge
from pyspark.sql import functions as F

# Labelled urls of hosts the library's table does not hold.
HELD_OUT = {
    "block": """
http://eus.rubiconproject.com/usync.html
https://ads.pubmatic.com/AdServer/js/user_sync.html
http://d.adroll.com/pixel/ABC/fire.js
https://c.amazon-adsystem.com/aax2/apstag.js
https://bid.openx.net/json?c=banner
https://secure.flashtalking.com/click/2/91
http://creative.propellerads.com/banner/728x90
http://www.adcash.com/script/pop_packcpm.php
https://tracker.kissmetrics.io/track/click
http://cpm.revcontent.com/serve/ad.js.php
https://www.pokies-vegas.net/free-spins/bonus
https://www.williamhill.com/betting/promotions/free-bet
https://www.leovegas.com/slots/jackpots
https://www.mrgreen.com/casino/bonus-spins
https://www.draftkings.com/promo/deposit-bonus
https://www.bwin.com/sports/odds
http://www.redtube.com/pornstar/xxx
http://www.youjizz.com/videos/amateur-sex.html
http://www.camsoda.com/girls/nude
http://www.stripchat.com/free/sex-cams
http://www.eurodrugstore.biz/buy/viagra-generic
http://www.kamagra-shop.biz/order/cheap-tablets
http://www.fast-lend-today.biz/apply/instant-cash
http://www.fakebags-outlet.biz/cheap/louis-vuitton
http://www.rank-boost-traffic.info/buy/backlinks
http://www.lucky-gift4u.info/claim/free-iphone
http://www.slim-keto-gummies.biz/order/trial
http://www.1337x.to/torrent/crack
http://www.warez-bb.org/download/keygen
http://www.nulled-scripts.biz/download/cracked
""".split(),
    "allow": """
https://www.britannica.com/science/geology
https://www.theguardian.com/environment/2019/mar/02/forests
https://www.washingtonpost.com/world/2018/05/09/election-results
https://iep.utm.edu/kant-moral/
https://www.harvard.edu/programs/
https://www.ox.ac.uk/research/astronomy
https://www.esa.int/Science_Exploration/Space_Science/Rosetta
https://www.usgs.gov/volcanoes/mount-st-helens
https://www.mayoclinic.org/diseases/migraine/symptoms
https://pubmed.ncbi.nlm.nih.gov/29899019/
https://www.tate.org.uk/art/artists/turner
https://www.louvre.fr/en/explore/the-palace
https://www.seriouseats.com/recipes/2015/12/roast-potatoes.html
https://www.kingarthurbaking.com/recipes/sourdough-loaf
https://www.kew.org/plants/oak
https://www.ricksteves.com/europe/spain/seville
https://www.metoffice.gov.uk/weather/learn-about/rainbows
https://apnews.com/article/oceans-coral-reefs
https://www.lemonde.fr/sciences/article/2020/01/fossile.html
https://docs.oracle.com/javase/tutorial/collections/
https://doc.rust-lang.org/book/ch04-01-ownership.html
https://www.sqlite.org/lang_select.html
https://www.debian.org/releases/stable/
https://www.acm.org/publications/magazine
https://link.springer.com/chapter/10.1007/978-3-319
https://academic.oup.com/journals/pages/history
https://www.poets.org/poem/stopping-woods
https://www.oeis.org/wiki/Fibonacci
https://www.fifa.com/teams/brazil
https://www.chess.com/article/view/openings
""".split(),
}


def rows_of(spark):
    rows = [(i, u, v) for v, urls in HELD_OUT.items() for i, u in enumerate(urls, 100 * (v == "allow"))]
    return spark.createDataFrame(rows, "page_id bigint, url string, truth string"), rows


def parts(url):
    host, _, path = url.split("://")[1].partition("/")
    return host, "/" + path.split("?")[0]


def test_both_verdicts_on_held_out_hosts(spark):
    known = {part for line in [*UNWANTED, *ORDINARY] for part in line.split(" ")[0].replace("-", ".").split(".")[:-1]}
    usual = {"www", "ads", "gov", "docs", "ac", "co", "org"}  # parts that say what kind of host it is, not which
    for urls in HELD_OUT.values():
        for url in urls:
            assert not known & set(parts(url)[0].replace("-", ".").split(".")[:-1]) - usual, url
    df, rows = rows_of(spark)
    got = {r["page_id"]: r["verdict"] for r in judge(df, rules=[]).collect()}
    for verdict in HELD_OUT:
        mine = [got[i] == v for i, _, v in rows if v == verdict]
        assert np.mean(mine) > 0.8, verdict


def counts_of(pairs, places=None):
    """Counts of 3-grams, a column each, of ``(host, path)``; given columns leave out other 3-grams."""
    grams = [[t[i : i + 3] for i in range(len(t) - 2)] for t in (f"^{h} {p}$" for h, p in pairs)]
    places = places or {g: i for i, g in enumerate(sorted({g for row in grams for g in row}))}
    x = np.zeros((len(grams), len(places)))
    for i, row in enumerate(grams):
        for g in row:
            if g in places:
                x[i, places[g]] += 1
    return x, places


def test_verdicts_equal_a_regression_without_hashing(spark):
    table = [(line.split(" ")[0], p, y) for y, lines in ((1, UNWANTED), (0, ORDINARY)) for line in lines for p in ["/", *line.split(" ")[1:]]]
    x, places = counts_of([t[:2] for t in table])
    y = np.array([t[2] for t in table], float)
    scale = x.std(axis=0, ddof=1)
    scale[scale == 0] = np.inf
    z = x / scale
    # Newton's steps on sums over rows: the weights are z' a, the constant is free.
    kernel, a, b = z @ z.T, np.zeros(len(y)), 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(kernel @ a + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        target = kernel @ a + b + (y - p) / w
        system = np.block([[kernel + 0.1 * len(y) * np.diag(1 / w), np.ones((len(y), 1))], [np.ones((1, len(y))), np.zeros((1, 1))]])
        solved = np.linalg.solve(system, np.append(target, 0))
        a, b = solved[:-1], solved[-1]
    df, rows = rows_of(spark)
    held, _ = counts_of([parts(u) for _, u, _ in rows], places)
    score = (held / scale) @ (z.T @ a) + b
    got = {r["page_id"]: r["verdict"] for r in judge(df, rules=[]).collect()}
    clear = 0
    for s, (i, url, _) in zip(score, rows):
        if abs(s) > 0.3:  # a few 3-grams share a bucket
            clear += 1
            assert got[i] == ("block" if s > 0 else "allow"), (url, s)
    assert clear > 0.8 * len(rows)


def test_parts_of_held_out_urls(spark):
    df, rows = rows_of(spark)
    host, path = host_and_path(F.col("url"))
    assert {r[0]: (r[1], r[2]) for r in df.select("page_id", host, path).collect()} == {i: parts(u) for i, u, _ in rows}
