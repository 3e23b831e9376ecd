"""URL filters: longest matching rule, else logistic regression on hashed character n-grams of host and path.

Everything is DataFrame functions and Spark's own DataFrame-based regression, so
rows never leave the JVM.  The model is fitted on a small labelled URL table and
has ``BUCKETS`` coefficients.  Unless a table is given, it is that of well-known
hosts below, each with its front page and some paths: advertising, tracking,
betting and adult sites, and names as short-lived spam sites bear them, against
reference works, papers, schools and public bodies.

Defined cases: null urls and urls without ``://`` have an empty host and path;
the model judges them by what it knows of empty text.  Rows with a null id and
repeated rows are judged each; a table without rows gives none.  Of fitting rules
of equal length the first in code-point order wins.
Without labels of both verdicts, everything undecided is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm.common import LOWER, UPPER, Workspace

#: Rules of the contract: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
GRAM = 3
BUCKETS = 1 << 17

# Labelled hosts with some of their paths, one host a line.
UNWANTED = """
ad.doubleclick.net /ddm/trackclk/N7921 /pagead/viewthroughconversion/9912
pagead2.googlesyndication.com /pagead/js/adsbygoogle.js /pagead/gen_204
ib.adnxs.com /getuid /seg /click
trc.taboola.com /sponsored/log/3/click /libtrc/unip/loader.js
widgets.outbrain.com /outbrain.js /paid/redir
dis.criteo.com /dis/rtb/usersync.aspx /delivery/ck.php
b.scorecardresearch.com /beacon.js /p
pixel.quantserve.com /pixel/p-3aud4J6uA4Z6Y.gif /api/segments.json
serve.popads.net /cpop.js /click
syndication.exoclick.com /ads-iframe-display.php /splash.php /popunder.js
adserver.juicyads.com /adshow.php /js/jads.js
ads.trafficjunky.net /ads /banner/300x250
track.adform.net /adfscript /serving/cookie/match
static.hotjar.com /c/hotjar-90210.js /events
stats.g.doubleclick.net /dc.js /r/collect
cdn.mgid.com /widget/loader.js /ghits/click
go.clickbank.net /hop/affiliate.php /redirect/offer
www.shareasale.com /r.cfm /banner.cfm
click.linksynergy.com /fs-bin/click /fs-bin/show
www.awin1.com /cread.php /cshow.php
tags.bluekai.com /site/2981 /sync
sync.mathtag.com /sync/img /notify/js
www.888casino.com /promotions/welcome-bonus /slots/jackpot /free-spins
www.bet365.com /sports/odds /promo/bonus-bets
www.pokerstars.com /poker/promotions/bonus /poker/free/
www.betway.com /casino/slots /bonus/free-bet
www.partypoker.com /promo/deposit-bonus /download
www.unibet.com /betting/odds /casino/jackpots
www.casino.com /slots/free /roulette/live /bonus
online.casinocity.com /top/bonus-codes /slots/real-money
www.bovada.lv /sports/betting /casino/bonus
www.slotomania.com /free-coins /slots/vegas
www.ladbrokes.com /promotions/free-bets /lottery/win
www.pornhub.com /view_video.php /pornstars /categories/xxx
www.xvideos.com /video/amateur-xxx /tags/porn /best
www.xnxx.com /search/sexy /video/hot-girls
xhamster.com /videos/porn-milf /pornstars
chaturbate.com /female-cams/ /tipping/free_tokens
www.livejasmin.com /girls/sex /free/adult-chat
www.adultfriendfinder.com /p/register.cgi /go/sex-dating
www.canadian-pharmacy-rx.com /buy-viagra-online /cheap/cialis-20mg
www.buycheappills.net /order/viagra /no-prescription/pills
www.rxmeds-discount.biz /products/cialis-generic /order-now
www.cash-payday-loans.com /apply-now /bad-credit/instant-approval
www.replicawatches.biz /cheap-rolex /buy/replica-handbags
www.seobacklinks.biz /buy-links /packages/cheap-traffic
www.freeprizewinner.info /claim/iphone /win/gift-card
www.diet-miracle-pills.info /lose-weight-fast /order/free-trial
thepiratebay.org /torrent/9912/crack-keygen /top/201
www.crackserialkeygen.info /download/serial-key /crack/full-version
""".strip().splitlines()
ORDINARY = """
en.wikipedia.org /wiki/Photosynthesis /wiki/History_of_Portugal /wiki/Graph_theory
www.nytimes.com /2019/07/14/science/ocean-warming.html /section/books
www.bbc.co.uk /news/science-environment-48964736 /weather/2643743
arxiv.org /abs/1706.03762 /list/math.CO/recent
github.com /apache/spark /torvalds/linux/issues/21
stackoverflow.com /questions/11227809/why-is-a-sorted-array-faster /tags/python
www.nature.com /articles/s41586-019-1666-5 /subjects/ecology
www.gutenberg.org /ebooks/1342 /files/84/84-h.htm
www.loc.gov /collections/maps /item/2004661940/
openlibrary.org /works/OL45804W /authors/OL26320A
www.mit.edu /education/ /research/physics
www.stanford.edu /academics/ /about/history
www.cam.ac.uk /research/news/ancient-dna /students
ocw.mit.edu /courses/mathematics/18-06-linear-algebra /courses/18-01
www.nasa.gov /missions/hubble/ /image-feature/earth-at-night
www.who.int /news-room/fact-sheets/detail/malaria /publications/i/item/9789240015
www.nhs.uk /conditions/asthma/ /live-well/exercise
www.cdc.gov /flu/about/index.html /nutrition/data
www.un.org /en/about-us/history-of-the-un /sustainabledevelopment/water
ec.europa.eu /environment/nature/index_en.htm /eurostat/statistics-explained
www.congress.gov /bill/116th-congress/house-bill/1 /committees
www.smithsonianmag.com /history/the-silk-road-180 /arts-culture/museum-day
www.nationalgeographic.com /animals/mammals/facts/red-fox /travel/article/iceland
www.metmuseum.org /art/collection/search/436535 /toah/works-of-art
www.britishmuseum.org /collection/object/Y_EA24 /visit/family-visits
www.allrecipes.com /recipe/10813/best-chocolate-chip-cookies /recipes/bread
www.bbcgoodfood.com /recipes/vegetable-lasagne /howto/guide/cook-rice
www.gardenersworld.com /how-to/grow-plants/tomatoes /plants/lavender
www.rhs.org.uk /plants/roses/growing-guide /garden-inspiration
www.lonelyplanet.com /italy/rome/attractions /articles/best-hikes-in-peru
www.weather.gov /forecast/points /education/clouds
www.theatlantic.com /magazine/archive/1945/07/as-we-may-think /ideas
www.newyorker.com /magazine/2016/05/09/essay /books/page-turner
www.economist.com /finance-and-economics/2019/08/15/trade /books-and-arts
www.reuters.com /article/us-climate-report /world/europe
www.npr.org /2018/11/02/663/music-interview /sections/science
www.pbs.org /newshour/science/volcano-study /wgbh/nova/article
docs.python.org /3/library/itertools.html /3/tutorial/classes.html
developer.mozilla.org /en-US/docs/Web/HTML/Element /docs/Learn/CSS
www.postgresql.org /docs/current/indexes-types.html /about/news
kernel.org /doc/html/latest/filesystems /releases.html
www.w3.org /TR/html52/ /standards/about
www.ietf.org /rfc/rfc2616.txt /about/participate
www.jstor.org /stable/2118477 /journal/amereconrevi
www.sciencedirect.com /science/article/pii/S0092867418 /journal/cell
www.librarything.com /work/1386 /author/austenjane
www.goodreads.com /book/show/1885.Pride_and_Prejudice /review/list
www.uefa.com /news/match-report /teams/history
www.cyclingnews.com /news/stage-report /features/training-guide
imslp.org /wiki/Piano_Sonata_No.14 /composers
www.swissinfo.ch /fre/culture/44837120 /en/politics/45129.html
www.dw.com /en/forests-in-europe/a-49102 /de/themen/s-9077
www.france24.com /fr/20190714-paris /en/culture/
europeana.eu /en/item/9200365 /fr/collections
www.deutschlandfunk.de /archiv/2310.html /wissen/geschichte-100.html
www.elpais.com /cultura/2018/03/21.html /ciencia/
cordis.europa.eu /project/id/5210 /article/id/4112
www.helsinki.fi /en/news/climate /fi/tutkimus
www.ethz.ch /en/studies/7731.html /de/forschung
tatoeba.org /en/sentences/show/1277 /eng/about
""".strip().splitlines()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def match_rules(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits columns ``host`` and ``path``; a bounded list of rules."""
    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """The character 3-grams of host and path, marked at the ends and where they meet."""
    text = F.concat(F.lit("^"), host, F.lit(" "), path, F.lit("$"))
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    return F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM)))


def _hashed(urls: DataFrame) -> DataFrame:
    counted = urls.withColumn("grams", grams(F.col("host"), F.col("path")))
    return HashingTF(numFeatures=BUCKETS, inputCol="grams", outputCol="features").transform(counted).drop("grams")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``host, path, verdict``: every host above with its front page and its listed paths."""
    lines = spark.range(0, 1, 1, 1).select(
        F.explode(F.map_from_arrays(
            F.array(F.lit("block"), F.lit("allow")), F.array(*[F.split(F.lit("\n".join(t)), "\n") for t in (UNWANTED, ORDINARY)])
        )).alias("verdict", "lines")
    )
    parts = lines.select("verdict", F.explode("lines").alias("line")).select("verdict", F.split("line", " ").alias("parts"))
    paths = F.concat(F.array(F.lit("/")), F.slice("parts", F.lit(2), F.size("parts")))
    return parts.select(F.col("parts")[0].alias("host"), F.explode(paths).alias("path"), "verdict")


def fit(labelled: DataFrame) -> LogisticRegressionModel | None:
    """The model of P(block), or None where only one verdict is known."""
    work = Workspace(labelled.sparkSession, "url-filter")
    rows = work.write(labelled.select("host", "path", (F.col("verdict") == "block").cast("double").alias("label")), "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    learner = LogisticRegression(maxIter=40, regParam=0.1, featuresCol="features", labelCol="label")
    return learner.fit(_hashed(rows))


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None,
) -> DataFrame:
    """Per row of ``pages``: id, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = match_rules(rules)
    urls = urls.withColumn("rule", rule).withColumn("ruled", verdict)
    if model is None:
        guess = F.lit("allow")
    else:
        urls = model.transform(_hashed(urls))
        guess = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return urls.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"))
