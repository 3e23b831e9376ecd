"""The registered query of each operator: the whole intended table in, the full result out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paritas.llm.bpe import round_trip
from paritas.llm.common import LOWER, UPPER, table
from paritas.llm.exact_dedup import exact_duplicates
from paritas.llm.html import main_text
from paritas.llm.line_dedup import drop_repeated_windows
from paritas.llm.mixing import mix
from paritas.llm.near_dup import near_duplicates
from paritas.llm.quality import quality_sample
from paritas.llm.secret_scan import secret_digests
from paritas.llm.spelling import document_variants
from paritas.llm.topk import top_k
from paritas.llm.url_filter import judge
from paritas.llm.warc import archive_round_trip
from paritas.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@register
def op8_block_naming_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


ORACLES["op8_block_naming_exact_dedup"] = f"""
WITH normal AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM normal JOIN groups USING (body)
"""


@register
def op5_pareto_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


@register
def op9_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return quality_sample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"))


@register
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"))


@register
def op3_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages"))


ORACLES["op3_warc_members"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < largest THEN largest END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@register
def op2_template_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


@register
def op6_impact_ordered_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


ORACLES["op6_impact_ordered_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@register
def op7_three_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_windows(table(spark, folder, "documents"))


ORACLES["op7_three_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p : p + 2] AS window_lines FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d)),
o AS (SELECT doc_id, p, first_value(doc_id) OVER same AS first_doc, first_value(p) OVER same AS first_p, row_number() OVER same AS nth
      FROM w WINDOW same AS (PARTITION BY window_lines ORDER BY doc_id, p)),
gone AS (SELECT DISTINCT doc_id, line FROM (SELECT *, unnest([p, p + 1, p + 2]) AS line FROM o WHERE nth > 1)
         WHERE NOT (doc_id = first_doc AND line BETWEEN first_p AND first_p + 2)),
lines AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS line FROM d)
SELECT doc_id, count(*) AS n_lines, count(gone.line) AS n_removed,
       coalesce(string_agg(l[line], chr(10) ORDER BY line) FILTER (gone.line IS NULL), '') AS text
FROM lines LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id
"""


@register
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return document_variants(table(spark, folder, "documents"))


# Near words meet by what is left of them without one letter; crc32 byte by byte through its table.
ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)),
runs AS (SELECT doc_id, run, count(*) AS n
         FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
         GROUP BY ALL),
points AS (SELECT run, n, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CAST(unicode(c) AS BIGINT)) AS p FROM runs),
summed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(p, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 | (c >> 6), 128 | (c & 63)] END))),
                  lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS h FROM points, crc),
kept AS (SELECT CASE WHEN h % 97 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM kept GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
rests AS (SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS word, a.n AS n, b.word AS near, b.n AS m FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word),
near AS (SELECT word, n, count(*) AS n_near, first(near ORDER BY m DESC, encode(near)) AS best, max(m) AS best_n FROM pairs GROUP BY word, n),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
           FROM words w LEFT JOIN near USING (word)),
led AS (SELECT word, word AS at, form AS next FROM formed
        UNION ALL SELECT led.word, f.word, f.form FROM led JOIN formed f ON led.next = f.word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, led.at AS root FROM formed f JOIN led USING (word) WHERE led.next IS NULL
"""


@register
def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(table(spark, folder, "documents"))


@register
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
