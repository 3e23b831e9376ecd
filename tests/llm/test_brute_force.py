"""The mix and the quality sample against second implementations in plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import WORDS, sentence
from paritas.llm import quality
from paritas.llm.mixing import LIMIT, SHARE, WEIGHTS, _uniform, mix, mixed
from paritas.llm.quality import BUCKETS, EXCERPT, quality_sample
from paritas.llm.shingles import mix as mixed_bits
from paritas.llm.shingles import word_hashes
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, source string"


def draws(spark, seed, ids):
    df = spark.createDataFrame([(i,) for i in set(ids)], "id bigint")
    return {r[0]: r[1] for r in df.select("id", _uniform(seed, F.col("id"))).collect()}


def brute_targets(sizes):
    """Fill up by weight, stop whoever is above the limit, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    stopped, left = set(), SHARE * sum(sizes.values())
    while True:
        free = [s for s in order if s not in stopped]
        room = left - sum(LIMIT * sizes[s] for s in stopped)
        target = {s: room * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if target[s] >= LIMIT * sizes[s]]
        if not above:
            return {**target, **{s: float(LIMIT * sizes[s]) for s in stopped}}
        stopped.update(above)


def brute_mix(spark, rows):
    """Counter of ``(id, size, taken)``."""
    size = [len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in rows]
    u = draws(spark, 1, [r[0] for r in rows])
    by = defaultdict(list)
    for at, r in enumerate(rows):
        by[r[2]].append(at)
    target = brute_targets({s: sum(size[i] for i in ats) for s, ats in by.items()})
    taken = Counter()
    for source, ats in by.items():
        total = sum(size[i] for i in ats)
        expected = min(target[source] / total, LIMIT) if total else 0.0
        certain = math.floor(expected)
        p = expected - certain
        chosen = set()
        if p > 0:
            odds = lambda i: (u[rows[i][0]] / (1 - u[rows[i][0]])) / (p / (1 - p))
            ranked = sorted((i for i in ats if size[i]), key=lambda i: (odds(i), rows[i][0] is None, rows[i][0] or 0, size[i]))
            space = target[source] - certain * total
            for i in ranked:
                if size[i] <= space:
                    chosen.add(i)
                    space -= size[i]
            out = [i for i in ranked if i not in chosen]
            if out and space > 0:
                extra = min(out, key=lambda i: (size[i], ranked.index(i)))
                over, leave = size[extra] - space, set()
                for i in reversed(ranked):
                    if i in chosen and size[i] <= over:
                        leave.add(i)
                        over -= size[i]
                if over < space:
                    chosen = chosen - leave | {extra}
        for i in ats:
            taken[(rows[i][0], size[i], size[i] * (certain + (i in chosen)))] += 1
    return taken, target


@pytest.mark.parametrize("seed", range(3))
def test_the_draw_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(rng.pareto(1.1, 300) * 12, 3000).astype(int)
    rows = [(i, sentence(i, int(n)), ["a", "b", "c", None, "é"][int(rng.integers(5)) % (3 + seed)]) for i, n in enumerate(sizes)]
    rows += [(900, None, "a"), (901, " \n", "b"), (None, "no id here", "c"), (5, "same id as another", "a")]
    want, target = brute_mix(spark, rows)
    found = mix(spark.createDataFrame(rows, DOCS).repartition(6)).select("doc_id", "size", "taken", "target").collect()
    assert Counter((r[0], r[1], r[2]) for r in found) == want
    assert {round(r[3], 6) for r in found} == {round(t, 6) for t in target.values()}


def brute_quality(spark, rows, labels):
    """Per row ``(n_grams, score, key)``, and the cut."""
    known = {}
    for i, q, _ in labels:
        if i is not None and q in (0, 1):
            known[i] = min(q, known.get(i, 1))
    hashed = {}

    def of(token):
        if token not in hashed:
            hashed[token] = int(word_hashes(np.frombuffer(token, np.uint8), np.array([0, len(token)]), quality._kinds())[0][0])
        return hashed[token]

    same = int(mixed_bits(np.array([1], np.uint64))[0])
    grams = []
    for _, text, *_ in rows:
        own = [of(t.lower()) for t in re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\t-\r ]+", (text or "").encode())]
        pairs = [same if a == b else int(mixed_bits(np.array([(a * 0xD6E8FEB86659FD93 + b) % 2**64], np.uint64))[0]) for a, b in zip(own, own[1:])]
        grams.append([h >> 48 for h in own + pairs])
    raw, good = Counter(g for row in grams for g in row), Counter(g for r, row in zip(rows, grams) for g in row if known.get(r[0]) == 1)
    n_raw, n_good = BUCKETS + sum(raw.values()), BUCKETS + sum(good.values())
    ratio = lambda g: math.log((1 + good[g]) / n_good) - math.log((1 + raw[g]) / n_raw)
    score = [sum(map(ratio, row)) / len(row) if row else 0.0 for row in grams]
    u = draws(spark, 9, [r[0] for r in rows])
    key = [math.floor((s * EXCERPT - math.log(-math.log(u[r[0]]))) * (1 << 16)) + (1 << 47) for r, s in zip(rows, score)]

    # The threshold: of all steps the one that tells most labelled rows apart.
    placed = [(math.floor(s * 512), known[r[0]]) for r, s in zip(rows, score) if r[0] in known]
    n = Counter(q for _, q in placed)
    bins = sorted({b for b, _ in placed})
    gain = {t: sum(n[1 - q] for b, q in placed if (b >= t) == (q == 1)) for t in range(bins[0], bins[-1] + 2)}
    first = min(t for t, g in gain.items() if g == max(gain.values()))
    last = min([b for b in bins if b >= first] or [bins[-1] + 1])
    k = sum(s >= (first + last) / 2 / 512 for s in score)
    return [(len(g), s, x) for g, s, x in zip(grams, score, key)], sorted(key, reverse=True)[k - 1] if k else math.inf


def test_the_sample_equals_brute_force(spark, odd_rows):
    rng = np.random.default_rng(5)
    rows = [(1000 + i, " ".join(rng.choice(WORDS if i % 3 else ["Buy", "NOW!!!", "cheap", "$$$", "gamma", "buy"], 5 + i % 60)), "x") for i in range(240)]
    rows += [(r[0], r[1], r[3]) for r in odd_rows]
    labels = [(1000 + i, int(i % 3 > 0) if i % 11 else 1 - int(i % 3 > 0), 0) for i in range(0, 240, 2)]
    labels += [(7, 1, 0), (7, 0, 0), (300, 0, 0), (None, 1, 0), (3, None, 1), (4, 5, 0)]
    want, cut = brute_quality(spark, rows, labels)
    docs = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("own")).repartition(5)
    found = quality_sample(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    found = sorted(((r["doc_id"], r["n_grams"], r["score"], r["sampling_key"], r["kept"]) for r in found), key=order)
    want = sorted(((r[0], n, s, x, x >= cut) for r, (n, s, x) in zip(rows, want)), key=order)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert [f[2] for f in found] == pytest.approx([w[2] for w in want], abs=1e-9)
    assert all(abs(f[3] - w[3]) <= 1 for f, w in zip(found, want))
    assert [f[4] for f in found] == [w[4] for w in want] and 0 < sum(f[4] for f in found) < len(found)


def test_pipeline_stages_of_empty_and_odd_tables(spark, odd, empty, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([(0, 1, 0), (300, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in pipeline.STAGES:
        nothing = stage(spark, empty, str(tmp_path))
        assert nothing.collect() == [], name
        kept = stage(spark, odd, str(tmp_path))
        assert kept.columns == (odd.columns if name != "bpe" else kept.columns) == (nothing.columns if name == "bpe" else empty.columns)
        assert kept.count() > 0, name
    assert mixed(empty).collect() == []
