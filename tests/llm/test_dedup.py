"""Exact and near duplicates against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import changed, sentence

from paritas.llm.components import components
from paritas.llm.common import Workspace
from paritas.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from paritas.llm.near_dup import COORDINATES, drop_near_duplicates, near_duplicates, signature
from paritas.llm.shingles import shingle_sets

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fold(text):
    return (text or "").encode().translate(LOWER)


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", fold(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near(rows):
    """Component of each row by comparing every pair."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return Counter((r[0], len(sets[i]), least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


def test_near_duplicates_equal_brute_force(odd, odd_rows):
    got = near_duplicates(odd).collect()
    assert Counter(tuple(r) for r in got) == brute_near(odd_rows)


def test_near_duplicates_in_a_large_group(spark):
    """Variants of one text whose links form chains, beside texts that share a long passage."""
    base, passage = sentence(1, 150), sentence(2, 70)
    rows = [(i, changed(base, 40 + i % 9, i)) for i in range(150)]
    rows += [(1000 + i, passage + " " + sentence(500 + i, 30 + i % 20)) for i in range(150)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter(tuple(r) for r in got) == brute_near(rows)


def test_near_duplicates_of_nothing(empty):
    assert near_duplicates(empty).collect() == []
    assert drop_near_duplicates(empty).columns == empty.columns


def test_one_of_each_group_stays(clashing, odd_rows):
    kept = drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    groups = {c for (_, n, c, _) in brute_near(odd_rows) if n}
    assert len([r for r in rows if shingles(r["text"])]) == len(groups)
    assert {r["doc_id"] for r in rows} >= {300, 301, 302}


def test_signature_is_the_least_value_under_each_shift():
    from paritas.llm import near_dup

    shingle = next(shingle_sets(pa.array([sentence(3, 40)])))
    scatter, _ = near_dup._permutations()
    values = np.random.default_rng(20240101)
    values.permutation(near_dup.POSITIONS)
    values = values.permutation(near_dup.POSITIONS)
    at = scatter[(shingle >> np.uint64(44)).astype(np.int64)].astype(np.int64)
    want = [values[(at + k) % near_dup.POSITIONS].min() for k in range(COORDINATES)]
    assert signature(shingle).tolist() == want


def test_shingles_count_like_words():
    texts = [None, "", "a b c d", "a b c d e", "A b\tc\x0bd  e f", "x " * 400_000, "é é b c d e f", sentence(9, 300_000)]
    sizes = [len(s) for s in shingle_sets(pa.array(texts))]
    assert sizes == [len(shingles(t)) for t in texts]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101)], "u bigint, v bigint")
    found = {r[0]: r[1] for r in components(edges, Workspace(spark, "chain"), "c").collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[fold(r[1])].append(r[0])
    out = Counter()
    for r in rows:
        ids = groups[fold(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        out[(r[0], keep, len(ids), r[0] == keep, hashlib.sha256(fold(r[1])).hexdigest())] += 1
    return out


def test_exact_duplicates_equal_brute_force(odd, odd_rows):
    rows = odd_rows + [(600 + i, "z" * 4096 * 3 + ("" if i % 2 else "y"), "en", "s", 1) for i in range(6)]
    df = odd.sparkSession.createDataFrame(rows, odd.schema).repartition(4)
    assert Counter(tuple(r) for r in exact_duplicates(df).collect()) == brute_exact(rows)


def test_a_text_held_by_most_rows_spreads(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(100)]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert Counter(tuple(r) for r in got) == brute_exact(rows)


def test_exact_duplicates_of_nothing(empty):
    assert exact_duplicates(empty).collect() == []


def test_the_largest_id_of_equal_texts_stays(clashing, odd_rows):
    kept = drop_exact_duplicates(clashing)
    assert kept.columns == clashing.columns
    best = {}
    for r in odd_rows:
        best[fold(r[1])] = max(best.get(fold(r[1]), -1), -1 if r[0] is None else r[0])
    assert Counter((r["doc_id"], fold(r["text"])) for r in kept.collect()) == Counter(
        (None if v == -1 else v, k) for k, v in best.items()
    )


@pytest.mark.parametrize("operator", [near_duplicates, exact_duplicates])
def test_clashing_columns_do_not_disturb(operator, odd, clashing):
    assert Counter(map(tuple, operator(clashing).collect())) == Counter(map(tuple, operator(odd).collect()))
