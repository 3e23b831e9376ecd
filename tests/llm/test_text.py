"""Tokenizing, line dedup, mixing and quality against brute force and public libraries."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import sentence
from pyspark.sql import functions as F

from paritas.llm import bpe
from paritas.llm.line_dedup import drop_repeated_windows
from paritas.llm.mixing import mix, mixed, source_targets
from paritas.llm.quality import Resampler, keep_quality, quality_sample

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = ["a", "b", "'", "'s", "'ll", "'re", "'ve", "'S", "s", "t", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x85", "1", "½",
          "é", "ß", "中文", "!", "...", "\U0001f600", "‍", "don't", "we'll", "\x00", "<|endoftext|>", "'l", "'r"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_are_those_of_the_library(reference, parts):
    text = "".join(parts)
    (ids, ends), = bpe.encode_texts(pa.array([text]))
    assert ids.tolist() == reference.encode_ordinary(text)
    assert (int(ends[-1]) if len(ends) else 0) == len(text.encode())


def test_long_texts_and_pieces(reference):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES + ["word ", "other "]) for _ in range(600_000)), "ab" * 60_000, " " * 9000 + "x", None, "", sentence(4, 200_000)]
    for text, (ids, _) in zip(texts, bpe.encode_texts(pa.array(texts))):
        assert ids.tolist() == reference.encode_ordinary(text or "")


def test_equal_hashes_do_not_matter(reference, monkeypatch):
    monkeypatch.setattr(bpe, "mix", lambda x: x & np.uint64(1))
    texts = ["some words that now all collide, and some more of them", "ab abc abcd"]
    assert [i.tolist() for i, _ in bpe.encode_texts(pa.array(texts))] == [reference.encode_ordinary(t) for t in texts]


def test_round_trip(odd, odd_rows, reference):
    want = Counter()
    for r in odd_rows:
        ids = reference.encode_ordinary(r[1] or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want[(r[0], len(ids), digest, hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.round_trip(odd).collect())) == want


def test_encode_then_decode(clashing, odd_rows, empty):
    tokens = bpe.encode(clashing)
    assert tokens.columns == ["doc_id", "n_tokens", "ids", "ends"]
    back = Counter((r[0], bytes(r[1])) for r in bpe.decode(tokens).collect())
    assert back == Counter((r[0], (r[1] or "").encode()) for r in odd_rows)
    assert bpe.encode(empty).collect() == [] and bpe.round_trip(empty).collect() == []


def brute_lines(rows):
    docs = [(r[0], (r[1] or "").split("\n")) for r in rows]
    seen = defaultdict(set)
    for i, lines in docs:
        for p in range(len(lines) - 2):
            seen[tuple(lines[p : p + 3])].add((-1 if i is None else i, tuple(lines), p))
    out = Counter()
    for i, lines in docs:
        gone = set()
        for p in range(len(lines) - 2):
            first = min(seen[tuple(lines[p : p + 3])], key=lambda x: (x[0], x[2]))
            here = (-1 if i is None else i, tuple(lines), p)
            if first != here:
                own = range(first[2], first[2] + 3) if first[:2] == here[:2] else ()
                gone |= {k for k in range(p, p + 3) if k not in own}
        out[(i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))] += 1
    return out


def test_repeated_windows(odd, odd_rows, clashing, empty):
    want = brute_lines(odd_rows)
    assert Counter(map(tuple, drop_repeated_windows(odd).collect())) == want
    assert Counter(map(tuple, drop_repeated_windows(clashing).collect())) == want
    assert drop_repeated_windows(empty).collect() == []


def test_targets_fill_up_to_the_limit(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 500, "e": 0, None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r[0]: r[2] for r in source_targets(df).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [3, 1, 2, 3, 1, 2]))
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            want |= {s: level * weight[s] for s in open_}
            break
        want |= {s: 2.0 * sizes[s] for s in full}
        left, open_ = left - sum(2 * sizes[s] for s in full), open_ - full
    assert got == pytest.approx(want)


def test_mix_meets_targets(spark):
    rows = [(i, sentence(i, 5 + i * 7 % 90), f"s{i % 7 if i % 3 else 0}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    got = mix(df).collect()
    again = Counter(map(tuple, mix(df.repartition(3)).collect()))
    assert Counter(map(tuple, got)) == again and len(got) == 3000
    by = defaultdict(lambda: [0, 0, 0])
    words = {r[0]: len(r[1].split()) for r in rows}
    source = {r[0]: r[2] for r in rows}
    for r in got:
        assert r["size"] == words[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        entry = by[source[r["doc_id"]]]
        entry[0], entry[1], entry[2] = r["target"], entry[1] + r["taken"], entry[2] + r["size"]
    for target, taken, size in by.values():
        assert abs(taken - target) <= 3 and target <= 2 * size
    assert sum(t for t, _, _ in by.values()) == pytest.approx(1.5 * sum(words.values()))


def test_one_long_text_does_not_end_the_draw(spark):
    rows = [(1000 * s + i, "w " * (400 if i else 400 * 500), f"s{s:02}") for s in range(18) for i in range(501)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mix(df).groupBy(F.floor(F.col("doc_id") / 1000)).agg(F.first("target"), F.sum("taken"), F.max("copies")).collect()
    assert len(got) == 18 and len({r[1] for r in got}) > 1
    for _, target, taken, copies in got:
        assert abs(taken - target) <= 400 and copies <= 2


def test_weights_lead_the_draw(spark):
    rows = [(i, sentence(i, 20), "s", float(1 + 9 * (i % 2))) for i in range(4000)] + [(9000 + i, sentence(i, 60), "t", 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, w double")
    got = mix(df, weight_col="w").where("doc_id < 9000").collect()
    light = sum(r["copies"] for r in got if r["doc_id"] % 2 == 0)
    heavy = sum(r["copies"] for r in got if r["doc_id"] % 2)
    assert heavy > 1.5 * light > 0


def test_mix_of_odd_rows(odd, clashing, empty):
    assert mix(empty).collect() == []
    assert Counter(map(tuple, mix(clashing).collect())) == Counter(map(tuple, mix(odd).collect()))
    whole = mixed(clashing)
    assert whole.columns == clashing.columns
    copies = Counter(r["doc_id"] for r in whole.collect())
    assert max(copies.values()) <= 4  # two rows may share an id


def junk(i):
    return " ".join(f"{w}{'%#$&'[i % 4] * 3}" for w in sentence(i, 40 + i % 30).split())


@pytest.fixture(scope="module")
def rated(spark):
    rows = [(i, junk(i) if i % 5 == 0 else sentence(i, 30 + i % 80)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 3000, 2)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_quality_on_held_out_rows(rated):
    docs, labels = rated
    got = {r["doc_id"]: r["kept"] for r in quality_sample(docs, labels).collect()}
    held_out = [i for i in range(3000) if i % 2]
    assert np.mean([got[i] == (i % 5 > 0) for i in held_out]) > 0.99
    assert all(got[i] for i in held_out if i % 5)


def test_the_sample_is_the_k_largest_keys(rated):
    docs, labels = rated
    rows = quality_sample(docs, labels).collect()
    kept = sorted(r["sampling_key"] for r in rows if r["kept"])
    rest = [r["sampling_key"] for r in rows if not r["kept"]]
    assert max(rest) < kept[0]
    model = Resampler().fit(docs, labels)
    assert len(kept) >= model.k and kept[len(kept) - model.k] == kept[0]


def test_quality_of_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (3, None, 1), (1, 7, 0)], "doc_id bigint, quality int, toxic int")
    nothing = labels.limit(0)
    assert all(r["kept"] for r in quality_sample(odd, nothing).collect())
    assert keep_quality(clashing, nothing).count() == odd.count()
    assert keep_quality(clashing, labels).columns == clashing.columns
    assert quality_sample(empty, labels).collect() == []


def test_words_of_a_mix_are_counted_by_bytes(spark):
    text = "a\xa0b c d\x0be\x1cf  \r\n g"
    df = spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")
    assert mix(df).first()["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text))
