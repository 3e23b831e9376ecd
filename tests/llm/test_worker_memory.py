"""What a Python worker holds, as Spark reuses it for all stages of the pipeline."""

import ctypes
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import sentence

from paritas.llm import bpe, near_dup, shingles
from paritas.llm.common import lean


def held() -> float:
    """MB of this process without mapped files."""
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="glibc only")
def test_freed_memory_is_given_back_after_each_batch():
    kept, after = [], []
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["i"]) for i in range(3)]
    before = held()
    for batch in lean(iter(batches)):
        after.append(held() - before)
        blocks = [np.ones(12_000) for _ in range(2000)]  # 192 MB, of a size that is not mapped apart
        kept.append(np.ones(12_000))  # lies above them, so they don't go by themselves
        del blocks
    after.append(held() - before)
    assert len(kept) == 3 and max(after) < 60


def test_short_texts_are_signed_in_parts():
    texts = [sentence(i % 700, 12) if i % 9 else None for i in range(3 * near_dup.SIGNED + 5)]
    large = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    names = ["id", "n", "digest", "bands", "sketch"]
    parts = list(near_dup._sign(iter([large]), names))
    assert max(p.num_rows for p in parts) <= near_dup.SIGNED
    alone = [next(near_dup._sign(iter([large.slice(i, 1)]), names)) for i in range(0, len(texts), 97)]
    rows = pa.Table.from_batches(parts).to_pylist()
    assert [r["id"] for r in rows] == list(range(len(texts)))
    assert [rows[i] for i in range(0, len(texts), 97)] == [a.to_pylist()[0] for a in alone]


def test_tables_of_the_encoder_stay_small():
    words = bpe.vocabulary(bpe.VOCABULARY)
    words.cache.clear()
    texts = pa.array([sentence(3, 4000), "zqxj vvkqz zqxj", "a" * 300, None])
    for (ids, _), text in zip(bpe.encode_texts(texts), texts.to_pylist()):
        assert words.decode(ids).tobytes().decode() == (text or "")
    # Whole tokens are in the ranks already; others are remembered as four bytes an id.
    assert words.cache and not words.ranks.keys() & words.cache.keys()
    assert all(words.decode(np.frombuffer(ids, np.uint32)).tobytes() == piece for piece, ids in words.cache.items())
    up, down = shingles.powers(bpe.RUN_BYTES)
    assert up.nbytes + down.nbytes <= 16 << 20
    assert not hasattr(bpe, "_hash_tables")
