"""Main text of pages by template deduction from equivalence classes.

1. Pages are compressed and dealt by ranges of (host, page), so that equal pages
   meet and neighbours are a host's.  Every page is cut into tokens (tags and
   words), told apart by their tag path and words also by the tokens beside them.
   A template's tokens are on half of the host's pages or more.  A run of
   neighbours keeps the occurrences of tokens on a quarter of a host's pages
   there only; of a host that several runs share, runs that do not list a token
   that can still be on half of all pages are read again for it.  Tokens of one host
   with the same occurrence vector form a class; vectors are compared by additive
   digests, so a host of any size is an aggregate combined before the shuffle,
   never a group in one task.
2. A class is valid if its tokens come in one order on every page (repeated
   ones: in one order per repetition) and nest: on no page does a class straddle
   the slots of a larger one.  Valid classes nested in each other are the host's
   template.  Words are the template's only where they stand in a run of class
   words too long for chance: each page but the first that a class is on makes
   a common run less likely, and so does a block's edge that the run reaches
   (``_least_words``, a smooth function of the pages).
3. What lies between template tokens are slots.  The text of slots inside the
   article is extracted; text that belongs to the template itself, and slots
   inside menus, headers, footers, sidebars, notices, adverts, forms, comments,
   scripts and styles, are not.  A block that is mostly template goes whole.
   Where a page marks its article, a block there goes if it is template from end
   to end and stands outside running text, headings, lists and tables; what
   repeats within those is content.

Equal pages of a host count as one, and a page that shares nothing has no
template: the marks of the page decide alone.

Defined cases: null or empty html gives empty text; null urls share the empty
host; rows that repeat come out each.  Text ends where a page is cut off; a tag
cut off is no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.llm.common import Workspace, ship, slices
from paritas.llm.markup import Template, blocks, page_blocks, paths, tags  # noqa: F401 - page_blocks reads a page by itself
from paritas.llm.shingles import SLICE_BYTES, as_bytes, mix, token_hashes
from paritas.llm.url_filter import host_and_path

#: Share of a host's pages a template token is on, and tokens a class has at least.
SUPPORT, CLASS_TOKENS = 0.5, 2
#: Words of a template run that reaches none, one or both edges of its block must be more than this on very many pages,
#: and by how much more on few: what chance repeats on a second page, each further page makes less of.
_RUN_WORDS, _SURPRISE = (5.0, 1.0, 0.0), 8.0
#: Share of a host's pages in a run from which a token is listed there; below ``SUPPORT``, so that chance seldom
#: keeps a token that is on half of all pages out of a run's list.
LISTED = 0.25
#: Kinds of tokens: words, tags of blocks, other tags.
_WORD, _EDGE, _INLINE = 0, 1, 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Inflated html of a run of pages, in bytes; a larger page goes alone.
RUN_BYTES = 8 << 20


# Pages, compressed and dealt by host


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compresses pages; of equal ones of a host in a batch, one."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        hosts, pages = batch.column("host").to_pylist(), batch.column("page").to_pylist()
        rows = list({(h, p): i for i, (h, p) in enumerate(zip(hosts, pages))}.values())
        texts = [(batch.column("html")[i].as_py() or "").encode() for i in rows]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("host", "page")),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()),
            ],
            ["host", "page", "size", "packed"],
        )


def _inflated(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of a batch's pages: ``(first, end, bytes, offsets)``; a page of more than ``most`` bytes goes alone."""
    codec, packed = pa.Codec("zstd"), batch.column("packed")
    sizes = batch.column("size").to_pylist()
    for a, b in slices(sizes, most):
        raw = b"".join(codec.decompress(packed[i].as_py(), decompressed_size=sizes[i], asbytes=True) if sizes[i] else b"" for i in range(a, b))
        yield a, b, np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8), np.cumsum([0, *sizes[a:b]])


# Tokens


def _page_tokens(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """For runs of pages: ``(first, end, owner, token hash, byte offset in the page, kind, tags of each page)``.

    Tokens are tags and words, told apart by the blocks they are in, and words
    also by the token before and after: next to a block's edge, by that edge.
    """
    for a, b in slices(np.diff(offsets).tolist(), SLICE_BYTES):
        hashes, bounds, starts = token_hashes(data, offsets[a : b + 1])
        owner = np.repeat(np.arange(b - a), np.diff(bounds))
        begin = offsets[a : b + 1] - offsets[a]
        found = tags(data[offsets[a] : offsets[b]], begin)
        placed: list[tuple[int, int, bool, int]] = []
        for first, page in zip(begin.tolist(), found):
            paths(page, first, placed)
        begins, ends, block, path = (np.array(c) for c in zip(*placed))
        at = np.searchsorted(begins, starts, side="right") - 1
        in_tag, path = starts < ends[at], path[at].astype(np.uint64)
        kind = np.where(in_tag, np.where(block[at], _EDGE, _INLINE), _WORD)
        token = mix(hashes + path * _ODD)
        line = np.flatnonzero(kind != _INLINE)
        value, whose = np.where(kind[line] == _EDGE, _ODD, hashes[line]), owner[line]
        before, after = np.full(len(line), _ODD), np.full(len(line), _ODD)
        same = whose[1:] == whose[:-1]
        before[1:][same], after[:-1][same] = value[:-1][same], value[1:][same]
        inner = kind[line] == _WORD
        token[line[inner]] = mix(mix(mix(before + path[line] * _ODD) + value) + after)[inner]
        yield a, b, owner, token, starts - begin[owner], kind, found


def _least_words(edges: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """Words a run of the template must have more of, by the block's edges it reaches and the pages its class is on."""
    return np.array(_RUN_WORDS)[edges] + _SURPRISE / np.maximum(pages - 1, 1e-9)


def _template_words(kind: np.ndarray, known: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """Which of a page's tokens are words of the template, given which are tokens of its classes, and on how many pages.

    A class word vouches for the words beside it.  A run of such words counts by
    its length, the block's edges it reaches and the pages of its words' classes.
    """
    line = np.flatnonzero(kind != _INLINE)
    word = kind[line] == _WORD
    share = np.zeros(len(kind))
    share[known] = pages
    share = np.where(word, share[line], 0)
    hit = share > 0
    run = hit.copy()
    run[1:] |= hit[:-1]
    run[:-1] |= hit[1:]
    run &= word
    edge = np.diff(np.concatenate([[0], run.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    if not len(first):
        return np.zeros(0, np.int64)
    inside = np.concatenate([[False], word, [False]])
    edges = (hit[first] & ~inside[first]).astype(int) + (hit[last] & ~inside[last + 2])
    most = np.maximum.reduceat(share, np.stack([first, last + 1], axis=1).reshape(-1)[: 2 * len(first) - (last[-1] + 1 >= len(share))])[::2]
    keep = last - first + 1 > _least_words(edges, most)
    chosen = [line[f : e + 1] for f, e in zip(first[keep], last[keep])]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def _grouped(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(order, starts)`` that group rows with equal keys."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    if len(order):
        change[0] = True
        for k in keys:
            k = k[order]
            change[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(change)


# Occurrences


def _whole_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, token and place of all tokens of a run."""
    parts = [(owner + a, token, place) for a, _, owner, token, place, *_ in _page_tokens(data, offsets)]
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _lists(owner: np.ndarray, values: np.ndarray, count: int) -> pa.ListArray:
    """Values of each owner in turn, as lists; owners are sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)), pa.array(values))


def _kept(host: np.ndarray, owner: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Which occurrences are of tokens on a share of ``LISTED`` of the host's pages in a run.

    Hosts lie in a row.  One that neither begins nor ends the run is whole, so its
    tokens must be on two pages too.
    """
    if not len(owner):
        return np.zeros(0, bool)
    key = mix(token + host[owner].astype(np.uint64) * _ODD)
    order = np.argsort(key, kind="stable")  # owners stay sorted within a key
    key, page = key[order], owner[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(fresh)
    times = np.add.reduceat(fresh | np.concatenate([[True], page[1:] != page[:-1]]), starts, dtype=np.int64)
    whose = host[page[starts]]
    least = LISTED * np.bincount(host)[whose]
    inner = (whose != host[0]) & (whose != host[-1])
    enough = times >= np.where(inner, np.maximum(least, 2), least)
    kept = np.empty(len(owner), bool)
    kept[order] = np.repeat(enough, np.diff(np.append(starts, len(order))))
    return kept


def _occurrences(run_bytes: int):
    """``host, page, run, tokens, places`` of pages sorted by host and page; of equal neighbours the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keys = list(zip(batch.column("host").to_pylist(), batch.column("page").to_pylist()))
            fresh = [key != before for key, before in zip(keys, [last, *keys])]
            last = keys[-1] if keys else last
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            hosts = batch.column("host").to_pylist()
            for x, y, data, offsets in _inflated(batch, run_bytes):
                _, host = np.unique(np.array(hosts[x:y], object), return_inverse=True)
                owner, token, place = _whole_tokens(data, offsets)
                kept = _kept(host, owner, token)
                owner, token, place = owner[kept], token[kept].view(np.int64), place[kept].astype(np.int32)
                pages = batch.column("page")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("host").slice(x, y - x), pages.slice(x, y - x), pa.array([pages[x].as_py()] * (y - x), pa.int64()),
                        _lists(owner, token, y - x), _lists(owner, place, y - x),
                    ],
                    ["host", "page", "run", "tokens", "places"],
                )

    return run


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, page, more, more_places``: occurrences of wanted tokens in pages that are read again."""
    for batch in batches:
        data, offsets = as_bytes(batch.column("html"))
        offsets = offsets - offsets[0] if len(offsets) else offsets
        owner, token, place = _whole_tokens(data[: offsets[-1]], offsets)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        wanted = batch.column("wanted")
        at = [_members(token[bounds[i] : bounds[i + 1]], np.sort(wanted[i].values.to_numpy()))[0] + bounds[i] for i in range(batch.num_rows)]
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        lists = [_lists(owner[at], v[at], batch.num_rows) for v in (token.view(np.int64), place.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), *lists], ["host", "page", "more", "more_places"])


def occurrences(pages: DataFrame, work: Workspace, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``host, page, tokens, places`` of the different pages of every host (``host, page, html`` in).

    Tokens are those on half of the host's pages, and others; all occurrences of each token that is listed for a
    host are listed if it can be on half of its pages.
    """
    packed = pages.mapInArrow(_packed, "host string, page bigint, size bigint, packed binary")
    ranges = packed.repartitionByRange("host", "page").sortWithinPartitions("host", "page")
    layout = "host string, page bigint, run bigint, tokens array<bigint>, places array<int>"
    first = work.write(ranges.mapInArrow(_occurrences(run_bytes), layout), "first")
    work.sweep()

    # Hosts of several runs: a token that a run does not list is on ``unseen`` of its pages at most, often on none.
    runs = first.groupBy("host", "run").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.withColumn("unseen", F.ceil(F.col("n") * LISTED) - 1)
    totals = runs.groupBy("host").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("all_pages"), F.sum("unseen").alias("all_unseen")).where("runs > 1")
    totals = work.write(totals, "totals")
    listed = first.join(totals.select("host"), "host", "left_semi").select("host", "run", F.explode(F.array_distinct("tokens")).alias("token"))
    listed = work.write(listed.groupBy("host", "run", "token").agg(F.count(F.lit(1)).alias("seen")), "listed")
    bound = listed.join(runs, ["host", "run"]).groupBy("host", "token").agg(F.sum(F.col("seen") - F.col("unseen")).alias("over"), F.count(F.lit(1)).alias("in_runs"))
    open_ = bound.join(totals, "host").where((F.col("over") + F.col("all_unseen") >= F.col("all_pages") * SUPPORT) & (F.col("in_runs") < F.col("runs")))
    missing = open_.select("host", "token").join(runs.where("unseen > 0").select("host", "run"), "host").join(listed, ["host", "run", "token"], "left_anti")
    missing = work.write(missing.groupBy("host", "run").agg(F.collect_list("token").alias("wanted")), "missing")
    if missing.isEmpty():
        return first.drop("run")
    # Written, so that a few pages are known to be few when the join is planned.
    asked = work.write(first.select("host", "page", "run").join(missing, ["host", "run"]).select("host", "page", "wanted"), "asked")
    html = pages.join(asked, ["host", "page"]).mapInArrow(_again, "host string, page bigint, more array<bigint>, more_places array<int>")
    html = work.write(html.groupBy("host", "page").agg(F.min_by(F.struct("more", "more_places"), F.lit(0)).alias("found")), "again")
    none = F.array().cast("array<bigint>"), F.array().cast("array<int>")
    both = first.join(html, ["host", "page"], "left").select(
        "host", "page", F.concat("tokens", F.coalesce("found.more", none[0])).alias("tokens"),
        F.concat("places", F.coalesce("found.more_places", none[1])).alias("places"),
    )
    return work.write(both, "occurrences")


# Classes


def _members(own: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of a page's tokens are in a sorted list, and where there."""
    own = own.view(np.int64)
    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
    at = np.flatnonzero(known[place] == own) if len(known) else np.zeros(0, np.int64)
    return at, place[at]


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Owner and value of everything in a column of lists."""
    sizes = np.diff(np.asarray(lists.offsets))
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy()


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: two digest sums of the occurrence vector, and pages it is on."""
    for batch in batches:
        names, host = np.unique(np.array(batch.column("host").to_pylist(), object), return_inverse=True)
        owner, token = _flat(batch.column("tokens"))
        if not len(owner):
            continue
        pages = np.asarray(batch.column("page")).view(np.uint64)
        order, starts = _grouped([owner, token])
        times = np.diff(np.append(starts, len(order))).astype(np.uint64)
        owner, token = owner[order][starts], token[order][starts]
        digest = mix(mix(pages[owner] + _ODD) + times * _ODD)
        order, starts = _grouped([host[owner], token])
        low = np.add.reduceat((digest & np.uint64(0x7FFFFFFF)).astype(np.int64)[order], starts)
        high = np.add.reduceat((digest >> np.uint64(33)).astype(np.int64)[order], starts)
        count = np.diff(np.append(starts, len(order))).astype(np.int64)
        arrays = [
            pa.array([names[i] for i in host[owner][order][starts]], pa.string()), pa.array(token[order][starts]),
            pa.array(low), pa.array(high), pa.array(count),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "token", "low", "high", "pages"])


def _class_spans(at: np.ndarray, tokens: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int | None, bool]]:
    """Of a page's class tokens: ``(class, order of its tokens, straddles)``; the order is None where repetitions differ.

    A class that is on the page once straddles if a token of a larger one, also
    there once, lies between its first and its last.  Larger classes are marked
    from size to size, so the work grows with tokens and sizes, not with pairs.
    """
    order, starts = _grouped([group, at])
    change = np.flatnonzero(np.diff(group[order], prepend=group[order][0] - 1))
    ends = np.append(change[1:], len(order))
    spans = []
    sizes = np.zeros(len(at), np.int64)
    for a, b in zip(change.tolist(), ends.tolist()):
        members = order[a:b]
        mine = tokens[members]
        distinct = len(set(mine.tolist()))
        rounds = mine.reshape(-1, distinct) if len(mine) % distinct == 0 else mine[None, :]
        even = rounds.shape[1] == distinct and bool((rounds == rounds[0]).all())
        pattern = hash(tuple(rounds[0].tolist())) if even else None
        single = distinct == len(mine)
        if single:
            sizes[members] = b - a
        spans.append((int(group[members[0]]), pattern, single, b - a, int(members[0]), int(members[-1])))
    larger: dict[int, np.ndarray] = {}
    for g, pattern, single, size, first, last in spans:
        straddles = False
        if single:
            if size not in larger:
                larger[size] = np.concatenate([[0], np.cumsum(sizes > size)])
            straddles = bool(larger[size][last] > larger[size][first])
        yield g, pattern, straddles


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and class: the order its tokens come in, and on how many pages it does not nest."""
    for batch in batches:
        hosts, seen = batch.column("host").to_pylist(), {}
        tokens, places, cells = (batch.column(c) for c in ("tokens", "places", "known"))
        for i, host in enumerate(hosts):
            pairs = cells[i].values
            known, classes = pairs.field("token").to_numpy(), pairs.field("grp").to_numpy()
            own, at = tokens[i].values.to_numpy(), places[i].values.to_numpy()
            order = np.argsort(at)
            chosen, which = _members(own[order].view(np.uint64), known)
            if not len(chosen):
                continue
            for g, pattern, straddles in _class_spans(chosen, known[which], classes[which]):
                low, high, bad = seen.get((host, g), (pattern, pattern, 0))
                broken = pattern is None or low is None
                seen[host, g] = (None if broken else min(low, pattern), None if broken else max(high, pattern), bad + straddles + broken)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in seen]), pa.array([g for _, g in seen]), pa.array([v[0] for v in seen.values()], pa.int64()),
                    pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[2] for v in seen.values()], pa.int64()),
                ],
                names=["host", "grp", "low", "high", "bad"],
            )


def frequent_tokens(found: DataFrame, work: Workspace) -> DataFrame:
    """``host, token, grp, pages`` of the tokens on half of a host's pages and on two; ``grp`` names the occurrence vector."""
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    vectors = found.select("host", "page", "tokens").mapInArrow(_vectors, "host string, token bigint, low bigint, high bigint, pages bigint")
    vectors = vectors.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("low", "high", "pages")])
    frequent = vectors.join(sizes, "host").where(F.col("pages") >= F.col("all_pages") * SUPPORT).where("pages > 1")
    return work.write(frequent.select("host", "token", F.xxhash64("low", "high", "pages").alias("grp"), "pages"), "frequent")


def templates(pages: DataFrame, work: Workspace, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``host, tokens``: the tokens of the valid classes of each host (``host, page, html`` in), with their class and its pages."""
    found = occurrences(pages, work, run_bytes)
    frequent = frequent_tokens(found, work)
    classes = frequent.groupBy("host", "grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CLASS_TOKENS)
    tokens = work.write(frequent.join(classes.drop("n"), ["host", "grp"]), "tokens")
    cell = F.array_sort(F.collect_list(F.struct("token", "grp", "pages")))
    cells = work.write(tokens.groupBy("host").agg(cell.alias("known")), "classes")
    checks = found.join(cells, "host").select("host", "tokens", "places", "known")
    checks = checks.mapInArrow(_checks, "host string, grp bigint, low bigint, high bigint, bad bigint")
    checks = checks.groupBy("host", "grp").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("bad").alias("bad"))
    valid = checks.where("low = high AND bad = 0").select("host", "grp")
    kept = work.write(tokens.join(valid, ["host", "grp"]).groupBy("host").agg(cell.alias("tokens")), "templates")
    work.drop("first", "totals", "listed", "missing", "asked", "again", "occurrences", "frequent", "tokens", "classes")
    return kept


def _extract(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = batch.column("tokens")
        texts, slots = [], []
        data, offsets = as_bytes(batch.column("html"))
        for a, b, owner, token, place, kind, found in _page_tokens(data, offsets):
            bounds = np.searchsorted(owner, np.arange(b - a + 1))
            for i in range(b - a):
                page, template, frame = data[offsets[a + i] : offsets[a + i + 1]].tobytes(), None, 0
                if cells[a + i].is_valid:
                    rows = slice(bounds[i], bounds[i + 1])
                    pairs, own, where = cells[a + i].values, kind[rows], place[rows]
                    at, which = _members(token[rows], pairs.field("token").to_numpy())
                    frame = int(np.count_nonzero(np.diff(at) > 1)) + 1 if len(at) else 0
                    words = _template_words(own, at, pairs.field("pages").to_numpy()[which])
                    template = Template(where[own == _WORD].tolist(), where[words].tolist()) if len(words) else None
                texts.append("\n".join(blocks(page, found[i], template)))
                slots.append(frame)
        n = [len(t) for t in texts]
        arrays = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(slots, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, ``text``, ``n_chars`` and ``n_slots``, the slots its host's template leaves on it."""
    ship(pages.sparkSession)
    work = Workspace(pages.sparkSession, "html")
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), host_and_path(url)[0].alias("host"), F.col(f"`{html_col}`").alias("html"))
    keyed = rows.withColumn("html", F.coalesce("html", F.lit(""))).select("host", F.xxhash64("html").alias("page"), "html")
    joined = rows.join(templates(keyed, work), "host", "left").select("id", "url", "html", "tokens")
    schema = T.StructType(joined.schema.fields[:2]).add("text", T.StringType()).add("n_chars", T.LongType()).add("n_slots", T.LongType())
    names = schema.names
    found = joined.mapInArrow(lambda b: _extract(b, names), schema)
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_slots")
