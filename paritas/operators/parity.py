"""Do two tables hold the same data?

Both sides are read once per check and reduced before anything moves: counts
and digests are partial aggregates, and per-key comparison is one grouped
aggregation over the union of both sides, so a key (or a duplicate group) of
any size is combined on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions import canon
from paritas.functions.tolerance import allowed
from paritas.operators.report import FAIL, as_checks, verdict
from paritas.session import durable

#: Bits a level of a digest tree adds to the one above, at most.
WIDEST = 16

def _two_sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """Union of both sides with ``_side`` 0 and 1."""
    left = source.withColumn("_side", F.lit(0))
    return left.unionByName(target.withColumn("_side", F.lit(1)))


def _pick(side: int, column: str) -> Column:
    return F.max(F.when(F.col("_side") == side, F.col(column)))


# -- counts ------------------------------------------------------------------


def rowcount_parity(
    source: DataFrame,
    target: DataFrame,
    tolerance: str | float = "0",
    source_filter: str | None = None,
    target_filter: str | None = None,
    *,
    name: str = "target",
    **labels,
) -> DataFrame:
    """One check: row counts agree within ``tolerance``."""
    left = source.where(source_filter) if source_filter else source
    right = target.where(target_filter) if target_filter else target
    n = F.count(F.lit(1)).alias("n")
    counts = _two_sides(left.agg(n), right.agg(n)).agg(_pick(0, "n").alias("src"), _pick(1, "n").alias("tgt"))
    counts = counts.withColumn("delta", F.abs(F.col("src") - F.col("tgt")))
    counts = counts.withColumn("allowed", allowed(tolerance, F.col("src")))
    return as_checks(
        counts,
        "rowcount_parity",
        target=F.lit(name),
        status=verdict(F.col("delta") <= F.col("allowed")),
        message=F.format_string("src=%d tgt=%d delta=%d", "src", "tgt", "delta"),
        expected=F.col("src"),
        actual=F.col("tgt"),
        metrics={"source_count": F.col("src"), "target_count": F.col("tgt"), "delta": F.col("delta")},
        **labels,
    )


# -- aggregates --------------------------------------------------------------

def _aggregate(fn: str, column: str, dtype: T.DataType) -> Column:
    c = F.col(f"`{column}`")
    if fn == "sum":
        return F.sum(c.cast("decimal(20,0)") if isinstance(dtype, T.IntegralType) else c)
    if fn == "count":
        return F.count(c)
    if fn == "count_distinct":
        return F.countDistinct(c)
    if fn in ("min", "max"):
        return getattr(F, fn)(c)
    raise ValueError(f"unknown aggregate {fn!r}")


def _float_sum(df: DataFrame, column: str) -> DataFrame:
    """The sum ``a0`` of doubles of any magnitude, whatever the order of the rows.

    A double is a whole number of 2**(exponent - 52).  Whole numbers are added
    exactly per exponent (some hundred groups, combined before the shuffle) and
    the groups' sums in order of exponent.  NaN, and infinities of both signs,
    give NaN.
    """
    x = F.col(f"`{column}`").cast("double")
    infinite = F.lit(float("inf"))
    finite = ~F.isnan(x) & (F.abs(x) != infinite)
    # One bit more than needed, since a logarithm just below a whole number may be rounded up to it.
    exponent = F.when(finite & (x != 0), F.floor(F.log2(F.abs(x))) - 1).otherwise(F.lit(0)).cast("int")
    # Scaled in two steps: 2**(52 - exponent) may itself be too large for a double.
    scaled = F.round(x * F.pow(F.lit(2.0), F.floor((52 - exponent) / 2)) * F.pow(F.lit(2.0), F.ceil((52 - exponent) / 2)))
    whole = F.when(finite, scaled.cast("decimal(20,0)"))
    odd = F.when(x.isNotNull() & ~finite, x)
    parts = df.select(exponent.alias("e"), whole.alias("m"), odd.alias("odd")).where("m IS NOT NULL OR odd IS NOT NULL")
    parts = parts.groupBy("e").agg(F.sum("m").alias("m"), F.sum("odd").alias("odd"))
    term = F.col("m").cast("double") * F.pow(F.lit(2.0), F.floor((F.col("e") - 52) / 2)) * F.pow(F.lit(2.0), F.ceil((F.col("e") - 52) / 2))
    terms = F.array_sort(F.collect_list(F.struct("e", term.alias("t"))))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, p: acc + F.coalesce(p["t"], F.lit(0.0)))
    return parts.agg(F.when(F.count(F.lit(1)) > 0, F.coalesce(F.sum("odd"), total)).alias("a0"))


def _cell(value: Column, dtype: T.DataType, spec: Mapping[str, str]) -> Column:
    number, sec, txt = F.lit(None), F.lit(None), F.lit(None)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        sec = F.unix_seconds(value.cast("timestamp"))
    elif isinstance(dtype, T.DateType):
        sec = F.unix_date(value)
    elif isinstance(dtype, T.NumericType):
        number, txt = value, _digits(value, dtype)
    else:
        txt = value
    return F.struct(
        F.lit(spec["column"]).alias("column"),
        F.lit(spec["fn"]).alias("fn"),
        F.lit(str(spec.get("tolerance", "0"))).alias("tolerance"),
        number.cast("double").alias("num"),
        sec.cast("bigint").alias("sec"),
        txt.cast("string").alias("txt"),
    )


def _digits(value: Column, dtype: T.DataType) -> Column:
    """All digits of a number as text that equal numbers of any type share; doubles of plain magnitude as decimals."""
    text = value.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        plain = value.cast("double")
        small = (F.abs(plain) < 1e15) & ((plain == 0) | (F.abs(plain) >= 1e-3)) & ~F.isnan(plain)
        # The shortest text of such a double has a point and no exponent once it is a decimal.
        text = F.when(small, F.when(small, text).try_cast("decimal(38,20)").cast("string")).otherwise(text)
    return _trimmed(text)


def table_aggregates(df: DataFrame, aggregates: Sequence[Mapping[str, str]]) -> DataFrame:
    """One row per aggregate: ``column, fn``, ``txt`` with all digits and ``num`` as a double for
    numbers, ``sec`` for instants (whole seconds) and dates (days), ``txt`` for everything else.

    Distinct counts and sums of doubles run apart from the rest: together, Spark
    would group the whole table by them and carry every other aggregate along.
    """
    inexact = lambda a: a["fn"] == "sum" and isinstance(df.schema[a["column"]].dataType, (T.FloatType, T.DoubleType))
    apart = [a for a in aggregates if a["fn"] == "count_distinct" or inexact(a)]
    plain = [a for a in aggregates if a not in apart]
    out = None
    for group in ([plain] if plain else []) + [[a] for a in apart]:
        if inexact(group[0]):
            row = _float_sum(df, group[0]["column"])
        else:
            row = df.agg(
                *[_aggregate(a["fn"], a["column"], df.schema[a["column"]].dataType).alias(f"a{i}") for i, a in enumerate(group)]
            )
        types = [f.dataType for f in row.schema.fields]
        cells = row.select(F.inline(F.array(*[_cell(F.col(f"a{i}"), types[i], a) for i, a in enumerate(group)])))
        out = cells if out is None else out.unionByName(cells)
    return out


#: Scales tried for an exact difference; with 37 digits the difference of two still has its scale.
_SCALES = (0, 6, 12, 18, 24, 30, 36)


def _within(src: Column, tgt: Column, src_text: Column, tgt_text: Column, limit: Column) -> Column:
    """Whether two numbers differ by ``limit`` at most.

    The difference is exact, at the first scale that holds all digits of both;
    numbers that no decimal holds are subtracted as doubles.
    """
    gaps = []
    for scale in _SCALES:
        sides = [text.try_cast(f"decimal(37,{scale})") for text in (src_text, tgt_text)]
        whole = [_trimmed(side.cast("string")) == _trimmed(text) for side, text in zip(sides, (src_text, tgt_text))]
        gaps.append(F.when(whole[0] & whole[1], F.abs(sides[0] - sides[1]).cast("double")))
    return (limit > 0) & (F.coalesce(*gaps, F.abs(src - tgt)) <= limit)


def _trimmed(text: Column) -> Column:
    """Digits without trailing zeros of a fraction."""
    pointed = text.contains(".") & ~text.contains("E")
    return F.when(pointed, F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def aggregate_parity(
    source: DataFrame, target: DataFrame, aggregates: Sequence[Mapping[str, str]], *, name: str = "target", **labels
) -> DataFrame:
    """One check per ``{column, fn, tolerance?}``; instants are compared in whole
    seconds, numbers in all their digits, and NULL equals NULL, NaN equals NaN."""
    sides = _two_sides(table_aggregates(source, aggregates), table_aggregates(target, aggregates))
    both = sides.groupBy("column", "fn", "tolerance").agg(
        *[_pick(side, c).alias(f"{label}_{c}") for side, label in ((0, "src"), (1, "tgt")) for c in ("num", "sec", "txt")]
    )
    src, tgt = F.col("src_num"), F.col("tgt_num")
    percent = F.col("tolerance").endswith("%")
    size = F.regexp_replace("tolerance", "%", "").cast("double")
    limit = F.when(percent, F.abs(src).cast("double") * size / 100.0).otherwise(size)
    same_number = _within(src, tgt, F.col("src_txt"), F.col("tgt_txt"), limit)
    same_instant = F.abs(F.col("src_sec") - F.col("tgt_sec")) <= F.when(percent, F.lit(0.0)).otherwise(size)
    equal = F.col("src_sec").eqNullSafe(F.col("tgt_sec")) & F.col("src_txt").eqNullSafe(F.col("tgt_txt"))
    ok = equal | F.coalesce(same_number, F.lit(False)) | F.coalesce(same_instant, F.lit(False))
    shown = {label: F.coalesce(F.col(f"{label}_txt"), F.col(f"{label}_sec").cast("string")) for label in ("src", "tgt")}
    return as_checks(
        both,
        "aggregate_parity",
        target=F.concat(F.lit(name + "."), F.col("column"), F.lit(":"), F.col("fn")),
        status=verdict(ok),
        message=F.concat_ws(" ", F.lit("src"), shown["src"], F.lit("tgt"), shown["tgt"]),
        expected=shown["src"],
        actual=shown["tgt"],
        **labels,
    )


# -- fingerprints and keyed differences ---------------------------------------


def counted_rows(*tables: DataFrame) -> int:
    """Rows of the largest of the tables."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")) for df in tables]
    return reduce(DataFrame.unionByName, counts).agg(F.max("n")).first()[0]


def tree_bits(n_rows: int, first: int | None = None) -> tuple[int, ...]:
    """Bits of the key hash that number the nodes of each level of a digest tree.

    The last level has twice as many nodes as ``n_rows`` at least, so a node
    there is a key or two.  Levels are as few as can be with at most ``WIDEST``
    bits each, but two; ``first`` sets the first level's bits.
    """
    leaves = min(canon.HASH_BITS, max(2, n_rows.bit_length() + 1))
    if first:
        rest = max(1, leaves - first)
        steps = -(-rest // WIDEST)
        return (first, *(first + rest * (i + 1) // steps for i in range(steps)))
    levels = max(2, -(-leaves // WIDEST))
    return tuple(leaves * (i + 1) // levels for i in range(levels))


def bucket_digests(df: DataFrame, key: Sequence[str], columns: Sequence[str], bits: int | None = None, **options):
    """One digest per node of a digest tree's first level: ``bucket, n, sum1, sum2, xor1, xor2, digest``.

    ``bits`` numbers the nodes; by default it follows from the counted rows.
    """
    bits = bits or tree_bits(counted_rows(df))[0]
    keyed = df.withColumn("bucket", canon.key_node(df, key, bits))
    hashed = canon.with_row_hashes(keyed, columns, keep=("bucket",), **options)
    return canon.finish_digest(hashed.groupBy("bucket").agg(*canon.digest_columns()), "bucket")


def _signed_rows(source, target, key, columns, options, keep=(), prepare=lambda df: df) -> DataFrame:
    """``keep`` columns, ``h1``, ``h2`` and ``_side`` of the rows of both (prepared) tables."""
    sides = [canon.with_row_hashes(prepare(df), columns, keep=keep or key, **options) for df in (source, target)]
    return _two_sides(*sides)


def _net(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group: rows on each side and the hash sums of source minus target."""
    return rows.groupBy(*group).agg(
        F.expr("count_if(_side = 0) AS n_source"),
        F.expr("count_if(_side = 1) AS n_target"),
        *canon.piece_sums("(1 - 2 * _side)"),
    )


_DIFFERS = " OR ".join(["n_source != n_target", *[f"{piece} != 0" for piece in canon.PIECES]])


def _classified(net: DataFrame, key: Sequence[str]) -> DataFrame:
    kind = F.expr("CASE WHEN n_target = 0 THEN 'missing' WHEN n_source = 0 THEN 'extra' ELSE 'changed' END AS difference")
    return net.where(_DIFFERS).select(*key, kind, "n_source", "n_target")


def diff_keys(source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], **options) -> DataFrame:
    """Every key whose rows differ: ``missing`` from the target, ``extra`` in it, or ``changed``.

    Duplicate keys are compared as multisets and their counts kept.
    """
    return _classified(_net(_signed_rows(source, target, key, columns, options), key), key)


class DigestTree:
    """Two tables compared node by node, level by level, down to the differing keys.

    The first level is one pass over both tables, folded to a digest per node and
    side.  Rows of its unequal nodes are read in a second pass and written down
    with their hashes; every further level folds those that are left and keeps the
    rows of unequal nodes only.  The last pass nets what remains by key.  The number
    of levels and nodes follows from the counted rows.
    """

    def __init__(self, source, target, key, columns, first: int | None = None, **options):
        self.source, self.target, self.key, self.columns, self.options = source, target, list(key), columns, options
        self.bits = tree_bits(counted_rows(source, target), first)
        node = lambda df: df.withColumn("_node", canon.key_node(df, key, self.bits[0]))
        rows = _signed_rows(source, target, key, columns, options, keep=["_node"], prepare=node)
        #: Digest parts per side and node of the first level: at most two rows per node.
        self.parts = durable(rows.groupBy("_side", "_node").agg(*canon.digest_columns()), "nodes")
        net = [F.expr(f"sum({c} * (1 - 2 * _side)) AS {c}") for c in ("n", *canon.PIECES)]
        signs = [F.expr(f"sum(if(_side = {i}, n, 0)) AS n_{s}") for i, s in enumerate(("source", "target"))]
        folded = self.parts.groupBy("_node").agg(*net, *signs)
        differs = " OR ".join(f"{c} != 0" for c in ("n", *canon.PIECES))
        self._passes = [_pass_row(folded, differs, 1)]
        suspects = self._suspects(folded.where(differs).select("_node"))
        for level, bits in enumerate(self.bits[1:], 2):
            at = F.expr(f"shiftright(_hash, {canon.HASH_BITS - bits})")
            nodes = _net(suspects.withColumn("_node", at), ["_node"])
            self._passes.append(_pass_row(nodes, _DIFFERS, level))
            left = suspects.withColumn("_node", at).join(nodes.where(_DIFFERS).select("_node"), "_node", "left_semi").drop("_node")
            suspects = durable(left, "suspects")
        self._keys = _net(suspects, self.key)
        self._passes.append(_pass_row(self._keys, _DIFFERS, len(self.bits) + 1))

    def _suspects(self, unequal: DataFrame) -> DataFrame:
        """Key, key hash, row hashes and side of the rows in unequal nodes of the first level."""

        def prepare(df: DataFrame) -> DataFrame:
            # Only the key is hashed before the filter; whole rows after it.  A level has at most 2**WIDEST nodes.
            hashed = df.withColumn("_hash", canon.key_node(df, self.key, canon.HASH_BITS))
            hashed = hashed.withColumn("_node", F.expr(f"shiftright(_hash, {canon.HASH_BITS - self.bits[0]})"))
            return hashed.join(F.broadcast(unequal), "_node", "left_semi")

        keep = [*self.key, "_hash"]
        rows = _signed_rows(self.source, self.target, self.key, self.columns, self.options, keep=keep, prepare=prepare)
        return durable(rows, "suspects")

    def differences(self) -> DataFrame:
        """The rows of :func:`diff_keys`."""
        return _classified(self._keys, self.key)

    def passes(self) -> DataFrame:
        """``pass, nodes, unequal, rows_read``: what each pass folded, and how many nodes (last: keys) were unequal."""
        return reduce(DataFrame.unionByName, self._passes).orderBy("pass")


def _pass_row(nodes: DataFrame, differs: str, number: int) -> DataFrame:
    return nodes.agg(
        F.lit(number).alias("pass"),
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.expr(differs)).alias("unequal"),
        F.coalesce(F.sum(F.col("n_source") + F.col("n_target")), F.lit(0)).cast("bigint").alias("rows_read"),
    )


def localised_differences(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    buckets: int | None = None,
    **options,
) -> DataFrame:
    """The rows of :func:`diff_keys`, found by drilling only into unequal nodes of a digest tree.

    ``buckets`` sets the first level's number of nodes (rounded up to a power of
    two); by default it follows from the counted rows.  Equal tables shuffle no rows.
    """
    first = max(1, (buckets - 1).bit_length()) if buckets else None
    return DigestTree(source, target, key, columns, first, **options).differences()


def diff_sample(differences: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` differing keys in key order."""
    return differences.orderBy(*key).limit(n)


def fingerprint_parity(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] | None = None,
    *,
    name: str = "target",
    labels: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Digest check and, with ``key``, a check that counts and names differing keys.

    With a key, one pass folds both tables to the first level of a digest tree,
    from which the table digests and the unequal nodes follow; further passes read
    only the latter.
    """
    labels = dict(labels or {})
    if key:
        tree = DigestTree(source, target, key, columns, **options)
        digests = canon.finish_digest(tree.parts.groupBy("_side").agg(*canon.folded_digest_columns()), "_side")
    else:
        digests = _two_sides(canon.fingerprint(source, columns, **options), canon.fingerprint(target, columns, **options))
    empty = F.expr(canon.EMPTY_DIGEST_SQL)
    both = digests.agg(
        F.coalesce(_pick(0, "digest"), empty).alias("src"), F.coalesce(_pick(1, "digest"), empty).alias("tgt")
    )
    checks = as_checks(
        both,
        "fingerprint_parity",
        target=F.lit(name),
        status=verdict(F.col("src") == F.col("tgt")),
        message=F.when(F.col("src") == F.col("tgt"), "same digest on both sides").otherwise("digests differ"),
        expected=F.col("src"),
        actual=F.col("tgt"),
        **labels,
    )
    if not key:
        return checks
    found = durable(tree.differences(), "differences")
    first = found.orderBy(*key).limit(10).select(F.struct(*key, canon.canon_row(found, key).alias("text")).alias("k"))
    names = first.agg(F.concat_ws(", ", F.transform(F.array_sort(F.collect_list("k")), lambda k: k.getField("text"))))
    total = found.agg(F.count(F.lit(1)).alias("n")).withColumn("first", names.scalar())
    return checks.unionByName(
        as_checks(
            total.where(F.col("n") > 0),
            "fingerprint_parity",
            target=F.lit(f"{name} (localized)"),
            status=F.lit(FAIL),
            message=F.concat(F.col("n").cast("string"), F.lit(" differing keys: "), F.col("first")),
            expected=F.lit("0"),
            actual=F.col("n"),
            metrics={"differing_keys": F.col("first")},
            **labels,
        )
    )


# -- multisets and result sets -------------------------------------------------


def _with_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with a NULL column for every name it lacks."""
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in names if c not in df.columns])


def multiset_diff(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Rows whose multiplicity differs: ``row_text, difference, copies``.

    ``difference`` is ``missing`` (more copies on the left) or ``unexpected``.
    A column absent from one side counts as NULL there.  Row hashes are netted
    first, repeated rows combined before the shuffle; only rows of an unequal hash
    are then written out as text.
    """
    names = list(columns) if columns else sorted({*left.columns, *right.columns})
    sides = [(_with_all(df, names), sign) for df, sign in ((left, 1), (right, -1))]
    hashed = [canon.with_row_hashes(df, names, **options).withColumn("_sign", F.lit(sign)) for df, sign in sides]
    net = hashed[0].unionByName(hashed[1]).groupBy("h1", "h2").agg(F.sum("_sign").alias("_net")).where("_net != 0")
    net = durable(net, "unequal")
    texts = []
    for df, _ in sides:
        full = df.select(canon.canon_row(df, names, **options).alias("row_text"))
        texts.append(canon.with_text_hashes(full, "row_text").join(net, ["h1", "h2"], "left_semi").distinct())
    found = texts[0].unionByName(texts[1]).distinct().join(net, ["h1", "h2"])
    return found.select(
        "row_text",
        F.when(F.col("_net") > 0, "missing").otherwise("unexpected").alias("difference"),
        F.abs("_net").alias("copies"),
    )


def multiset_counts(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """One row, ``missing, unexpected``: copies on the left only and on the right only."""
    names = list(columns) if columns else sorted({*left.columns, *right.columns})
    hashed = [
        canon.with_row_hashes(_with_all(df, names), names, **options).withColumn("_sign", F.lit(sign))
        for df, sign in ((left, 1), (right, -1))
    ]
    net = hashed[0].unionByName(hashed[1]).groupBy("h1", "h2").agg(F.sum("_sign").alias("_net"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return net.agg(
        count(F.when(F.col("_net") > 0, F.col("_net"))).alias("missing"),
        count(F.when(F.col("_net") < 0, -F.col("_net"))).alias("unexpected"),
    )


def query_parity(
    source: DataFrame,
    target: DataFrame,
    mode: str = "rowset",
    tolerance: str | float = "0",
    *,
    name: str = "query",
    labels: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Compare two query results: as a multiset of rows, or as one value."""
    labels = dict(labels or {})
    if mode == "scalar":
        cells = []
        for df in (source, target):
            dtype, value = df.schema.fields[0].dataType, F.col(f"`{df.columns[0]}`")
            text = _digits(value, dtype) if isinstance(dtype, T.NumericType) else value.cast("string")
            cells.append(df.agg(F.max(text).alias("v"), F.count(F.lit(1)).alias("n")))
        both = _two_sides(*cells).agg(*[_pick(i, c).alias(f"{c}{i}") for i in (0, 1) for c in ("v", "n")])
        # A query of other than one row has no scalar; its row count stands in for the value.
        shown = [F.when(F.col(f"n{i}") == 1, F.col(f"v{i}")).otherwise(F.concat(F.col(f"n{i}").cast("string"), F.lit(" rows"))) for i in (0, 1)]
        both = both.select(shown[0].alias("src"), shown[1].alias("tgt"), (F.col("n0") + F.col("n1") == 2).alias("single"))
        src, tgt = F.col("src").try_cast("double"), F.col("tgt").try_cast("double")
        close = F.coalesce(_within(src, tgt, F.col("src"), F.col("tgt"), allowed(tolerance, src)), F.lit(False))
        ok = F.col("single") & (close | F.col("src").eqNullSafe(F.col("tgt")))
    else:
        names = sorted({*source.columns, *target.columns})
        prints = []
        for df in (source, target):
            prints.append(canon.fingerprint(_with_all(df, names), names, **options))
        both = _two_sides(*prints).agg(_pick(0, "digest").alias("src"), _pick(1, "digest").alias("tgt"))
        ok = F.col("src") == F.col("tgt")
    return as_checks(
        both,
        "query_parity",
        target=F.lit(name),
        status=verdict(ok),
        message=F.concat(F.lit(f"{mode} "), F.when(ok, "match").otherwise("mismatch")),
        expected=F.col("src"),
        actual=F.col("tgt"),
        **labels,
    )


def keyed_compare(source: DataFrame, target: DataFrame, key: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per key: ``n_source, n_target``, ``duplicated`` and each column's value on both sides.

    ``columns`` maps source column to target column; the output has
    ``source_<c>`` and ``target_<c>`` per source column ``c``.  A key absent
    from the target yields NULL there.  A key with several rows on a side has no
    one value to compare: it is ``duplicated``, a finding of its own, and its
    values are NULL on that side.
    """
    left = source.select(
        *key, F.lit(0).alias("_side"), *[F.col(s).alias(f"source_{s}") for s in columns],
        *[F.lit(None).cast(target.schema[t].dataType).alias(f"target_{s}") for s, t in columns.items()],
    )
    right = target.select(
        *key, F.lit(1).alias("_side"), *[F.lit(None).cast(source.schema[s].dataType).alias(f"source_{s}") for s in columns],
        *[F.col(t).alias(f"target_{s}") for s, t in columns.items()],
    )
    values = [f"{side}_{s}" for s in columns for side in ("source", "target")]
    both = left.unionByName(right).groupBy(*key).agg(
        F.count_if(F.col("_side") == 0).alias("n_source"),
        F.count_if(F.col("_side") == 1).alias("n_target"),
        *[F.max(v).alias(v) for v in values],
    )
    alone = lambda v: F.when(F.col("n_source" if v.startswith("source_") else "n_target") <= 1, F.col(v)).alias(v)
    return both.select(
        *key, "n_source", "n_target", ((F.col("n_source") > 1) | (F.col("n_target") > 1)).alias("duplicated"), *[alone(v) for v in values]
    )
