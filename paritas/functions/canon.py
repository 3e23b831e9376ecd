"""Canonical text of a row and the digests built on it.

Two copies of a table agree when their rows have the same canonical text, even
if one stores ``1.50`` as a decimal and the other ``1.5`` as a double, or one
keeps microseconds that the other dropped.  Everything here is a Spark SQL
expression, so it runs inside whole-stage code generation; the expressions are
built as text, because one wide row is thousands of Column calls otherwise.

Text per value: NULL gets a tag no ordinary string starts with; numbers are
plain digits without trailing zeros (floating point rounded to
``float_decimals`` places first); instants are UTC to the second; binary is
lower-case hex; arrays, structs and maps are bracketed, the latter two sorted
by name, and every value inside is preceded by its length, so that no separator
in a value can be taken for one between values.  The separator between the
values of a row, and the sign the NULL tag starts with, are escaped where they
occur in a value.  Semi-structured values (VARIANT, and text read as JSON) are
written with sorted keys and plain numbers, whatever order and spelling they had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SEPARATOR = "\x1f"
NULL_TAG = "\x1e__NULL__"
FLOAT_DECIMALS = 6

_SEPARATOR_SQL, _NULL_SQL = "chr(31)", "concat(chr(30), '__NULL__')"


def _float_text(c: str, places: int) -> str:
    # Kept short on purpose: a wide row's generated method must stay small
    # enough for the JVM to compile it.  NaN, infinities and magnitudes beyond
    # the decimal's range have no decimal value and keep their own text.
    digits = f"CAST(try_cast({c} AS DECIMAL(38,{places})) AS STRING)"
    return f"coalesce({_trim_fraction(digits) if places else digits}, CAST({c} AS STRING))"


def _trim_fraction(text: str) -> str:
    """Drop trailing zeros of a text known to have a decimal point."""
    return f"rtrim('.', rtrim('0', {text}))"


def _escaped(text: str) -> str:
    """``text`` without the separator and without the sign a NULL tag starts with; other text is unchanged."""
    return f"replace(replace({text}, chr(30), concat(chr(30), 'e')), chr(31), concat(chr(30), 's'))"


#: Parts of JSON as it is written out: strings, numbers, and everything between them.
_JSON_PARTS = r'"(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|[^"0-9-]+|-'


def variant_text(value: str) -> str:
    """SQL text of a VARIANT's canonical form: keys sorted, numbers in plain digits without needless zeros."""
    # A number in plain digits keeps them all; one with an exponent goes through the widest decimal that holds it.
    plain = "rtrim('.', rtrim('0', if(instr(p, '.') > 0, p, concat(p, '.'))))"
    wide = "rtrim('.', rtrim('0', CAST(try_cast(p AS DECIMAL(38,18)) AS STRING)))"
    exact = f"try_cast({wide} AS DOUBLE) <=> try_cast(p AS DOUBLE)"
    number = f"if(p RLIKE '[eE]', if({exact}, {wide}, upper(p)), {plain})"
    number = f"if({number} = '-0', '0', {number})"
    parts = f"regexp_extract_all(to_json({value}), r'{_JSON_PARTS}', 0)"
    return f"if(is_variant_null({value}), 'null', array_join(transform({parts}, p -> if(p RLIKE '^-?[0-9]', {number}, p)), ''))"


def json_text(c: str) -> str:
    """SQL text of the canonical form of JSON kept as text; text that is no JSON stays as it is."""
    return f"coalesce({variant_text(f'try_parse_json({c})')}, {c})"


def _numeric_string(c: str) -> str:
    # Any number of digits: signs and zeros that say nothing are cut from the text itself.
    plain = f"regexp_replace(regexp_replace(trim({c}), '^[+]', ''), '^(-?)0+(?=[0-9])', '$1')"
    short = f"regexp_replace(regexp_replace({plain}, '([.][0-9]*?)0+$', '$1'), '[.]$', '')"
    return f"if(trim({c}) RLIKE '^[+-]?[0-9]+([.][0-9]+)?$', if({short} = '-0', '0', {short}), {c})"


def canon_sql(
    c: str,
    dtype: T.DataType,
    *,
    float_decimals: int = FLOAT_DECIMALS,
    coerce_numeric_strings: bool = False,
    json: bool = False,
    _depth: int = 0,
) -> str:
    """SQL text of the canonical form of expression ``c`` of type ``dtype``; ``json`` reads text as JSON."""

    def inner(value: str, value_type: T.DataType) -> str:
        text = bare(value, value_type)
        return f"concat(length({text}), '#', {text})"

    def bare(value: str, value_type: T.DataType) -> str:
        return canon_sql(
            value,
            value_type,
            float_decimals=float_decimals,
            coerce_numeric_strings=coerce_numeric_strings,
            _depth=_depth + 1,
        )

    item = f"_v{_depth}"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = _float_text(c if isinstance(dtype, T.DoubleType) else f"DOUBLE({c})", float_decimals)
    elif isinstance(dtype, T.DecimalType):
        text = f"CAST({c} AS STRING)" if dtype.scale == 0 else _trim_fraction(f"CAST({c} AS STRING)")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
    elif isinstance(dtype, T.BinaryType):
        text = f"lower(hex({c}))"
    elif isinstance(dtype, T.ArrayType):
        text = f"concat('[', array_join(transform({c}, {item} -> {inner(item, dtype.elementType)}), ','), ']')"
    elif isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name.lower())
        pairs = ", ".join(f"concat('{f.name.lower()}:', {inner(f'{c}.`{f.name}`', f.dataType)})" for f in fields)
        text = f"if({c} IS NULL, NULL, concat('{{', concat_ws(',', {pairs}), '}}'))"
    elif isinstance(dtype, T.MapType):
        pair = f"concat({inner(f'{item}.key', dtype.keyType)}, ':', {inner(f'{item}.value', dtype.valueType)})"
        text = f"concat('{{', array_join(array_sort(transform(map_entries({c}), {item} -> {pair})), ','), '}}')"
    elif isinstance(dtype, T.VariantType):
        text = variant_text(c)
    elif isinstance(dtype, T.StringType):
        text = json_text(c) if json else _numeric_string(c) if coerce_numeric_strings else c
    else:
        text = f"CAST({c} AS STRING)"
    if not _depth and isinstance(dtype, (T.StringType, T.VariantType)):  # nested text tells by its lengths where it ends
        text = _escaped(text)
    return f"coalesce({text}, {_NULL_SQL})"


def canon_value(name: str, dtype: T.DataType, **options) -> Column:
    """Canonical text of the column ``name``."""
    return F.expr(canon_sql(f"`{name}`", dtype, **options))


def canon_row_sql(df: DataFrame, columns: Sequence[str], json_columns: Sequence[str] = (), **options) -> str:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = ", ".join(canon_sql(f"`{c}`", types[c], json=c in json_columns, **options) for c in columns)
    return f"concat_ws({_SEPARATOR_SQL}, {parts})"


def canon_row(df: DataFrame, columns: Sequence[str], **options) -> Column:
    """Canonical text of the named columns, in the given order; ``json_columns`` name text to read as JSON."""
    return F.expr(canon_row_sql(df, columns, **options))


def _hash60(md5: str, start: int) -> str:
    """15 hex digits of an md5 text as a non-negative bigint."""
    return f"CAST(conv(substring({md5}, {start}, 15), 16, 10) AS BIGINT)"


def with_row_hashes(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), **options) -> DataFrame:
    """``keep`` columns plus ``h1`` and ``h2``, two independent 60-bit hashes of the row
    (md5 hex digits 1-15 and 16-30); md5 is evaluated once per row."""
    kept = [f"`{k}`" for k in keep]
    staged = df.selectExpr(*kept, f"md5({canon_row_sql(df, columns, **options)}) AS _md5")
    return staged.selectExpr(*kept, f"{_hash60('_md5', 1)} AS h1", f"{_hash60('_md5', 16)} AS h2")


def with_text_hashes(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the hashes of a row whose canonical text is in column ``text``."""
    staged = df.selectExpr("*", f"md5(`{text}`) AS _md5")
    return staged.selectExpr("* EXCEPT (_md5)", f"{_hash60('_md5', 1)} AS h1", f"{_hash60('_md5', 16)} AS h2")


HASH_BITS = 60


def key_node(df: DataFrame, key: Sequence[str], bits: int) -> Column:
    """The first ``bits`` bits of the 60-bit hash of a key's canonical text."""
    # Never NULL; saying so spares joins on it a second evaluation as a NULL filter.
    return F.expr(f"coalesce(shiftright({_hash60(f'md5({canon_row_sql(df, key)})', 1)}, {HASH_BITS - bits}), 0L)")


# A 60-bit hash is summed as three 20-bit pieces: each piece stays inside a
# bigint for 2**43 rows, and the aggregation buffer holds only longs, which is
# far cheaper than summing wide decimals.
_BITS = 20
PIECES = [f"s{h}{i}" for h in (1, 2) for i in range(3)]


def piece_sums(sign: str = "") -> list[Column]:
    """Aggregates ``s10..s12, s20..s22`` over ``h1`` and ``h2``; ``sign`` is an optional factor."""
    factor = f" * {sign}" if sign else ""
    return [
        F.expr(f"sum((shiftright(h{p[1]}, {_BITS * int(p[2])}) & {(1 << _BITS) - 1}){factor}) AS {p}") for p in PIECES
    ]


def _joined_sum(h: int) -> str:
    """The exact sum of a 60-bit hash from its three piece sums."""
    terms = [f"CAST(coalesce(s{h}{i}, 0) AS DECIMAL(20,0)) * CAST({1 << (_BITS * i)} AS DECIMAL(13,0))" for i in range(3)]
    return f"CAST({' + '.join(terms)} AS DECIMAL(38,0))"


def digest_columns() -> list[Column]:
    """Aggregates for one digest; finish with :func:`finish_digest`."""
    return [F.expr("count(1) AS n"), *piece_sums(), F.expr("bit_xor(h1) AS x1"), F.expr("bit_xor(h2) AS x2")]


def folded_digest_columns() -> list[Column]:
    """Aggregates that fold digests of parts, built from :func:`digest_columns`, into one."""
    return [F.expr(f"sum({c}) AS {c}") for c in ("n", *PIECES)] + [F.expr(f"bit_xor({x}) AS {x}") for x in ("x1", "x2")]


def finish_digest(aggregated: DataFrame, *group: str) -> DataFrame:
    """Columns ``n, sum1, sum2, xor1, xor2, digest`` of an aggregate built from :func:`digest_columns`."""
    parts = aggregated.selectExpr(
        *group,
        "n",
        f"{_joined_sum(1)} AS sum1",
        f"{_joined_sum(2)} AS sum2",
        "coalesce(x1, 0L) AS xor1",
        "coalesce(x2, 0L) AS xor2",
    )
    return parts.selectExpr("*", "md5(concat_ws('|', n, sum1, sum2, xor1, xor2)) AS digest")


EMPTY_DIGEST_SQL = "md5('0|0|0|0|0')"


def fingerprint(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """One row identifying the multiset of rows of ``df``, whatever their order."""
    return finish_digest(with_row_hashes(df, columns, **options).agg(*digest_columns()))
