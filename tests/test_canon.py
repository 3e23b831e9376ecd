from decimal import Decimal

from pyspark.sql import functions as F

from paritas.functions import canon


def texts(spark, *expressions, **options):
    df = spark.range(1).selectExpr(*[f"{e} AS c{i}" for i, e in enumerate(expressions)])
    row = df.select(*[canon.canon_value(c, df.schema[c].dataType, **options).alias(c) for c in df.columns]).first()
    return list(row)


def test_equal_numbers_share_their_text(spark):
    assert texts(spark, "1.50BD", "1.5D", "CAST(1.5 AS FLOAT)", "CAST(1.5 AS DECIMAL(20,9))") == ["1.5"] * 4
    assert texts(spark, "100", "100.00BD", "100D", "100L") == ["100"] * 4
    assert texts(spark, "0BD", "-0.0D", "0.0000001D", "CAST(0 AS DECIMAL(20,10))") == ["0"] * 4
    assert texts(spark, "-0.5D", "-0.50BD", "-12.25D") == ["-0.5", "-0.5", "-12.25"]
    assert texts(spark, "CAST('0.000000001' AS DECIMAL(38,12))") == ["0.000000001"]


def test_special_doubles_and_nulls_are_distinct(spark):
    found = texts(spark, "DOUBLE('NaN')", "DOUBLE('Infinity')", "DOUBLE('-Infinity')", "1e300D", "CAST(NULL AS DOUBLE)", "'__NULL__'", "''")
    assert len(set(found)) == len(found)
    assert found[4] == canon.NULL_TAG


def test_instants_are_utc_seconds(spark):
    assert texts(spark, "TIMESTAMP '2024-05-01 10:00:00.999'", "TIMESTAMP_NTZ '2024-05-01 10:00:00.1'") == ["2024-05-01 10:00:00"] * 2
    assert texts(spark, "DATE '2024-05-01'", "true", "X'0AFF'") == ["2024-05-01", "true", "0aff"]


def test_numeric_text_is_read_as_number_only_on_request(spark):
    assert texts(spark, "'12.50'", "'+7'", "'abc'") == ["12.50", "+7", "abc"]
    assert texts(spark, "'12.50'", "'+7'", "'abc'", "'007'", coerce_numeric_strings=True) == ["12.5", "7", "abc", "7"]


def test_nested_values(spark):
    a, b = texts(spark, "named_struct('b', 1, 'a', 2.50BD)", "named_struct('a', 2.5D, 'b', 1L)")
    assert a == b == "{a:3#2.5,b:1#1}"
    a, b = texts(spark, "map('y', 1, 'x', 2)", "map('x', 2, 'y', 1)")
    assert a == b
    assert texts(spark, "array(1.50BD, NULL)") == [f"[3#1.5,{len(canon.NULL_TAG)}#{canon.NULL_TAG}]"]


def test_separators_inside_nested_values_do_not_collide(spark):
    a, b = texts(spark, "array('a,b')", "array('a', 'b')")
    assert a != b
    a, b = texts(spark, "map('x', 'y,z:w')", "map('x', 'y', 'z', 'w')")
    assert a != b


def test_numeric_text_of_any_length(spark):
    long = "1" * 45
    assert texts(spark, f"'{long}.50'", "'1.5000000000'", "'-000.000'", "'0001'", coerce_numeric_strings=True) == [f"{long}.5", "1.5", "0", "1"]


def test_fingerprint_ignores_order_but_not_multiplicity(spark):
    rows = [(i, Decimal(i) / 4, f"n{i % 7}") for i in range(500)]
    schema = "id int, amount decimal(12,2), name string"
    df = spark.createDataFrame(rows, schema)
    digest = lambda d: canon.fingerprint(d, ["id", "amount", "name"]).first()["digest"]
    base = digest(df)
    assert digest(df.orderBy(F.desc("id")).repartition(7)) == base
    assert digest(df.withColumn("amount", F.col("amount").cast("double"))) == base
    assert digest(df.unionByName(df.limit(1))) != base
    assert digest(df.unionByName(df.limit(1)).unionByName(df.limit(1))) != base  # an even number of copies
    assert digest(df.where("id != 77")) != base
    empty = canon.fingerprint(df.where("false"), ["id"]).first()
    assert (empty["n"], empty["sum1"], empty["xor1"]) == (0, 0, 0)


def test_piece_sums_rebuild_the_exact_sum(spark):
    df = spark.range(2000).selectExpr("CAST(id AS STRING) AS t")
    hashed = canon.with_row_hashes(df, ["t"])
    exact = hashed.selectExpr("sum(CAST(h1 AS DECIMAL(28,0))) AS a", "sum(CAST(h2 AS DECIMAL(28,0))) AS b").first()
    found = canon.fingerprint(df, ["t"]).first()
    assert (found["sum1"], found["sum2"]) == (exact["a"], exact["b"])
