"""Cell functions: blanks, numbers, dates, categories."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.functions import arrays, cells
from cellsift.operators import normalize
from cellsift.spec import bank_spec


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def evaluate(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_blank_texts_become_null(spark):
    df = column(spark, ["a", " ", "\t ", " ", "", "\x1c", None, " b "])
    assert evaluate(df, cells.blank_to_null(F.col("x"))) == ["a", None, None, None, None, None, None, " b "]


def test_strip_takes_all_blanks(spark):
    df = column(spark, ["\t a b ", "c", None])
    assert evaluate(df, cells.strip(F.col("x"))) == ["a b", "c", None]


def test_numbers_are_read_strictly(spark):
    df = column(spark, ["12", " 12 ", "1e3", "12d", "nan", "abc", "inf", "1,000", "", "\t ", None, "-.5", "5."])
    got = evaluate(df, cells.to_number(F.col("x"), T.StringType()))
    assert got == [12.0, 12.0, 1000.0, None, None, None, None, None, None, None, None, -0.5, 5.0]


def test_nan_counts_as_missing(spark):
    df = column(spark, [1.0, float("nan"), None], "double")
    assert evaluate(df, cells.to_number(F.col("x"), T.DoubleType())) == [1.0, None, None]
    assert evaluate(df, cells.is_missing(F.col("x"), T.DoubleType())) == [False, True, True]


def test_missing_text_is_null_or_blank(spark):
    df = column(spark, ["a", " ", None])
    assert evaluate(df, cells.is_missing(F.col("x"), T.StringType())) == [False, True, True]


def test_dates_need_a_listed_format(spark):
    df = column(spark, ["2022-01-01", "01/02/2022", "2022-13-01", "x", "44562", None])
    iso = evaluate(df, cells.to_date(F.col("x"), T.StringType(), ("yyyy-MM-dd",)).cast("string"))
    assert iso == ["2022-01-01 00:00:00", None, None, None, None, None]
    serial = evaluate(df, cells.to_date(F.col("x"), T.StringType(), ("excel_serial",)).cast("string"))
    assert serial == [None, None, None, None, "2022-01-01 00:00:00", None]


def test_severity_bands_and_clamp(spark):
    df = column(spark, [1.0, 0.5, 0.2, 0.1999, None, 7.0], "double")
    assert evaluate(df, cells.severity_of(F.col("x"))) == ["critical", "high", "medium", "low", "low", "critical"]
    assert evaluate(df, cells.clamp(F.col("x")))[-1] == 1.0


def test_array_statistics(spark):
    df = spark.createDataFrame(
        [([3.0, 1.0, 2.0], ["b", "a"]), ([4.0, 1.0], ["b", "b", "a"]), ([], []), ([0.1] * 5, ["z"])],
        "v array<double>, t array<string>",
    ).withColumn("m", arrays.mean("v"))
    rows = df.select(
        "m", arrays.population_std("v", "m").alias("s"), arrays.median("v").alias("mid"), arrays.mode("t").alias("mode")
    ).collect()
    assert [r["mid"] for r in rows] == [2.0, 2.5, None, 0.1]
    assert [r["mode"] for r in rows] == ["a", "b", None, "z"]
    assert rows[0]["s"] == (2 / 3) ** 0.5
    assert rows[3]["m"] == 0.1 and rows[3]["s"] == 0.0


def test_bank_table_from_raw_text(spark):
    raw = spark.createDataFrame(
        [("2022-01-03", " restraunt ", " Paris ", "10", "4"), ("bad", None, " ", "x", "0")],
        "DATE string, DOMAIN string, LOCATION string, VALUE string, TRANSACTION_COUNT string",
    )
    rows = normalize.prepare_bank_table(raw, bank_spec()).orderBy("transaction_id").collect()
    first, second = rows
    assert first["transaction_id"] == "T00000000" and second["transaction_id"] == "T00000001"
    assert (first["domain"], first["location"], first["day_of_week"]) == ("RESTAURANT", "Paris", 0)
    assert first["avg_transaction_value"] == 2.5
    # A missing category stays missing and does not turn into a text.
    assert second["domain"] is None and second["location"] is None and second["date"] is None
    assert second["avg_transaction_value"] is None


def test_lower_case_date_wins_over_upper_case(spark):
    df = spark.createDataFrame([("a", "b")], "date string, X string").withColumnRenamed("X", "VALUE")
    assert normalize.rename_present(df, normalize.BANK_COLUMNS).columns == ["date", "value"]
