"""Tables that the registered queries work on, derived from the driver tables.

The SQL fragments run unchanged on Spark and on DuckDB, so query and check
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsift.operators.normalize import bank_features
from cellsift.operators.seed import seed_faults
from cellsift.sources.scratch import cut_lineage
from cellsift.spec import ColumnRule, QualitySpec, bank_spec

TRANSACTIONS_SQL = """
SELECT concat('T', lpad(concat('', o_orderkey), 8, '0')) AS transaction_id,
       o_orderdate AS date,
       o_orderpriority AS domain,
       n_name AS location,
       o_totalprice AS value,
       cast(coalesce(n_lines, 0) AS double) AS transaction_count,
       o_totalprice / nullif(cast(coalesce(n_lines, 0) AS double), 0) AS avg_transaction_value
FROM {orders}
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM {lineitem} GROUP BY l_orderkey) AS l
  ON l_orderkey = o_orderkey
LEFT JOIN {customer} ON c_custkey = o_custkey
LEFT JOIN {nation} ON n_nationkey = c_nationkey
"""

_DIGIT = "(instr('0123456789abcdef', substr(md5(concat('raw:', transaction_id)), {i}, 1)) - 1)"

# The transactions as text, with the faults a raw file may have.
RAW_SQL = f"""
SELECT transaction_id,
       CASE {_DIGIT.format(i=1)}
         WHEN 0 THEN concat(substr(day, 9, 2), '/', substr(day, 6, 2), '/', substr(day, 1, 4))
         WHEN 1 THEN '' WHEN 2 THEN 'x' WHEN 3 THEN concat(substr(day, 1, 4), '-13-01')
         ELSE day END AS DATE,
       CASE {_DIGIT.format(i=2)}
         WHEN 0 THEN '   ' WHEN 1 THEN chr(9) WHEN 2 THEN ''
         WHEN 3 THEN concat('  ', lower(domain), ' ') WHEN 4 THEN concat(chr(9), domain)
         WHEN 5 THEN 'restraunt ' ELSE domain END AS DOMAIN,
       CASE {_DIGIT.format(i=3)}
         WHEN 0 THEN concat(' ', location, '  ') WHEN 1 THEN 'NA' WHEN 2 THEN chr(160)
         WHEN 3 THEN concat(location, chr(160)) WHEN 4 THEN 'null' ELSE location END AS LOCATION,
       CASE {_DIGIT.format(i=4)}
         WHEN 0 THEN 'abc' WHEN 1 THEN concat(' ', amount, ' ') WHEN 2 THEN '12d' WHEN 3 THEN 'nan'
         WHEN 4 THEN '1,000' WHEN 5 THEN '1e3' WHEN 6 THEN '' WHEN 7 THEN '-5' WHEN 8 THEN '.5'
         ELSE amount END AS VALUE,
       concat('', cast(transaction_count AS int)) AS TRANSACTION_COUNT
FROM (SELECT *, cast(cast(date AS date) AS string) AS day, cast(value AS string) AS amount FROM {{tx}}) AS t
"""

# The raw table as lines of a file. Three of sixteen are damaged: a cell is lost, one
# too many, or the line breaks off where its second cell opens.
_LINE_CELLS = ("transaction_id", "DATE", "DOMAIN", "LOCATION", "VALUE", "TRANSACTION_COUNT")
_LINE = ", ',', ".join(f"'\"', coalesce({c}, ''), '\"'" for c in _LINE_CELLS)
LINES_SQL = f"""
SELECT *, CASE damage WHEN 0 THEN substr(line, 1, length(line) - length(TRANSACTION_COUNT) - 3)
            WHEN 1 THEN concat(line, ',"x"') WHEN 2 THEN substr(line, 1, 13) ELSE line END AS record,
       CASE damage WHEN 0 THEN 'too few cells' WHEN 1 THEN 'too many cells' WHEN 2 THEN 'open quote' END AS reason
FROM (SELECT *, instr('0123456789abcdef', substr(md5(concat('line:', transaction_id)), 1, 1)) - 1 AS damage,
             concat({_LINE}) AS line FROM {{raw}}) AS t
"""

# Product types with one character dropped, two swapped, or nothing like a type.
_PDIGIT = "(instr('0123456789abcdef', substr(md5(concat('typo:', p_partkey)), {i}, 1)) - 1)"
TYPO_SQL = f"""
SELECT concat('P', p_partkey) AS part_id,
       CASE {_PDIGIT.format(i=1)} % 4
         WHEN 0 THEN concat(substr(p_type, 1, place), substr(p_type, place + 2, 20))
         WHEN 1 THEN concat(substr(p_type, 1, place - 1), substr(p_type, place + 1, 1),
                            substr(p_type, place, 1), substr(p_type, place + 2, 20))
         WHEN 2 THEN concat('?', p_brand) ELSE p_type END AS kind,
       p_retailprice AS price
FROM (SELECT *, 1 + {_PDIGIT.format(i=2)} % 4 AS place FROM {{part}}) AS t
"""

# Labels of parts, most of them with a character dropped, two swapped or a word put in front.
_LDIGIT = "(instr('0123456789abcdef', substr(md5(concat('label:', p_partkey)), {i}, 1)) - 1)"
PART_LABEL = "concat(p_name, ' ', p_brand, ' ', p_type)"
LABEL_SQL = f"""
SELECT concat('P', p_partkey) AS row_id,
       CASE {_LDIGIT.format(i=1)} % 5
         WHEN 0 THEN concat(substr(label, 1, place), substr(label, place + 2, 60))
         WHEN 1 THEN concat(substr(label, 1, place - 1), substr(label, place + 1, 1),
                            substr(label, place, 1), substr(label, place + 2, 60))
         WHEN 2 THEN concat('new ', substr(label, 1, 6 + place), '-', p_partkey)
         WHEN 3 THEN concat('?', md5(label)) ELSE label END AS label
FROM (SELECT *, {PART_LABEL} AS label, 1 + {_LDIGIT.format(i=2)} AS place FROM {{part}}) AS t
"""

# A score that is known beforehand, in place of the forest's: big amounts and many lines are odd.
GIVEN_SCORE = "-(coalesce(abs(value), 0) / 500000 + coalesce(abs(transaction_count), 0) / 1000)"

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "customer", "nation")
    return spark.sql(TRANSACTIONS_SQL, **{n: table(spark, sf_dir, n) for n in names})


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_SQL, tx=transactions(spark, sf_dir))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINES_SQL, raw=raw_transactions(spark, sf_dir))


def typo_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TYPO_SQL, part=table(spark, sf_dir, "part"))


def labelled_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LABEL_SQL, part=table(spark, sf_dir, "part"))


def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labels that parts may have: thousands."""
    return table(spark, sf_dir, "part").select(F.expr(PART_LABEL).alias("label")).distinct()


def transactions_spec() -> QualitySpec:
    return bank_spec().with_rule("domain", allowed_values=PRIORITIES)


def seeded_transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return seed_faults(transactions(spark, sf_dir), transactions_spec(), rate=0.2)


_written: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def seeded_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Seeded table and labels as files, written once per application.

    Seeding is a job of its own whose files the detection job reads, so queries
    about detection start from files too. The average is derived again on read.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        dirty, labels = seeded_transactions(spark, sf_dir)
        columns = dirty.columns
        _written[key] = (
            cut_lineage(bank_features(dirty).select(*columns), "seeded_dirty_data"),
            cut_lineage(labels, "seeded_dirty_labels"),
        )
    return _written[key]


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_files(spark, sf_dir)[0]


def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_files(spark, sf_dir)[1]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def accounts_spec() -> QualitySpec:
    return QualitySpec(
        table_name="accounts",
        id_column="account_id",
        cross_field=(),
        rules={
            "account_id": ColumnRule("id", required=True, use_for_detection=False),
            "segment": ColumnRule("categorical", required=True),
            "balance": ColumnRule("numeric", required=True, min_value=0, max_value=9000),
        },
    )


def events_spec() -> QualitySpec:
    return QualitySpec(
        table_name="events",
        id_column="event_id",
        cross_field=(),
        rules={
            "event_id": ColumnRule("id", required=True, use_for_detection=False),
            "ts": ColumnRule("date", required=True, use_for_detection=False),
            "event_type": ColumnRule(
                "categorical", required=True, allowed_values=("click", "view", "purchase", "signup")
            ),
            "value": ColumnRule("numeric", required=True, max_value=150),
        },
    )


def parts_spec() -> QualitySpec:
    return QualitySpec(
        table_name="parts",
        id_column="part_id",
        cross_field=(),
        rules={
            "part_id": ColumnRule("id", required=True, use_for_detection=False),
            "kind": ColumnRule("categorical", required=True, allowed_values=PART_TYPES),
            "price": ColumnRule("numeric", required=True, min_value=0),
        },
    )


def lines_spec() -> QualitySpec:
    """Line items keyed by order, so that ids repeat."""
    return QualitySpec(
        table_name="lines",
        id_column="l_orderkey",
        cross_field=(),
        rules={
            "l_orderkey": ColumnRule("id", required=True, use_for_detection=False),
            "l_quantity": ColumnRule("numeric", required=True, min_value=3, max_value=48),
            "l_returnflag": ColumnRule("categorical", required=True, allowed_values=("A", "N")),
        },
    )
