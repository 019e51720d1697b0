"""Sources and sinks: the given tables written in a format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import query, table
from cohortloom import fixed_values as fv
from cohortloom.functions.scalars import zero_pad
from cohortloom.operators.reports import status_totals
from cohortloom.operators.rows import running_count
from cohortloom.operators.slots import SLOT_FIELDS
from cohortloom.session import scratch_path
from cohortloom.sources import readers, sinks

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@query(
    "snapshot_read",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS snapshot_year
       FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus IN ('F', 'O')""",
)
def snapshot_read(spark, sf):
    path = scratch_path(spark, "order_snapshots")
    dated = table(spark, sf, "orders").withColumn("snapshot_year", F.year("o_orderdate")).drop("o_orderdate")
    sinks.table_persist(dated, path, ["snapshot_year"])
    return readers.snapshot_read(
        spark, path, "1998", F.col("o_orderstatus").isin("F", "O"), date_column="snapshot_year"
    ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "snapshot_year")


@query("sheet_read", "SELECT * FROM customer")
def sheet_read(spark, sf):
    path = scratch_path(spark, "customer_sheet")
    sinks.csv_write(table(spark, sf, "customer"), path)
    return readers.sheet_read(spark, path, _schema(CUSTOMER))


@query(
    "delimited_read",
    """SELECT p_partkey AS part_id, p_name AS label, p_brand AS brand, p_type AS kind, p_size AS size,
              p_retailprice AS price FROM part""",
)
def delimited_read(spark, sf):
    path = scratch_path(spark, "part_tab")
    table(spark, sf, "part").write.csv(path, sep="\t", header=True)
    schema = _schema(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    )
    return readers.delimited_read(spark, path, schema, ["part_id", "label", "brand", "kind", "size", "price"])


@query(
    "json_array_read",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS type,
              CAST(c_nationkey AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS pronouns FROM customer""",
)
def json_array_read(spark, sf):
    """Documents of at most 500 records each, one file per document."""
    path = scratch_path(spark, "directory")
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("type"),
        F.col("c_nationkey").cast("string").alias("location"),
    )
    documents = (
        table(spark, sf, "customer")
        .groupBy(F.floor(F.col("c_custkey") / 500).alias("document"))
        .agg(F.collect_list(record).alias("data"))
        .select("document", F.to_json(F.struct("data"), {"pretty": "true"}).alias("text"))
    )
    documents.write.partitionBy("document").text(path)
    return readers.json_array_read(spark, path)


@query("csv_write", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_write(spark, sf):
    path = scratch_path(spark, "orders_csv")
    sinks.csv_write(table(spark, sf, "orders"), path, drop=["o_custkey", "o_orderdate"])
    schema = _schema("o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")
    return spark.read.csv(path, header=True, schema=schema)


@query(
    "sheet_write",
    """SELECT 'customers' AS sheet, c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier""",
)
def sheet_write(spark, sf):
    sheets = {
        "customers": table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "suppliers": table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    }
    paths = sinks.sheet_write(sheets, scratch_path(spark, "sheets"))
    schema = _schema("id bigint, name string")
    parts = [
        readers.sheet_read(spark, path, schema).select(F.lit(name).alias("sheet"), "id", "name")
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "table_persist",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
       FROM lineitem""",
)
def table_persist(spark, sf):
    kept = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return sinks.table_persist(kept, scratch_path(spark, "lines"), ["l_returnflag"])


# Orders as enrollment records: the priority gives the status, the order itself fills slot 1.
_LETTER = {"1-URGENT": "F", "2-HIGH": "Q", "3-MEDIUM": "H", "4-NOT SPECIFIED": "L", "5-LOW": "W"}
_LETTER_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LETTER.items()) + " END"


def _records(spark, sf):
    text = {
        "cipcode": F.col("o_custkey").cast("string"),
        "prg_start": F.date_format("o_orderdate", "yyyyMMdd"),
        "prg_stat": F.col("o_orderstatus"),
    }
    filled = F.struct(*[text.get(f, F.lit(None).cast("string")).alias(f) for f in SLOT_FIELDS])
    blank = F.struct(*[F.lit(None).cast("string").alias(f) for f in SLOT_FIELDS])
    letter = F.create_map(*[F.lit(x) for pair in _LETTER.items() for x in pair])
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("emplid"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("last_name"),
        letter[F.col("o_orderpriority")].alias("academic_load_nslc"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("status_dt_nslc"),
        F.array(filled, *[blank] * (fv.SLOT_COUNT - 1)).alias("slots"),
    )


@query(
    "fixed_width_write",
    f"""WITH rec AS (
          SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Customer ' || o_custkey AS last_name, {_LETTER_SQL} AS letter,
                 strftime(o_orderdate, '%Y%m%d') AS day, CAST(o_custkey AS VARCHAR) AS code, o_orderstatus AS status
          FROM orders)
        SELECT 'A3' AS record_type, 'A300297200' || rpad('Summer 1998', 15, ' ') || 'N19980731F' AS line
        UNION ALL
        SELECT 'D1', 'D1' || repeat(' ', 30) || rpad(last_name, 20, ' ') || repeat(' ', 34) || letter || day
               || repeat(' ', 324) || rpad(id, 50, ' ') || repeat(' ', 205)
               || rpad(code, 6, ' ') || repeat(' ', 19) || day || ' ' || status || repeat(' ', 8) || repeat(' ', 215)
        FROM rec
        UNION ALL
        SELECT 'T1', 'T1' || printf('%06d%06d%06d%06d%06d', count(*) FILTER (letter = 'F'),
                 count(*) FILTER (letter = 'Q'), count(*) FILTER (letter = 'H'), count(*) FILTER (letter = 'L'),
                 count(*) FILTER (letter = 'W')) || '000000' || '000000' || '000000' || '000000'
               || printf('%08d', count(*) + 2)
        FROM rec""",
)
def fixed_width_write(spark, sf):
    path = scratch_path(spark, "enrollment_file")
    sinks.fixed_width_write(sinks.enrollment_lines(_records(spark, sf), "Summer 1998", "19980731"), path)
    written = spark.read.text(path)
    return written.select(F.substring("value", 1, 2).alias("record_type"), F.col("value").alias("line"))


@query("zero_pad", "SELECT o_orderkey, printf('%06d', o_custkey) AS six, printf('%08d', o_orderkey) AS eight FROM orders")
def zero_pad_query(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", zero_pad("o_custkey", 6).alias("six"), zero_pad("o_orderkey", 8).alias("eight")
    )


@query(
    "status_totals",
    "SELECT "
    + ", ".join(f"count(*) FILTER (letter = '{k}') AS {name}" for k, name in fv.STATUS_TOTALS)
    + f", count(*) + 2 AS total_records FROM (SELECT {_LETTER_SQL} AS letter FROM orders)",
)
def status_totals_query(spark, sf):
    return status_totals(_records(spark, sf), "academic_load_nslc")


@query(
    "running_count",
    """SELECT o_orderkey, o_orderdate::DATE AS day, 2 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS running_count
       FROM orders""",
)
def running_count_query(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return running_count(rows, ["day", "o_orderkey"], start=2)
