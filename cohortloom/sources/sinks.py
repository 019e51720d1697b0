"""Writers: csv, parquet tables and the fixed-width enrollment file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.scalars import zero_pad
from cohortloom.operators.reports import status_totals
from cohortloom.operators.slots import SLOT_FIELDS


def csv_write(df: DataFrame, path: str, drop: list[str] | None = None) -> None:
    """Comma-separated export with a header, identifying columns dropped."""
    df.drop(*(drop or [])).write.csv(path, header=True, mode="overwrite")


def sheet_write(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One export per table, each in a folder of its own; returns the paths."""
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        csv_write(df, paths[name])
    return paths


def table_persist(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Save as a parquet table and return the saved table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def fixed_width(values: dict[str, Column], starts: dict[str, int], length: int) -> Column:
    """One line: every field padded or cut to the columns up to the next field."""
    names = sorted(starts, key=starts.get)
    ends = [starts[n] for n in names[1:]] + [length + 1]
    parts = [F.lit(" " * (starts[names[0]] - 1))] if starts[names[0]] > 1 else []
    for name, end in zip(names, ends, strict=True):
        parts.append(F.rpad(F.coalesce(values[name].cast("string"), F.lit("")), end - starts[name], " "))
    return F.concat(*parts)


def slot_text(slots: Column) -> Column:
    """All slots of a record side by side, each field padded to its place."""
    starts = {field: offset + 1 for field, offset in fv.SLOT_LAYOUT.items()}
    return F.array_join(
        F.transform(slots, lambda slot: fixed_width({f: slot[f] for f in SLOT_FIELDS}, starts, fv.SLOT_WIDTH)), ""
    )


def trailer_line(totals: DataFrame) -> DataFrame:
    """The trailer from the one row of status totals."""
    width = fv.TRAILER_COUNT_WIDTH
    parts = [F.lit(fv.TRAILER_RECORD)]
    for letter, name in fv.STATUS_TOTALS:
        if letter == "D":
            parts.append(F.lit(fv.TRAILER_ZEROS))
        parts.append(zero_pad(name, width))
    parts.append(zero_pad("total_records", fv.TRAILER_RECORDS_WIDTH))
    return totals.select(F.concat(*parts).alias("line"))


def enrollment_lines(records: DataFrame, term: str, certification_date: str, key: str = "emplid") -> DataFrame:
    """Header, detail lines in key order, and trailer: one column ``line``.

    ``records`` has the detail columns (absent ones are left blank) and the
    array ``slots``.  Header and trailer come out for empty input too.  The
    records are sorted by range before they are turned into lines, and the
    union keeps header, details and trailer in this order.
    """
    spark = records.sparkSession
    values: dict[str, Column] = {}
    for name in fv.DETAIL_LAYOUT:
        values[name] = F.col(name) if name in records.columns else F.lit(None).cast("string")
    values["record_type"] = F.lit(fv.DETAIL_RECORD)
    person = fixed_width(values, fv.DETAIL_LAYOUT, fv.SLOT_FIRST_COLUMN - 1)
    programs = F.rpad(slot_text(F.col("slots")), fv.DETAIL_LENGTH - fv.SLOT_FIRST_COLUMN + 1, " ")
    detail = records.orderBy(key).select(F.concat(person, programs).alias("line"))
    header_values = {
        "record_type": F.lit(fv.HEADER_RECORD), "school_code": F.lit(fv.SCHOOL_CODE), "branch_code": F.lit(fv.BRANCH_CODE),
        "term": F.lit(term), "standard_flag": F.lit(fv.STANDARD_FLAG), "certification_date": F.lit(certification_date),
        "reporting_level": F.lit(fv.REPORTING_LEVEL),
    }
    header = spark.range(1, numPartitions=1).select(
        fixed_width(header_values, fv.HEADER_LAYOUT, fv.HEADER_LENGTH).alias("line")
    )
    trailer = trailer_line(status_totals(records, "academic_load_nslc"))
    return header.unionByName(detail).unionByName(trailer)


def fixed_width_write(lines: DataFrame, path: str) -> None:
    """Write the ordered lines as text parts; read in name order they are the file."""
    lines.write.mode("overwrite").text(path)
