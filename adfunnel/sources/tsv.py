"""Tab-separated event files: hour key from a path, dump and load.

The dump has the 22 stored fields in load order, no header and no quoting;
cleaning has removed tabs, newlines and quotes from the strings beforehand.
The loader reads every field as text and parses it with ``try_cast``, so a
value that does not fit its column (an id of 2^64 or more, a type code of 300,
a broken line) sends the row to the reject output instead of failing the job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema

# Hour key in a path or string, the first run of
# yyyy ?? mm ?? dd ?? hh digit groups (?? = one or more non-digits).
HOUR_KEY_PATTERN = r"(\d\d\d\d)\D+(\d\d)\D+(\d\d)\D+(\d\d)"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt_record"
NULL_TOKEN = "\\N"


def hour_key(text: Column) -> Column:
    """timestamp_ntz of the hour named in a path; NULL when absent or invalid."""
    parts = [F.regexp_extract(text, HOUR_KEY_PATTERN, i) for i in range(1, 5)]
    found = parts[0] != ""
    # make_timestamp_ntz raises on month 13 under ANSI; try_ gives NULL
    ts = F.try_make_timestamp_ntz(*[p.cast("int") for p in parts], F.lit(0), F.lit(0))
    return F.when(found, ts)


def with_source_hour(df: DataFrame, column: str = "src_hour") -> DataFrame:
    """Hour key of the file each row was read from (``_metadata.file_path``)."""
    return df.withColumn(column, hour_key(F.col("_metadata.file_path")))


def _two_to_64() -> Column:
    return F.lit(Decimal(2 ** 64))


def parse_unsigned(text: Column) -> Column:
    """Digits of a UInt64 -> bigint in two's complement; NULL when out of range or not a number.

    Up to 18 digits, as nearly all ids, take a plain cast; only longer ones go through decimals."""
    digits = (text != "") & (F.translate(text, "0123456789", "") == "")
    n = text.try_cast("decimal(20,0)")
    wrapped = F.when(n > F.lit(Decimal(2 ** 63 - 1)), n - _two_to_64()).otherwise(n)
    return (F.when(digits & (F.length(text) <= 18), text.try_cast("bigint"))
            .when(digits & (n < _two_to_64()), wrapped.try_cast("bigint")))


def unsigned_text(value: Column) -> Column:
    """bigint in two's complement -> digits of the UInt64."""
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, (wide + _two_to_64()).cast("string")).otherwise(value.cast("string"))


def line_of() -> Column:
    """The 22 stored fields as one tab-separated line: values as they are, NULL as nothing."""
    def text(name: str, t: T.DataType) -> Column:
        c = F.col(name)
        if isinstance(t, T.TimestampNTZType):
            c = F.date_format(c, TIME_FORMAT)
        elif name in schema.UNSIGNED_64:
            c = unsigned_text(c)
        return F.coalesce(c.cast("string"), F.lit(""))

    return F.concat_ws("\t", *[text(n, t) for n, t in schema.EVENT_FIELDS])


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write the 22 stored fields as tab-separated text, no header, no quoting, no trimming."""
    df.select(line_of().alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def split_lines(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """One text line per row -> the 22 fields as text, plus ``_corrupt_record``
    holding the line when it does not have exactly 22 fields (+ ``keep`` columns).

    The line is split once, in a projection of its own that the optimizer leaves alone (its
    column is read many times)."""
    lines = lines.withColumn("_parts", F.split(F.col(value_col), "\t", -1))
    parts = F.col("_parts")
    n = len(schema.EVENT_COLUMNS)

    def field(i: int):
        v = F.get(parts, i)
        return F.when(v != NULL_TOKEN, v)  # \N is NULL (then the field's default)

    return lines.select(
        *[field(i).alias(c) for i, c in enumerate(schema.EVENT_COLUMNS)],
        F.when(F.size(parts) != n, F.col(value_col)).alias(CORRUPT), *keep)


def read_tsv_raw(spark: SparkSession, path: str) -> DataFrame:
    """All 22 fields as text.  Lines end at ``\n`` only (a carriage return is data)."""
    return split_lines(spark.read.option("lineSep", "\n").text(path))


def parse_flagged(raw: DataFrame, keep=()) -> DataFrame:
    """Typed events of ``split_lines`` output with ``_bad`` (to be rejected) and ``_corrupt_record``.

    A non-empty field that does not parse, or a wrong field count, rejects the
    row.  Empty numeric fields take their default (0) right here, the value the
    cleaning step would give them; ``uid`` and ``sec`` stay NULL when empty so
    the cleaning step can reject the row.

    Defaulting in the same expression also keeps planning linear: were the
    typed columns the bare ``try_cast`` terms of the reject filter, Spark's
    constraint propagation would double its constraint set once per aliased
    term (2^20 sets for 20 fields).
    """
    typed = []
    bad = F.col(CORRUPT).isNotNull()
    for name, t in schema.EVENT_FIELDS:
        raw_c = F.col(name)
        if isinstance(t, T.StringType):
            typed.append(raw_c.alias(name))
            continue
        parsed = parse_unsigned(raw_c) if name in schema.UNSIGNED_64 else raw_c.try_cast(t)
        bad = bad | (raw_c.isNotNull() & (raw_c != "") & parsed.isNull())
        value = parsed if name in ("uid", "sec") else F.coalesce(parsed, F.lit(0).cast(t))
        typed.append(value.alias(name))
    return raw.select(*typed, bad.alias("_bad"), F.col(CORRUPT), *keep)


def parse_raw(raw: DataFrame, keep=()) -> tuple[DataFrame, DataFrame]:
    """Typed events and rejects of ``split_lines`` output."""
    flagged = parse_flagged(raw, keep)
    good = flagged.where(~F.col("_bad")).drop("_bad", CORRUPT)
    rejects = flagged.where(F.col("_bad")).drop("_bad")
    return good, rejects


def read_tsv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_raw(read_tsv_raw(spark, path))
