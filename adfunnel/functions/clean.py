"""Cleaning of raw events, in the order of the original loader.

1. strip characters that break the tab-separated format from ref, bref, custom
2. replace missing values by defaults (0 / '') for every field but user and time
3. repair the scheme of refs of two sites that log them without one

Rows without a user or a time cannot be keyed; ``split_rejects`` sends them to
a reject output instead of loading them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema

# Characters removed from strings (newline, tab, single quote,
# double quote, backslash; a carriage return stays).
BREAKING_CHARS = "\n\t'\"\\"

# Sites whose refs arrive without a scheme.
SCHEMELESS_SITE = 197671         # prefix http:// when "://" is absent (also to '')
GOOGLE_SITE = 187537             # prefix http:// when the ref ends with ".google"
GOOGLE_SUFFIX = ".google"
SCHEME_PREFIX = "http://"


def strip_breaking(c: Column) -> Column:
    """Delete newline, tab, quotes and backslash (``translate`` without regex)."""
    return F.translate(c, BREAKING_CHARS, "")


def repair_scheme(ref: Column, sid: Column) -> Column:
    """Add ``http://`` to refs of the two scheme-less sites (after defaults)."""
    prefixed = F.concat(F.lit(SCHEME_PREFIX), ref)
    return (F.when((sid == SCHEMELESS_SITE) & ~ref.contains("://"), prefixed)
            .when((sid == GOOGLE_SITE) & ref.endswith(GOOGLE_SUFFIX), prefixed)
            .otherwise(ref))


def default_value(name: str) -> Column:
    t = schema.EVENT_TYPES[name]
    return F.lit("") if name in schema.STRING_DEFAULTED else F.lit(0).cast(t)


def fill_defaults(df: DataFrame) -> DataFrame:
    """NULL -> 0 for the 17 numeric fields and '' for the 3 strings; uid, sec untouched."""
    return df.select(*[
        F.coalesce(F.col(c), default_value(c)).alias(c)
        if c in schema.NUMERIC_DEFAULTED or c in schema.STRING_DEFAULTED else F.col(c)
        for c in df.columns
    ])


def clean(df: DataFrame) -> DataFrame:
    """Strip, default, repair: the three steps on a 22-column event frame."""
    stripped = df.select(*[
        strip_breaking(F.col(c)).alias(c) if c in schema.STRING_DEFAULTED else F.col(c)
        for c in df.columns
    ])
    filled = fill_defaults(stripped)
    return filled.withColumn("ref", repair_scheme(F.col("ref"), F.col("sid")))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with uid and sec, rows missing either)."""
    ok = F.col("uid").isNotNull() & F.col("sec").isNotNull()
    return df.where(ok), df.where(~ok)
