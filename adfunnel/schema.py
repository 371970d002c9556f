"""Table schemas.

Unsigned integer types of the original tables map to the next wider signed
Spark type (UInt32 -> bigint, UInt16 -> int); UInt64 ids map to bigint in two's
complement (an id of 2^63 or more is stored as id - 2^64 and written out unsigned).
Timestamps are ``timestamp_ntz`` in whole seconds: the data carries no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 22 stored event columns in load (TSV) order, with types.
EVENT_FIELDS: list[tuple[str, T.DataType]] = [
    ("uid", T.LongType()),
    ("sec", T.TimestampNTZType()),
    ("expid", T.LongType()),
    ("tn", T.ByteType()),
    ("sn", T.ByteType()),
    ("stn", T.ByteType()),
    ("ref", T.StringType()),
    ("sid", T.LongType()),
    ("sz", T.LongType()),
    ("bref", T.StringType()),
    ("geo", T.IntegerType()),
    ("ipint", T.LongType()),
    ("pz", T.IntegerType()),
    ("bt", T.IntegerType()),
    ("ad", T.LongType()),
    ("net", T.LongType()),
    ("exppr", T.DoubleType()),
    ("winexppr", T.DoubleType()),
    ("secondpr", T.DoubleType()),
    ("floor", T.DoubleType()),
    ("ddid", T.LongType()),
    ("custom", T.StringType()),
]

# The UInt64 columns.
UNSIGNED_64 = ("uid", "expid", "sid")

EVENT_COLUMNS = [name for name, _ in EVENT_FIELDS]
EVENT_TYPES = dict(EVENT_FIELDS)

# Columns defaulted when missing: every stored column except the user and time.
STRING_DEFAULTED = ["ref", "bref", "custom"]
NUMERIC_DEFAULTED = [c for c in EVENT_COLUMNS if c not in ("uid", "sec", *STRING_DEFAULTED)]

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])

# Columns stored at load time next to the 22 fields (derived) plus the hour key.
DERIVED_EVENT_COLUMNS = ["dom", "refhash", "d", "h"]

# Funnel (one exposure per slot) columns in table order.
FUNNEL_FIELDS: list[tuple[str, T.DataType]] = [
    ("uid", T.LongType()),
    ("expid", T.LongType()),
    ("tn", T.ByteType()),
    ("sec", T.TimestampNTZType()),
    ("delta30", T.IntegerType()),
    ("delta01", T.IntegerType()),
    ("ref", T.StringType()),
    ("sid", T.LongType()),
    ("sz", T.LongType()),
    ("bref", T.StringType()),
    ("geo", T.IntegerType()),
    ("ipint_bid", T.LongType()),
    ("ipint_exp", T.LongType()),
    ("ipint_cl", T.LongType()),
    ("bt", T.IntegerType()),
    ("d", T.DateType()),
]
FUNNEL_COLUMNS = [name for name, _ in FUNNEL_FIELDS]
FUNNEL_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in FUNNEL_FIELDS])

SSP_SCHEMA = T.StructType([
    T.StructField("sid", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("d", T.DateType(), True),
])

# Event type codes (tn) and the accepted status (sn).
TN_IMPRESSION = 0
TN_CLICK = 1
TN_BID = 3
SN_OK = 0

# User groups, shards and lifecycle limits.
USER_GROUPS = 256
SHARD_GROUPS = {1: (1, 128), 2: (129, 256)}
RETENTION_DAYS = 14
FILL_CAP_DAYS = 21
BACKFILL_DAYS = 13
