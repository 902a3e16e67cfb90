"""The contact table: schema, column presets and fixed lookup values."""

from __future__ import annotations

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values that must equal the reference's for the same results:
# the seventeen columns in file order, their types, and the numeric /
# categorical presets.
CONTACT_FIELDS = [
    ("age", IntegerType()),
    ("job", StringType()),
    ("marital", StringType()),
    ("education", StringType()),
    ("default", StringType()),
    ("balance", IntegerType()),
    ("housing", StringType()),
    ("loan", StringType()),
    ("contact", StringType()),
    ("day", IntegerType()),
    ("month", StringType()),
    ("duration", IntegerType()),
    ("campaign", IntegerType()),
    ("pdays", IntegerType()),
    ("previous", IntegerType()),
    ("poutcome", StringType()),
    ("y", StringType()),
]
NUMERIC_COLUMNS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
CATEGORICAL_COLUMNS = ["job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome"]
# End of fixed values.

CONTACT_COLUMNS = [name for name, _ in CONTACT_FIELDS]
STRING_COLUMNS = [name for name, t in CONTACT_FIELDS if isinstance(t, StringType)]

# The raw file layout (no id), as read from CSV.
BANK_SCHEMA = StructType([StructField(n, t, True) for n, t in CONTACT_FIELDS])

# Our tables carry an explicit row identity in front.
CONTACT_SCHEMA = StructType([StructField("contact_id", LongType(), True)] + list(BANK_SCHEMA.fields))

# Streamed contacts carry the event time.
STREAMING_SCHEMA = StructType(list(BANK_SCHEMA.fields) + [StructField("event_time", TimestampType(), True)])

# Feature presets: `duration` is only known after the call, so models meant for
# use before a call leave it out.
ALL_FEATURES = NUMERIC_COLUMNS + CATEGORICAL_COLUMNS
PRE_CALL_FEATURES = [c for c in ALL_FEATURES if c != "duration"]
