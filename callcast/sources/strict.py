"""Strict CSV scan: the MapReduce mappers' row rules, kept on Spark.

The mappers keep a line only when it has exactly 17 fields, strip each
field, skip lines whose key or value field is blank, and crash on a value
that is not a number.  Here:

* width is checked by the CSV reader itself (PERMISSIVE mode puts a line with
  too few or too many fields into ``_corrupt_record``);
* fields are trimmed, blanks become NULL;
* numbers are parsed with ``try_cast``: a bad number sends the row to the
  quarantine frame instead of failing the job.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.schema import BANK_SCHEMA, CONTACT_COLUMNS

_BAD = "_corrupt_record"


def scan_strict(
    spark: SparkSession, path: str, required: Sequence[str] = ("job", "balance")
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) frames of a header CSV in the 17-column layout.

    ``clean`` has the typed schema; rows missing a ``required`` field are
    skipped (as the mappers do).  ``quarantine`` holds the raw line or fields
    and a ``reason`` (``width``, ``bad_number``).
    """
    text_schema = T.StructType([T.StructField(n, T.StringType(), True) for n in CONTACT_COLUMNS] + [T.StructField(_BAD, T.StringType(), True)])
    # Lines are parsed with from_csv against the full schema: the file scan's
    # CSV column pruning would otherwise skip the width check for columns a
    # query does not read.  Header lines (one per file) are dropped by value.
    header = ",".join(CONTACT_COLUMNS)
    lines = spark.read.text(path).where((F.trim(F.col("value")) != header) & (F.length(F.trim(F.col("value"))) > 0))
    parsed = F.from_csv(F.col("value"), text_schema.simpleString(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    # The generator is a barrier for the optimizer: without it the reason below would be pushed under the projection and
    # every field in it would parse the line anew.
    raw = lines.select(F.explode(F.array(parsed)).alias("r")).select("r.*")
    text = {c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in CONTACT_COLUMNS}
    typed, bad_number = [], F.lit(False)
    for f in BANK_SCHEMA.fields:
        if isinstance(f.dataType, T.StringType):
            typed.append(text[f.name].alias(f.name))
        else:
            cast = text[f.name].try_cast(f.dataType)
            typed.append(cast.alias(f.name))
            bad_number = bad_number | (text[f.name].isNotNull() & cast.isNull())
    flagged = raw.withColumn("reason", F.when(F.col(_BAD).isNotNull(), F.lit("width")).when(bad_number, F.lit("bad_number")))
    complete = F.lit(True)
    for c in required:
        complete = complete & text[c].isNotNull()
    clean = flagged.where(F.col("reason").isNull() & complete).select(*typed)
    return clean, flagged.where(F.col("reason").isNotNull()).select(*CONTACT_COLUMNS, _BAD, "reason")
