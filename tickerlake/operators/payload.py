"""JSON payloads: parse with a fallback, then one row per array element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"

PEOPLE_SCHEMA = StructType([
    StructField("number", IntegerType()),
    StructField("people", ArrayType(StructType([
        StructField("craft", StringType()),
        StructField("name", StringType()),
    ]))),
])

# Fixed value: the greeting appended to every line.
GREETING = "Hello! :)"


def parse_payload(c, schema: StructType, fallback: Column | None = None) -> Column:
    """from_json that yields ``fallback`` for NULL or malformed text.

    Malformed input is detected through the corrupt-record field of a
    PERMISSIVE parse (a plain parse returns a struct of NULLs instead).
    """
    text = F.col(c) if isinstance(c, str) else c
    probe = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    parsed = F.from_json(text, probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    good = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
    bad = text.isNull() | parsed[CORRUPT].isNotNull()
    fb = fallback if fallback is not None else F.lit(None).cast(schema)
    return F.when(bad, fb).otherwise(good)


def explode_lines(df: DataFrame, payload: str = "payload", greeting: str = GREETING,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One line per person of the payload: ``<name> is currently in space flying on the <craft>! <greeting>``."""
    p = F.col(payload)
    return (df.select(*keep, F.size(p["people"]).alias("n_people"), p["number"].alias("number"),
                      F.posexplode(p["people"]).alias("pos", "person"))
            .select(*keep, "number", "n_people", F.col("pos").cast("bigint").alias("pos"),
                    F.concat(F.col("person.name"), F.lit(" is currently in space flying on the "),
                             F.col("person.craft"), F.lit("! "), F.lit(greeting)).alias("line")))
