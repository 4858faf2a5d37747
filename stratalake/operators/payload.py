"""Fields of a JSON text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def extract_payload(
    df: DataFrame, column: str, schema: str, *, malformed: str | None = None, drop: bool = True
) -> DataFrame:
    """Add one column per field of ``schema``; malformed or missing text gives nulls.

    ``malformed`` names one more column, which holds the text where it could not be parsed.

    ``inline`` keeps the parsed fields as columns of their own: a later filter on them is not
    merged with the parsing, which would parse the text again for every use of a field.
    """
    if malformed:
        options = {"columnNameOfCorruptRecord": malformed}
        parsed = F.from_json(F.col(column), f"{schema}, {malformed} string", options)
    else:
        parsed = F.from_json(F.col(column), schema)
    frame = df.select("*", F.inline(F.array(parsed)))
    return frame.drop(column) if drop else frame
