"""Typing: text to declared types, with the rows that do not fit set apart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

FAILED = "_failed_columns"


# A type that holds more than those whose names begin so, to tell a rounded value by.
WIDER = {
    "decimal": "decimal(38,18)",
    "tinyint": "decimal(38,18)",
    "smallint": "decimal(38,18)",
    "int": "decimal(38,18)",
    "bigint": "decimal(38,18)",
    "float": "double",
    "date": "timestamp_ntz",
}


def unfit(name: str, to: str, lossy: bool = False) -> Column:
    """Whether a value is present but is not of type ``to``, or only after losing digits or time.

    ``lossy=True`` lets ``1.239`` become a ``decimal(18,2)`` of 1.24.
    """
    value, cast = F.col(name), F.col(name).try_cast(to)
    wider = WIDER.get(to.partition("(")[0].strip().lower())
    failed = value.isNotNull() & cast.isNull()
    if lossy or wider is None:
        return failed
    return failed | F.coalesce(value.try_cast(wider) != cast.try_cast(wider), F.lit(False))


def failed_columns(
    types: Mapping[str, str], invalid: Mapping[str, Column] | None = None, lossy: bool = False
) -> Column:
    """Names of the columns whose value is present but does not fit the declared type.

    ``invalid`` adds conditions of the caller, each under the name of the column it blames.
    """
    failures = {name: unfit(name, to, lossy) for name, to in types.items()}
    for name, condition in (invalid or {}).items():
        failures[name] = failures[name] | condition if name in failures else condition
    return F.concat_ws(",", *[F.when(failed, F.lit(name)) for name, failed in failures.items()])


def with_failures(
    df: DataFrame,
    types: Mapping[str, str],
    invalid: Mapping[str, Column] | None = None,
    lossy: bool = False,
) -> DataFrame:
    """Every row with the names of its failed columns, so that one scan can serve both outputs."""
    return df.withColumn(FAILED, failed_columns(types, invalid, lossy))


def accepted(checked: DataFrame, types: Mapping[str, str]) -> DataFrame:
    kept = checked.where(F.col(FAILED) == "").drop(FAILED)
    return kept.withColumns({name: F.col(name).try_cast(to) for name, to in types.items()})


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(FAILED) != "").withColumnRenamed(FAILED, "failed_columns")


def typed(df: DataFrame, types: Mapping[str, str], lossy: bool = False) -> DataFrame:
    """Accepted rows with the declared types."""
    return accepted(with_failures(df, types, lossy=lossy), types)


def rejects(df: DataFrame, types: Mapping[str, str], lossy: bool = False) -> DataFrame:
    """Rejected rows as they came in, with ``failed_columns``, a list separated by commas."""
    return rejected(with_failures(df, types, lossy=lossy))
