"""Data-quality checks over one DataFrame.

Value checks and the bounds ignore nulls (``not_null`` is there for those), and ``unique`` ignores
keys with a null, both as in SQL constraints. ``failed_rows`` counts the rows that break a check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.operators.clean import drop_missing_keys


class CheckResult(NamedTuple):
    name: str
    passed: bool
    failed_rows: int
    detail: str


class DataQualityError(Exception):
    """At least one check failed; ``results`` has all of them."""

    def __init__(self, results: Sequence[CheckResult]):
        self.results = list(results)
        failed = [f"{r.name}: {r.detail}" for r in self.results if not r.passed]
        super().__init__("; ".join(failed))


class _RowCheck(NamedTuple):
    """A check that one aggregate decides, together with all others of its kind."""

    name: str
    failed_rows: Column
    detail: Column


class _UniqueCheck(NamedTuple):
    name: str
    keys: tuple[str, ...]


class Deviation(NamedTuple):
    """A column that is not as declared; a type is null where there is none."""

    column: str
    problem: str
    expected: str | None
    actual: str | None

    def __str__(self) -> str:
        if self.actual is None:
            return f"{self.column} is absent"
        if self.expected is None:
            return f"{self.column} is not declared"
        return f"{self.column} is {self.actual} instead of {self.expected}"


def deviations(
    df: DataFrame, expected: Mapping[str, str], allow_extra_columns: bool = True
) -> list[Deviation]:
    """Columns whose type, absence or presence is not as declared: the declared ones in their
    order, then the others in theirs."""
    actual = dict(df.dtypes)
    found = []
    for column in expected | actual:
        declared, given = expected.get(column), actual.get(column)
        if given is None:
            found.append(Deviation(column, "absent", declared, None))
        elif declared is None:
            if not allow_extra_columns:
                found.append(Deviation(column, "undeclared", None, given))
        elif given != declared:
            found.append(Deviation(column, "type", declared, given))
    return found


def schema_deviations(
    df: DataFrame, expected: Mapping[str, str], allow_extra_columns: bool = True
) -> DataFrame:
    """``(column, problem, expected, actual)``, one row per deviating column; reads no data."""
    return df.sparkSession.createDataFrame(
        deviations(df, expected, allow_extra_columns),
        "column string, problem string, expected string, actual string",
    )


class QualityChecker:
    """Collects checks on a DataFrame and evaluates them together.

    Everything but ``unique`` is one aggregate over one scan of the columns involved; each
    ``unique`` adds a scan of its key columns with a partial count before the shuffle.
    """

    def __init__(self, df: DataFrame):
        self._df = df
        self._checks: list[_RowCheck | _UniqueCheck] = []

    def _rows_where(self, name: str, broken: Column, what: str) -> QualityChecker:
        failed = F.count_if(broken)
        detail = F.when(failed > 0, F.concat(failed.cast("string"), F.lit(f" rows {what}")))
        self._checks.append(_RowCheck(name, failed, F.coalesce(detail, F.lit(""))))
        return self

    def not_null(self, column: str) -> QualityChecker:
        return self._rows_where(f"not_null({column})", F.col(column).isNull(), "are null")

    def value_in_set(self, column: str, values: Sequence[Any]) -> QualityChecker:
        outside = F.col(column).isNotNull()
        if values:
            outside &= ~F.col(column).isin(list(values))
        return self._rows_where(f"value_in_set({column})", outside, "are outside the set")

    def min_value(self, column: str, bound: Any) -> QualityChecker:
        below = F.col(column) < F.lit(bound)
        return self._rows_where(f"min_value({column})", below, f"are below {bound}")

    def max_value(self, column: str, bound: Any) -> QualityChecker:
        above = F.col(column) > F.lit(bound)
        return self._rows_where(f"max_value({column})", above, f"are above {bound}")

    def row_count_min(self, rows: int) -> QualityChecker:
        """At least ``rows`` rows; ``failed_rows`` is the number that lack."""
        count = F.count(F.lit(1))
        lacking = F.greatest(F.lit(rows).cast("bigint") - count, F.lit(0).cast("bigint"))
        detail = F.when(
            lacking > 0, F.concat(count.cast("string"), F.lit(f" rows, at least {rows} expected"))
        )
        self._checks.append(
            _RowCheck(f"row_count_min({rows})", lacking, F.coalesce(detail, F.lit("")))
        )
        return self

    def unique(self, *keys: str) -> QualityChecker:
        """No two rows share a key; ``failed_rows`` counts all rows that do."""
        self._checks.append(_UniqueCheck(f"unique({','.join(keys)})", keys))
        return self

    def schema_match(
        self, expected: Mapping[str, str], allow_extra_columns: bool = True
    ) -> QualityChecker:
        """Columns and types by ``simpleString``; with a wrong schema every row fails."""
        problems = "; ".join(map(str, deviations(self._df, expected, allow_extra_columns)))
        # An empty table with a wrong schema has no failed row, so at least one is reported.
        rows = F.greatest(F.count(F.lit(1)), F.lit(1).cast("bigint"))
        failed = rows if problems else F.lit(0).cast("bigint")
        self._checks.append(_RowCheck("schema_match", failed, F.lit(problems)))
        return self

    def _fused(self, checks: Sequence[tuple[int, _RowCheck]]) -> DataFrame:
        results = F.array(
            *[
                F.struct(
                    F.lit(position).alias("position"),
                    F.lit(check.name).alias("name"),
                    check.failed_rows.alias("failed_rows"),
                    check.detail.alias("detail"),
                )
                for position, check in checks
            ]
        )
        return self._df.agg(results.alias("results")).select(F.inline("results"))

    def _repeated(self, position: int, check: _UniqueCheck) -> DataFrame:
        keys = list(check.keys)
        rows = drop_missing_keys(self._df.select(*keys), keys)
        groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        failed = F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")
        detail = F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" rows share a key")))
        return groups.where("_n > 1").agg(
            F.lit(position).alias("position"),
            F.lit(check.name).alias("name"),
            failed.alias("failed_rows"),
            F.coalesce(detail, F.lit("")).alias("detail"),
        )

    def run(self) -> DataFrame:
        """``(name, passed, failed_rows, detail)``, one row per check, in the order added."""
        numbered = list(enumerate(self._checks))
        in_one_pass = [(i, c) for i, c in numbered if isinstance(c, _RowCheck)]
        parts = [self._repeated(i, c) for i, c in numbered if isinstance(c, _UniqueCheck)]
        if in_one_pass:
            parts.insert(0, self._fused(in_one_pass))
        if not parts:
            raise ValueError("no checks were added")
        report = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            report = report.orderBy("position")
        return report.select(
            "name", (F.col("failed_rows") == 0).alias("passed"), "failed_rows", "detail"
        )

    def assert_all_passed(self) -> list[CheckResult]:
        """Evaluate now; raise ``DataQualityError`` if a check failed."""
        results = [CheckResult(*row) for row in self.run().collect()]
        if not all(result.passed for result in results):
            raise DataQualityError(results)
        return results
