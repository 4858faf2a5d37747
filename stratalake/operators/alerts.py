"""Filter for run events that somebody has to be told about."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The states that count as a failure of a pipeline run and of a job run.
PIPELINE_FAILURES = ("FAILED", "TIMED_OUT", "ABORTED")
JOB_FAILURES = ("FAILED", "TIMEOUT", "ERROR")


@dataclass(frozen=True)
class Rule:
    """All named columns must hold one of the listed values."""

    name: str
    where: Mapping[str, Sequence[str]]

    def condition(self) -> Column:
        tests = [F.col(column).isin(list(values)) for column, values in self.where.items()]
        return reduce(lambda a, b: a & b, tests)


def match_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per event and matching rule, with the rule's name. Batch or stream, one scan."""
    conditions = [rule.condition() for rule in rules]
    names = [F.when(c, F.lit(rule.name)) for rule, c in zip(rules, conditions)]
    some = df.where(reduce(lambda a, b: a | b, conditions))
    return some.withColumn("rule", F.explode(F.array(*names))).where(F.col("rule").isNotNull())


def failure_rules(source: str, status: str, pipeline: str, job: str) -> list[Rule]:
    """The two standing rules, for the column names and source names of an event table."""
    return [
        Rule("pipeline_failure", {source: [pipeline], status: PIPELINE_FAILURES}),
        Rule("job_failure", {source: [job], status: JOB_FAILURES}),
    ]
