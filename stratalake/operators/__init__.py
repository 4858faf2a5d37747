from stratalake.operators.alerts import Rule, failure_rules, match_rules
from stratalake.operators.clean import clean, drop_missing_keys, latest_per_key, normalise_text
from stratalake.operators.conform import conform, conform_union
from stratalake.operators.denormalise import Dimension, denormalise
from stratalake.operators.maintenance import (
    compaction_plan,
    expired_snapshots,
    list_files,
    orphan_files,
    unreachable_files,
    with_expiry,
)
from stratalake.operators.payload import extract_payload
from stratalake.operators.quality import CheckResult, DataQualityError, QualityChecker
from stratalake.operators.summary import daily_summary
from stratalake.operators.typed import accepted, rejected, rejects, typed, with_failures

__all__ = [
    "CheckResult",
    "DataQualityError",
    "Dimension",
    "QualityChecker",
    "Rule",
    "accepted",
    "clean",
    "compaction_plan",
    "conform",
    "conform_union",
    "daily_summary",
    "denormalise",
    "drop_missing_keys",
    "expired_snapshots",
    "extract_payload",
    "failure_rules",
    "latest_per_key",
    "list_files",
    "match_rules",
    "normalise_text",
    "orphan_files",
    "rejected",
    "rejects",
    "typed",
    "unreachable_files",
    "with_expiry",
    "with_failures",
]
