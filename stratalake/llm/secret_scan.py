"""Secret scans over a ledger of blobs that have been scanned."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.files import exists
from stratalake.llm.common import columns_of, map_batches, new_names, values

LEDGER = "blob string, rules array<string>, findings array<struct<kind:string,start:long,end:long,rule:string>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if the text of ``group`` has ``least`` characters.

    Raise ``version`` when a rule changes: blobs are then scanned again for this rule alone.
    ``needs``: characters of which any match contains one, to pass over other texts quickly.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    flags: int = 0
    version: int = 1
    needs: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        if self.needs and not any(c in text for c in self.needs):
            return []
        return [
            found.span()
            for found in compiled.finditer(text)
            if found.end(self.group) - found.start(self.group) >= self.least
        ]


# The base kinds, in the order in which equal starts are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        flags=re.IGNORECASE | re.ASCII,
        needs=":=",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),  # whole runs, so the same as filtering them
)
# A key goes to its END line; without one, to the end of its headers and base64: pieces of 16
# characters or more however they are separated, or padded, and whole lines of any length.
_LINE = r"[ \t]*(?:\r?\n|\r|\\r\\n|\\n)[ \t>]*"
_BETWEEN = r"""(?:[\s>|"',]|\\[nrt])*+"""
_PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,40}PRIVATE KEY-----|"
    rf"(?:(?:{_LINE}[A-Z][A-Za-z]*-[A-Z][A-Za-z-]*:[^\r\n\\]*)+(?:{_LINE}(?={_LINE}))?)?"
    rf"(?:{_BETWEEN}(?:[A-Za-z0-9+/]{{16,}}+={{0,2}}|[A-Za-z0-9+/]+={{1,2}})|"
    rf"""{_LINE}[A-Za-z0-9+/]++={{0,2}}(?=[ \t]*(?:[\r\n"']|\\[rn]|\Z)))*)"""
)
MORE = (
    Rule("private_key", _PRIVATE_KEY, version=2, needs="-"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"(?<![A-Za-z0-9+.-])[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", needs="@"),
)
RULES = BASE + MORE


def _read_ledger(spark, path: str) -> DataFrame:
    if not exists(spark, path):
        # Not from a list, which Spark reads in Python workers of another pool and then keeps those.
        return spark.range(0).select(F.from_json(F.lit("{}"), LEDGER).alias("row")).select("row.*")
    return spark.read.schema(LEDGER).parquet(path)


def _scan(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules, findings) of texts and the rules they have not been scanned for."""

    def scan(batches):
        ready = {rule.key: (rule, re.compile(rule.pattern, rule.flags)) for rule in rules}
        for batch in batches:
            findings = []
            wanted = batch.column("rules").to_pylist()
            for text, keys in zip(values(batch, "text"), wanted, strict=True):
                text = text.decode()
                findings.append(
                    [
                        {"kind": ready[key][0].kind, "start": start, "end": end, "rule": key}
                        for key in keys
                        for start, end in ready[key][0].spans(text, ready[key][1])
                    ]
                )
            finding = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("rule", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("rules"), pa.array(findings, pa.list_(finding))],
                names=["blob", "rules", "findings"],
            )

    return todo.select("blob", "rules", "text").mapInArrow(scan, LEDGER)


def scan_history(
    versions: DataFrame, ledger: str, *, path: str = "path", version: str = "version", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(path, version, blob, findings) for every row of ``versions`` (path, version, text).

    A text is a blob, named by the SHA-256 of its UTF-8 bytes. ``ledger`` is a folder in the shared
    store with one row for each blob and the rules it was scanned for in a run; blobs that have
    seen every rule in its present version are not scanned again, others only for the rules they
    lack. A run appends to the ledger in one step, so one that dies is simply repeated.

    ``findings`` are (kind, start, end) by start and then the order of ``rules``, code points, end
    exclusive. Only findings of the present rules in their present versions are returned, and each
    once. Findings of ledgers that do not name the rule are of the one that their row has for their kind.
    Null texts count as empty. Repeated rows come out repeated; null paths and versions are kept.
    Other columns are ignored.
    """
    spark = versions.sparkSession
    rows = versions.select(
        F.col(path).alias("path"), F.col(version).alias("version"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("blob", F.sha2("text", 256))
    known = _read_ledger(spark, ledger)
    seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    present = F.array(*(F.lit(rule.key) for rule in rules))
    lacking = F.array_except(present, F.coalesce("seen", F.array().cast("array<string>")))
    # One row of each blob brings its text; the others travel as names only.
    first = (
        rows.groupBy("blob")
        .agg(F.min(F.struct("path", "version")).alias("first"))
        .join(seen, "blob", "left")
        .select("blob", "first", lacking.alias("rules"))
        .where(F.size("rules") > 0)
    )
    todo = rows.join(
        first.withColumnRenamed("blob", "new"),
        (F.col("blob") == F.col("new"))
        & F.col("path").eqNullSafe(F.col("first.path"))
        & F.col("version").eqNullSafe(F.col("first.version")),
    )
    _scan(todo, rules).write.mode("append").parquet(ledger)

    order = F.array(*(F.lit(rule.kind) for rule in rules))
    of_row = lambda kind: F.get(F.filter("rules", lambda key: F.regexp_replace(key, "@[0-9]+$", "") == kind), 0)
    is_present = lambda x: F.array_contains(present, F.coalesce(x["rule"], of_row(x["kind"])))
    findings = (
        _read_ledger(spark, ledger)
        .where(F.size("findings") > 0)
        .select("blob", F.transform(F.filter("findings", is_present), lambda x: x.dropFields("rule")).alias("findings"))
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("all"))
        .select(
            "blob",
            F.sort_array(
                F.transform("all", lambda x: F.struct(x["start"], F.array_position(order, x["kind"]), x["end"], x["kind"]))
            ).alias("sorted"),
        )
        .select(
            "blob",
            F.transform("sorted", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings"),
        )
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.select("path", "version", "blob").join(findings, "blob", "left").select(
        "path", "version", "blob", F.coalesce("findings", none).alias("findings")
    )


def joined_spans(findings):
    """``kind:start:end`` of findings, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def redact(documents: DataFrame, found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` with ``mark`` in place of the findings in ``text``; spans that overlap or touch
    become one mark. ``found``: what ``scan_history`` returned for these texts. ``n_chars``, if there
    is such a column, follows. Other columns and null texts stay as they are."""
    blob, spans = new_names(documents, "blob", "spans")
    blobs = (
        found.where(F.size("findings") > 0)
        .select(F.col("blob").alias(blob), F.col("findings").alias(spans))
        .dropDuplicates([blob])
    )
    rows = documents.withColumn(blob, F.sha2(F.coalesce("text", F.lit("")), 256))
    joined = rows.join(blobs, blob, "left").drop(blob)
    names = documents.columns

    def replace(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, findings in enumerate(batch.column(spans).to_pylist()):
                if findings and texts[i] is not None:
                    text, parts, done = texts[i], [], 0
                    for start, end in sorted((x["start"], x["end"]) for x in findings):
                        if start > done or not parts:
                            parts += [text[done:start], mark]
                        done = max(done, end)
                    texts[i] = "".join([*parts, text[done:]])
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    touched = map_batches(joined.where(F.col(spans).isNotNull()), replace, documents.schema)
    if "n_chars" in names:
        size = F.length("text").cast(documents.schema["n_chars"].dataType)
        touched = touched.withColumn("n_chars", size)
    return joined.where(F.col(spans).isNull()).select(columns_of(documents)).unionByName(touched)
