"""URL filters by rules and by a tree of path templates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``net/`` or ``example.net/en/``: a host with its subdomains, and how the path begins."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


@dataclass(frozen=True)
class TemplateTree:
    """``depth``: levels of the tree, what lies deeper is one ``**``. A node's segments are variable
    if there are at least ``fan_out`` of them and as many as ``variable`` of its pages. Branches are
    alike if their labelled shares differ by less than ``deviations`` standard errors. A template is
    rejected if its share of bad labels, with ``weight`` pages of the overall share added, is at
    least ``purity``. ``listed``: segments up to which the name of a merged branch lists them all;
    that of a wider one has the first of them and how many more there are."""

    depth: int = 6
    fan_out: int = 16
    variable: float = 0.05
    deviations: float = 1.96
    weight: float = 10.0
    purity: float = 0.5
    listed: int = 1000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def alike(share: np.ndarray, size: np.ndarray, deviations: float) -> np.ndarray:
    """Numbers of groups of branches, given in order of their shares; ``size``: pages behind each.

    A group is as long as none of its branches differs significantly from another. A branch is
    compared with those before it in its group, save those that an earlier one of no larger error
    stands for: whatever differs from them differs from that one too.
    """
    groups, group, firsts = np.zeros(len(share), np.int32), 0, []
    for i, (own, error) in enumerate(zip(share, share * (1 - share) / size, strict=True)):
        if any(own - other > deviations * np.sqrt(error + error_of) for other, error_of in firsts):
            group, firsts = group + 1, []
        if not firsts or error < firsts[-1][1]:
            firsts.append((own, error))
        groups[i] = group
    return groups


def _groups(bins: DataFrame, rate: float, tree: TemplateTree) -> DataFrame:
    """(host, __at, labelled, n_bad, branch) of the distinct counts of labels at each node."""

    def group(table: pa.Table) -> pa.Table:
        labelled, n_bad = (table.column(c).to_numpy() for c in ("labelled", "n_bad"))
        size = labelled + tree.weight
        share = (n_bad + rate * tree.weight) / size
        order = np.lexsort((labelled, share))
        branch = np.empty(len(order), np.int32)
        branch[order] = alike(share[order], size[order], tree.deviations)
        return table.append_column("branch", pa.array(branch))

    return bins.groupBy("host", "__at").applyInArrow(
        group, "host string, __at string, labelled long, n_bad long, branch int"
    )


def path_templates(pages: DataFrame, tree: TemplateTree) -> DataFrame:
    """``pages`` (host, path, bad) with ``template``; ``bad`` is true, false, or null if unlabelled.

    Level by level, all hosts at once: numbers in a segment become ``#``; the segments below a node
    become ``*`` if the node's are variable; the others are ordered by their smoothed share of bad
    labels and put together, ``{de|en}``, as far as no two of them differ significantly (``alike``).
    In names the characters ``\\ { } | * +`` of a segment have a backslash before them, so different
    branches of a node have different names.
    Branches with the same counts of labels and bad labels always go together, so a task merges the
    distinct counts of a node: of n labelled pages there are at most about n ** (2 / 3), however
    many branches there are.
    """
    # With a backslash before what names are made of, no segment looks like a name.
    shape = F.regexp_replace(F.regexp_replace(F.col("path"), "[0-9]+", "#"), r"([\\{}|*+])", r"\\$1")
    segments = F.filter(F.split(shape, "/"), lambda x: x != "")
    rows = pages.withColumn("__at", F.lit("")).withColumn(
        "__rest",
        F.when(F.size(segments) > tree.depth, F.concat(F.slice(segments, 1, tree.depth), F.array(F.lit("**")))).otherwise(
            segments
        ),
    )
    deepest = rows.agg(F.max(F.size("__rest"))).first()[0] or 0
    rate = rows.agg(F.avg(F.col("bad").cast("int"))).first()[0] or 0.0
    for level in range(1, deepest + 1):
        segment = F.element_at("__rest", level)
        here = F.size("__rest") >= level
        branches = staged(
            rows.where(here)
            .groupBy("host", "__at", segment.alias("__segment"))
            .agg(
                F.count("*").alias("pages"),
                F.count("bad").alias("labelled"),
                F.sum(F.coalesce(F.col("bad").cast("int"), F.lit(0))).alias("n_bad"),
            ),
            "url-branches",
        )
        nodes = branches.groupBy("host", "__at").agg(F.count("*").alias("fan"), F.sum("pages").alias("all"))
        variable = (F.col("fan") >= tree.fan_out) & (F.col("fan") >= F.col("all") * tree.variable)
        merging = branches.join(nodes.where(~variable).select("host", "__at"), ["host", "__at"])
        counts = ["host", "__at", "labelled", "n_bad"]
        groups = _groups(merging.select(counts).distinct(), rate, tree)
        merged = staged(merging.join(groups, counts).select("host", "__at", "branch", "__segment"), "url-merged")
        node = ["host", "__at", "branch"]
        sizes = merged.groupBy(node).agg(F.count("*").alias("size"), F.min("__segment").alias("first"))
        lists = (
            merged.join(sizes.where(F.col("size").between(2, tree.listed)).select(node), node)
            .groupBy(node)
            .agg(F.sort_array(F.collect_list("__segment")).alias("all"))
        )
        listed = F.coalesce(F.array_join("all", "|"), F.concat_ws("|+", "first", F.col("size") - 1))
        named = sizes.join(lists, node, "left").withColumn(
            "__name", F.when(F.col("size") == 1, F.col("first")).otherwise(F.concat(F.lit("{"), listed, F.lit("}")))
        )
        names = merged.join(named.select(*node, "__name"), node).drop("branch")
        rows = (
            rows.withColumn("__segment", F.when(here, segment))
            .join(names, ["host", "__at", "__segment"], "left")
            .withColumn("__at", F.when(here, F.concat("__at", F.lit("/"), F.coalesce("__name", F.lit("*")))).otherwise(F.col("__at")))
            .drop("__segment", "__name")
        )
        rows = staged(rows, "url-level")
    return rows.withColumnRenamed("__at", "template").drop("__rest")


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[UrlRule, ...], tree: TemplateTree = TemplateTree()
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of ``pages`` (page_id,
    url). ``labels``: (page_id, bad).

    The longest rule that fits decides; the path of a rule begins with ``/``, so a url without a path
    is under none. Pages without a rule are blocked if their template's smoothed share of bad labels
    reaches ``tree.purity``. Null urls and those without ``://`` have an empty
    host and path and one template of their own. Rows with null page_ids and repeated rows are
    judged like others; of contradicting labels of a page ``bad`` wins. Other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    longest_first = sorted(rules, key=lambda r: (-len(r.rule), r.rule))
    fitting = [F.when(r.fits(F.col("host"), F.col("path")), F.lit(r.rule)) for r in longest_first]
    fixed = F.create_map(*(F.lit(x) for r in rules for x in (r.rule, r.verdict))) if rules else None
    bad = labels.where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    judged = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("rule", F.coalesce(*fitting) if rules else F.lit(None).cast("string"))
        .join(bad, "page_id", "left")
    )
    placed = path_templates(staged(judged, "urls"), tree)
    rate = placed.agg(F.avg(F.col("bad").cast("int"))).first()[0] or 0.0
    purity = (F.sum(F.coalesce(F.col("bad").cast("int"), F.lit(0))) + rate * tree.weight) / (F.count("bad") + tree.weight)
    templates = placed.groupBy("host", "template").agg(purity.alias("purity"))
    by_template = F.when(F.col("purity") >= tree.purity, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(F.element_at(fixed, F.col("rule")), by_template) if rules else by_template
    return placed.join(templates, ["host", "template"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
