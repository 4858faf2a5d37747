"""Rule statistics of texts, and an isolation forest over them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import mixed, staged, values, window_hashes, word_hashes

SEPARATORS = " \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
# Letters, digits, separators and what is not ASCII.
NO_MARKS = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum() or chr(c) in SEPARATORS)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks")


def count_rules(text: bytes) -> tuple[int, ...]:
    """The counts of COUNTS for one text."""
    words = text.split()
    decoded = text.decode()
    word_chars = len(decoded) - sum(map(decoded.count, SEPARATORS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) >= 3:
        windows = window_hashes(word_hashes(words), 3)
        order = np.argsort(windows)
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(words), bool)
        for offset in range(3):
            twice[order[1:][same] + offset] = True
            twice[order[:-1][same] + offset] = True
        repeated = int(twice.sum())
    return (
        len(words),
        word_chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(text.translate(None, NO_MARKS)),
    )


def rule_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of COUNTS for every row (doc_id, text); null texts count as empty.

    Words are runs without ASCII white space. ``n_dup_lines``: lines with a word that equal an
    earlier one. ``n_repeat_words``: words inside three-word windows that occur twice or more.
    ``n_marks``: ASCII characters that are no letter, digit or white space.
    """

    def count(batches):
        for batch in batches:
            rows = [count_rules(text) for text in values(batch, "text")]
            table = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(len(COUNTS)))],
                names=["doc_id", *COUNTS],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def features(counts: np.ndarray) -> np.ndarray:
    """Mean length of a word, and shares of symbols, repeated words and marks, for rows of COUNTS.

    Length and lines are left out: very short and very long texts are rare, but not bad.
    """
    words, chars, symbols, _, repeat, marks = counts.T.astype(float)
    chars, some = np.maximum(chars, 1), np.maximum(words, 1)
    return np.column_stack([chars / some, symbols / chars, repeat / some, marks / chars])


def _path_left(size: int) -> float:
    """Mean depth at which a random tree over ``size`` rows would tell one apart."""
    if size < 2:
        return 0.0
    return 2 * (np.log(size - 1) + 0.5772156649) - 2 * (size - 1) / size


@dataclass
class IsolationForest:
    """Trees of random splits. In ``nodes`` a row is (feature or -1, split, left, right, length)."""

    roots: list[int]
    nodes: np.ndarray
    usual: float

    @classmethod
    def fit(cls, rows: np.ndarray, *, trees: int = 200, rows_a_tree: int = 64, seed: int = 7) -> IsolationForest:
        random = np.random.default_rng(seed)
        size = min(rows_a_tree, len(rows))
        samples = [rows[random.choice(len(rows), size, replace=False)] if size else rows for _ in range(trees)]
        return cls.grown(samples, rows_a_tree=rows_a_tree, seed=seed)

    @classmethod
    def grown(cls, samples: list[np.ndarray], *, rows_a_tree: int, seed: int = 7) -> IsolationForest:
        """A tree on each of ``samples``, of at most ``rows_a_tree`` rows."""
        random = np.random.default_rng(seed)
        nodes: list[list[float]] = []
        most = int(np.ceil(np.log2(max(rows_a_tree, 2))))

        def grow(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0, 0, 0, depth + _path_left(len(part))])
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
            free = np.flatnonzero(high > low)
            if depth < most and len(free):
                feature = random.choice(free)
                split = random.uniform(low[feature], high[feature])
                left = part[:, feature] < split
                a, b = grow(part[left], depth + 1), grow(part[~left], depth + 1)
                nodes[at] = [feature, split, a, b, 0]
            return at

        roots = [grow(sample, 0) for sample in samples]
        return cls(roots, np.array(nodes), max(_path_left(max(map(len, samples), default=0)), 1e-9))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; rows that few splits set apart are near 1."""
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                node = self.nodes[at]
                inner = node[:, 0] >= 0
                if not inner.any():
                    break
                left = rows[np.arange(len(rows)), node[:, 0].astype(int)] < node[:, 1]
                at = np.where(inner, np.where(left, node[:, 2], node[:, 3]), at).astype(int)
            total += self.nodes[at, 4]
        return 2.0 ** (-total / len(self.roots) / self.usual)


def tree_samples(statistics: DataFrame, trees: int, rows_a_tree: int) -> list[np.ndarray]:
    """For each tree ``rows_a_tree`` rows of COUNTS drawn from all rows, those with the smallest hash
    of row and tree: the same ones however the rows are spread. One pass draws for all trees; rows
    far from being drawn are left out there, so what tasks hand on does not grow with the corpus."""
    count = statistics.count()
    upto = np.uint64(min(2**64 - 1, 2**64 * 3 * rows_a_tree // max(count, 1)))
    salts = mixed(np.arange(1, trees + 1, dtype=np.uint64))

    def draw(batches):
        for batch in batches:
            own = batch.column("own").to_numpy().view(np.uint64)
            tree, at, found = [], [], []
            for k, salt in enumerate(salts):
                hashes = mixed(own ^ salt)
                near = np.flatnonzero(hashes <= upto)
                near = near[np.argsort(hashes[near], kind="stable")[:rows_a_tree]]
                tree.append(np.full(len(near), k, np.int32))
                at.append(near)
                found.append(hashes[near].view(np.int64))
            index = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tree)), pa.array(np.concatenate(found)), *(batch.column(c).take(index) for c in COUNTS)],
                names=["tree", "hash", *COUNTS],
            )

    columns = ", ".join(f"{c} long" for c in COUNTS)
    drawn = (
        statistics.select(F.xxhash64("doc_id", *COUNTS).alias("own"), *COUNTS)
        .mapInArrow(draw, f"tree int, hash long, {columns}")
        .toArrow()
    )
    tree, hashes = drawn.column("tree").to_numpy(), drawn.column("hash").to_numpy().view(np.uint64)
    counts = np.column_stack([drawn.column(c).to_numpy() for c in COUNTS])
    order = np.lexsort((*counts.T, hashes, tree))
    ends = np.searchsorted(tree[order], np.arange(trees + 1))
    return [counts[order[a : min(b, a + rows_a_tree)]] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def anomaly_scores(statistics: DataFrame, *, trees: int = 200, rows_a_tree: int = 64) -> DataFrame:
    """``statistics`` with ``anomaly``. Each tree grows on rows of its own from all rows; every row
    is scored."""
    samples = tree_samples(statistics, trees, rows_a_tree)
    forest = IsolationForest.grown([features(sample) for sample in samples], rows_a_tree=rows_a_tree)

    def score(batches):
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy() for c in COUNTS])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forest.score(features(counts)))],
                names=[*batch.schema.names, "anomaly"],
            )

    columns = ", ".join(f"{c} long" for c in COUNTS)
    return statistics.mapInArrow(score, f"doc_id long, {columns}, anomaly double")


def calibrated_threshold(scored: DataFrame, labels: DataFrame, *, most_good_lost: float = 0.003) -> float:
    """The anomaly from which on documents go: the lowest that loses at most ``most_good_lost`` of
    the labelled good documents, if more of the bad ones than of the good ones lie above it.

    All labelled rows count, as a histogram of 1,000 steps. Without such a threshold it is 2.
    """
    histogram = (
        scored.join(labels.where("doc_id is not null").select("doc_id", "quality").distinct(), "doc_id")
        .groupBy(F.floor(F.col("anomaly") * 1000).cast("int").alias("step"))
        .agg(
            F.sum((F.col("quality") == 1).cast("long")).alias("good"),
            F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
        )
        .collect()
    )
    good = sum(row.good or 0 for row in histogram)
    bad = sum(row.bad or 0 for row in histogram)
    best, lost, caught = 2.0, 0, 0
    for row in sorted(histogram, key=lambda row: -row.step):
        lost, caught = lost + (row.good or 0), caught + (row.bad or 0)
        if lost > most_good_lost * good:
            break
        if caught * good > lost * bad:
            best = row.step / 1000
    return best


def judge_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``anomaly`` and ``kept`` for every document.

    ``base_failed``: fewer than 50 words, or over half of them repeated. Other documents are kept
    unless their statistics are as unusual as ``calibrated_threshold`` allows none to be. The
    forest and the threshold are learned from documents that did not fail the base.

    Null doc_ids and repeated rows are judged like others. Without labels the base alone decides.
    """
    counted = staged(rule_statistics(documents), "statistics")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    scored = staged(
        anomaly_scores(counted.where(~failed)).select("doc_id", *COUNTS, "anomaly"), "scores"
    )
    threshold = calibrated_threshold(scored, labels)
    judged = scored.withColumn("base_failed", F.lit(False)).withColumn("kept", F.col("anomaly") < threshold)
    return judged.unionByName(
        counted.where(failed)
        .withColumn("anomaly", F.lit(None).cast("double"))
        .withColumn("base_failed", F.lit(True))
        .withColumn("kept", F.lit(False))
    )
