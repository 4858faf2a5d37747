"""Hard negatives by exact inner products, scored from tables of subset sums (Four Russians)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stratalake.llm.common import finite_vector, parts_of, staged

GROUP = 8  # dimensions whose subset sums make one table of 256 entries
BATCH = 2048  # candidates scored at once
NONE = -(2**63) + 1  # less than any score; can be negated


@dataclass(frozen=True)
class HardNegatives:
    """Settings.

    ``every``: anchors are the rows whose vec_id it divides. ``scale``: a component x counts as
    floor(scale * x). ``positives`` and ``negatives``: how many are returned for an anchor, and for
    each of its positives. ``low``, ``high``: percentages of the positive's score between which the
    negative's lies. ``anchors`` and ``candidates``: about how many of each one task compares; it
    keeps the anchors' tables and a batch of candidates in memory.
    """

    every: int = 50
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchors: int = 256
    candidates: int = 65536


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Of each row, for every plane of its two's complement numbers, one byte for eight dimensions:
    (rows, planes, groups)."""
    rows, groups = len(vectors), vectors.shape[1] // GROUP
    out = np.empty((rows, planes, groups), np.uint8)
    for plane in range(planes):
        bits = ((vectors >> plane) & 1).astype(np.uint8).reshape(rows, groups, GROUP)
        out[:, plane] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0]
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """The sum of each anchor over each subset of each eight dimensions: (groups, 256, anchors)."""
    count, groups = len(anchors), anchors.shape[1] // GROUP
    tables = np.zeros((groups, 1 << GROUP, count), anchors.dtype)
    for bit in range(GROUP):
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + anchors[:, bit::GROUP].T[:, None]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of all candidates with all anchors: (candidates, anchors).

    Each byte of a candidate picks the sum of an anchor over the dimensions whose bit is set; planes
    are added from the highest down, shifted by one in between. The highest is that of the sign.
    """
    total = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for plane in reversed(range(planes.shape[1])):
        total <<= 1
        for group, table in enumerate(tables):
            np.take(table, planes[:, plane, group], axis=0, out=found, mode="clip")
            total += found
        if plane == planes.shape[1] - 1:
            np.negative(total, out=total)
    return total


class Best:
    """The best few candidates of every anchor, by falling score and then rising id, of those that
    were offered; in batches of rising ids."""

    def __init__(self, anchors: int, most: int):
        self.scores = np.empty((anchors, 0), np.int64)
        self.ids = np.empty((anchors, 0), np.int64)
        self.most = most

    def offer(self, found: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """``found``: (anchors, candidates); ``fits``: which of them count."""
        count = len(ids)
        # One number for each: no two are equal, earlier ids are larger.
        keys = np.where(fits, found * count + np.arange(count - 1, -1, -1), NONE)
        if count > self.most:
            keys = np.partition(keys, count - self.most, axis=1)[:, count - self.most :]
        keys = -np.sort(-keys, axis=1)
        picked, at = np.floor_divide(keys, count), count - 1 - np.mod(keys, count)
        picked = np.where(keys == NONE, NONE, picked)
        # Those found before have smaller ids, so they stay in front of equal scores.
        merged = np.concatenate([self.scores, picked], axis=1)
        named = np.concatenate([self.ids, ids[at]], axis=1)
        order = np.argsort(-merged, axis=1, kind="stable")[:, : self.most]
        self.scores = np.take_along_axis(merged, order, axis=1)
        self.ids = np.take_along_axis(named, order, axis=1)

    def rows(self, anchor: int):
        """(id, score) of those found for one anchor."""
        found = zip(self.ids[anchor].tolist(), self.scores[anchor].tolist(), strict=True)
        return [(name, score) for name, score in found if score != NONE]


def packed_vectors(embeddings: DataFrame, settings: HardNegatives) -> tuple[DataFrame, int]:
    """(vec_id, label, numbers, planes) of the rows that take part, and the number of planes.

    ``numbers`` are the components as integers, ``planes`` the same as bit planes.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    rows = rows.where("vec_id is not null and label is not null").where(finite_vector(F.col("embedding")))
    rows = rows.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * settings.scale)).alias("numbers"),
    )
    rows = staged(rows.groupBy("vec_id").agg(F.min(F.struct("label", "numbers")).alias("x")).select("vec_id", "x.*"), "vectors")
    size = rows.agg(
        F.coalesce(F.max(F.size("numbers")), F.lit(0)).alias("dimensions"),
        F.coalesce(F.max(F.array_max("numbers")), F.lit(0)).alias("most"),
        F.coalesce(F.min(F.array_min("numbers")), F.lit(0)).alias("least"),
    ).first()
    dimensions = max(-(-size.dimensions // GROUP), 1) * GROUP
    planes = max(size.most, -size.least - 1, 0).bit_length() + 1
    # Scores are multiplied by a percentage and by the rows of a batch.
    if max(size.most, -size.least) ** 2 * dimensions * BATCH >= 2**62:
        raise ValueError("the vectors are too large for scores that are longs")

    def pack(batches):
        for batch in parts_of(batches, 4096):
            lists = batch.column("numbers")
            sizes = lists.value_lengths().to_numpy()
            numbers = np.zeros((batch.num_rows, dimensions), np.int64)
            numbers[np.arange(dimensions) < sizes[:, None]] = lists.flatten().to_numpy()
            packed = bit_planes(numbers, planes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([row.tobytes() for row in numbers], pa.binary()),
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                ],
                names=["vec_id", "label", "numbers", "planes"],
            )

    packed = rows.mapInArrow(pack, "vec_id long, label long, numbers binary, planes binary")
    return staged(packed, "planes"), planes


def _compared(anchors: DataFrame, rows: DataFrame, planes: int, settings: HardNegatives, offer, schema: str) -> DataFrame:
    """What ``offer`` finds where blocks of ``anchors`` (vec_id, label, numbers, wanted) meet blocks of ``rows``.

    A cell is one block of anchors with one block of candidates, cut by hash; every anchor meets
    every candidate in one cell. In a task the anchors of a cell come first, then the candidates by
    rising id, batch by batch. ``offer(names, labels, wanted)`` makes the collector of a cell.
    """
    n_anchors, n_rows = anchors.count(), rows.count()
    across = max(-(-n_rows // settings.candidates), 1)
    down = max(-(-n_anchors // settings.anchors), 1)
    block = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count))
    asking = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("x"),
        block(down).alias("y"),
        F.lit(0).alias("role"),
        "vec_id",
        "label",
        F.col("numbers").alias("content"),
        "wanted",
    )
    asked = rows.select(
        block(across).cast("int").alias("x"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))).alias("y"),
        F.lit(1).alias("role"),
        "vec_id",
        "label",
        F.col("planes").alias("content"),
        F.lit(None).cast("array<long>").alias("wanted"),
    )
    cells = asking.unionByName(asked).repartition(max(across * down, 1), "x", "y")

    def compare(batches):
        cell, asking, collector, tables = None, [], None, None

        for batch in parts_of(batches, BATCH):
            places = np.stack([batch.column(c).to_numpy() for c in ("x", "y", "role")])
            cuts = [0, *(np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                x, y, role = places[:, low].tolist()
                if (x, y) != cell:
                    if collector:
                        yield from collector.result()
                    cell, asking, collector, tables = (x, y), [], None, None
                names = part.column("vec_id").to_numpy()
                labels = part.column("label").to_numpy()
                content = part.column("content").to_pylist()
                if role == 0:
                    asking.append((names, labels, content, part.column("wanted").to_pylist()))
                elif asking:
                    if tables is None:
                        numbers = np.frombuffer(b"".join(b for a in asking for b in a[2]), np.int64)
                        own = np.concatenate([a[0] for a in asking])
                        tables = subset_sums(numbers.reshape(len(own), -1))
                        collector = offer(own, np.concatenate([a[1] for a in asking]), [w for a in asking for w in a[3]])
                    packed = np.frombuffer(b"".join(content), np.uint8).reshape(len(names), planes, -1)
                    collector.take(scores(tables, packed).T, names, labels)
        if collector:
            yield from collector.result()

    return cells.sortWithinPartitions("x", "y", "role", "vec_id").mapInArrow(compare, schema)


class _Positives:
    """The best other candidates of an anchor's own label."""

    schema = "anchor_id long, positive_id long, positive_score long"

    def __init__(self, names, labels, wanted, most):
        self.names, self.labels, self.best = names, labels, Best(len(names), most)

    def take(self, found, names, labels):
        self.best.offer(found, names, (self.labels[:, None] == labels) & (self.names[:, None] != names))

    def result(self):
        rows = [(a, i, s) for n, a in enumerate(self.names.tolist()) for i, s in self.best.rows(n)]
        yield _batch(rows, ("anchor_id", "positive_id", "positive_score"))


class _Negatives:
    """The best candidates of other labels below the limits that an anchor's positives set."""

    schema = "anchor_id long, positive_score long, negative_id long, negative_score long"

    def __init__(self, names, labels, wanted, settings):
        self.names, self.labels, self.settings = names, labels, settings
        width = max(map(len, wanted))
        # Places without a positive ask for scores that do not exist.
        self.limits = [np.array([w[k] if k < len(w) else -1 for w in wanted]) for k in range(width)]
        self.best = [Best(len(names), settings.negatives) for _ in range(width)]

    def take(self, found, names, labels):
        other = self.labels[:, None] != labels
        for limit, best in zip(self.limits, self.best, strict=True):
            low, high = limit[:, None] * self.settings.low, limit[:, None] * self.settings.high
            best.offer(found, names, other & (found * 100 >= low) & (found * 100 <= high))

    def result(self):
        rows = [
            (a, limit[n].item(), i, s)
            for limit, best in zip(self.limits, self.best, strict=True)
            for n, a in enumerate(self.names.tolist())
            for i, s in best.rows(n)
        ]
        yield _batch(rows, ("anchor_id", "positive_score", "negative_id", "negative_score"))


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=list(names))


def hard_negatives(embeddings: DataFrame, settings: HardNegatives = HardNegatives()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor
    and each of its positives the best rows of other labels whose score lies between ``low`` and
    ``high`` percent of the positive's.

    ``embeddings`` (vec_id, embedding, label): components x count as floor(scale * x), and where
    vec_id is divisible by 7 the label first becomes (label + 1) % 10. A score is the exact inner
    product of the integers; higher ones come first, equal ones by smaller vec_id. All rows are
    compared with all anchors, in two passes: positives first, then negatives within their limits.
    Each pass hands on the best few of an anchor in each block of candidates.

    Rows with a null vec_id or label, a null vector or an entry that is null or not finite take no
    part. Shorter vectors, empty ones too, are zero in the missing dimensions. A vec_id names one
    row: of several rows with the same vec_id the one with the smallest label, then the smallest
    vector, takes part. Vectors so large that scores might not fit into a long are an error. An
    empty table gives an empty result; other columns are ignored.
    """
    rows, planes = packed_vectors(embeddings, settings)
    anchors = rows.where(F.col("vec_id") % settings.every == 0).select("vec_id", "label", "numbers")

    def first(found: DataFrame, key: list[str], by: str, most: int) -> DataFrame:
        order = Window.partitionBy(*key).orderBy(F.desc(f"{by}_score"), f"{by}_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    asking = anchors.withColumn("wanted", F.lit(None).cast("array<long>"))
    most = settings.positives
    found = _compared(
        asking, rows, planes, settings, lambda *cell: _Positives(*cell, most), _Positives.schema
    )
    positives = staged(first(found, ["anchor_id"], "positive", most).drop("rank"), "positives")
    wanted = (
        positives.where("positive_score >= 0")  # below zero the limits leave nothing between them
        .groupBy("anchor_id")
        .agg(F.array_sort(F.collect_set("positive_score")).alias("wanted"))
    )
    asking = anchors.join(wanted, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = _compared(
        asking, rows, planes, settings, lambda *cell: _Negatives(*cell, settings), _Negatives.schema
    )
    negatives = first(found, ["anchor_id", "positive_score"], "negative", settings.negatives)
    return positives.join(negatives, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
