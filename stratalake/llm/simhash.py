"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from stratalake.llm.common import parts_of, staged, values
from stratalake.llm.components import connected_components

BITS = 64
SEED = 42


@dataclass(frozen=True)
class SimHash:
    """Settings.

    ``words``: words in a shingle. ``distance``: most bits in which linked fingerprints differ, a
    multiple of 4.
    ``segments``: segments of a fingerprint, each with a table of its own. Fingerprints that link
    differ in at most ``distance // segments`` bits in some segment, so that is how far a lookup
    goes in each. Three segments of 21 or 22 bits suit up to some 10^9 different fingerprints; two,
    of 32 bits and with larger balls, suit more.
    """

    words: int = 4
    distance: int = 4
    segments: int = 3


def fingerprint(text: bytes, width: int) -> int:
    """The bits that are set in over half the hashes of all shingles of ``text``."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 8192):
        spans = zip(starts[at : at + 8192], ends[at : at + 8192], strict=True)
        hashes = [xxh64_intdigest(joined[start:end], SEED) for start, end in spans]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """(doc_id, fingerprint as a long) for every row of ``documents`` (doc_id, text)."""
    width = settings.words

    def sign(batches):
        for batch in parts_of(batches, 1024):
            found = [fingerprint(text, width) for text in values(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "fingerprint"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sign, "doc_id long, fingerprint long")


def ball_size(bits: int, radius: int) -> int:
    return sum(comb(bits, n) for n in range(radius + 1))


def ball(bits: int, radius: int) -> list[int]:
    """What to flip to reach every point within ``radius``."""
    return [sum(1 << bit for bit in flipped) for n in range(radius + 1) for flipped in combinations(range(bits), n)]


def meeting_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between the components of those of ``prints`` (fingerprint, component) that
    differ in at most twice ``radius`` bits, and no others: exactly those have a point within
    ``radius`` of both.

    Those that meet at a point are strung together, so there are fewer links than points. A point
    has at most as many visitors as a ball has points, so no group is large.
    """
    masks = np.array(ball(BITS, radius), np.uint64).view(np.int64)

    def spread(batches):
        for batch in parts_of(batches, max(1, 262144 // len(masks))):
            own = batch.column("fingerprint").to_numpy()
            name = batch.column("component").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array((own[:, None] ^ masks).ravel()), pa.array(np.repeat(name, len(masks)))],
                names=["point", "b"],
            )

    # A few bytes a row become many rows: over as many tasks as there are for those.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.select("fingerprint", "component").repartition(tasks)
    points = rows.mapInArrow(spread, "point long, b long")
    before = F.lag("b").over(Window.partitionBy("point").orderBy("b"))
    return points.select(before.alias("a"), "b").where("a <> b").distinct()


def _segments(settings: SimHash) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    edges = [BITS * n // settings.segments for n in range(settings.segments + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def table_links(prints: DataFrame, settings: SimHash) -> tuple[DataFrame, DataFrame]:
    """Links between different components of ``prints`` (fingerprint, component) by the tables of
    segments; and those of ``prints`` that stand in crowded buckets.

    Each fingerprint is listed under its value in every segment and looks up the values in a small
    ball around its own; what it finds is compared in full. Of two values that differ, the smaller
    one looks up the other. Two buckets are left out if each holds more fingerprints than a ball of
    half the distance has points: to meet at those points (``meeting_links``) is less work for
    their members than to be compared. So the work of a fingerprint is bounded by two numbers that
    depend on the settings alone, the points of that ball and the lookups times them.
    """
    crowd = ball_size(BITS, settings.distance // 2)
    segments = _segments(settings)
    entries = F.array(
        *(
            F.struct(
                F.lit(n).alias("segment"),
                F.shiftrightunsigned("fingerprint", low)
                .bitwiseAND(F.lit((1 << size) - 1).cast("long"))
                .alias("value"),
            )
            for n, (low, size) in enumerate(segments)
        )
    )
    listed = prints.select("fingerprint", "component", F.explode(entries).alias("at"))
    listed = listed.select("fingerprint", "component", "at.segment", "at.value")
    crowded = listed.groupBy("segment", "value").count().where(F.col("count") > crowd)
    listed = staged(
        listed.join(
            crowded.select("segment", "value", F.lit(True).alias("crowded")), ["segment", "value"], "left"
        ).fillna(False, ["crowded"]),
        "segments",
    )
    masks = F.lit(None)
    for n, (_, size) in enumerate(segments):
        of_segment = F.array(
            *(F.lit(mask).cast("long") for mask in ball(size, settings.distance // settings.segments))
        )
        masks = F.when(F.col("segment") == n, of_segment).otherwise(masks)
    # Where the flipped bits are all 0 in the own value, the other value is the larger one.
    lookups = listed.withColumn("mask", F.explode(masks)).where("(value ^ mask) >= value")
    x, y = lookups.withColumn("value", F.expr("value ^ mask")).alias("x"), listed.alias("y")
    found = x.join(y, F.expr("x.segment = y.segment and x.value = y.value")).where(
        f"""x.component <> y.component and not (x.crowded and y.crowded)
            and (x.mask <> 0 or x.fingerprint < y.fingerprint)
            and bit_count(x.fingerprint ^ y.fingerprint) <= {settings.distance}"""
    )
    links = found.select(F.col("x.component").alias("a"), F.col("y.component").alias("b")).distinct()
    return links, listed.where("crowded").select("fingerprint", "component").distinct()


def linked_fingerprints(prints: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """(fingerprint, component) for ``prints`` (fingerprint); a component is named after one of its
    fingerprints.

    1. Fingerprints within half the distance are tied where their small balls meet. Large groups of
       near copies fall together here, in work that is linear in their number.
    2. Lookups in the tables of segments tie the components that are left.
    3. Fingerprints in crowded buckets meet at the points of larger balls instead.
    Every pair within the distance is tied by one of these, and nothing else is.
    """
    if settings.distance % 4:
        raise ValueError("balls around both ends have to reach the distance and its half: a multiple of 4")
    prints = staged(prints.select("fingerprint").distinct(), "prints")
    alone = prints.withColumn("component", F.col("fingerprint"))
    near = connected_components(meeting_links(alone, settings.distance // 4))
    first = staged(
        prints.join(near, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", F.coalesce("component", "fingerprint").alias("component")
        ),
        "near",
    )
    links, crowded = table_links(first, settings)
    links = links.unionByName(meeting_links(crowded, settings.distance // 2))
    merged = connected_components(links).toDF("node", "merged")
    return first.join(merged, F.col("component") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("merged", "component").alias("component")
    )


def linked_documents(documents: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``documents`` (doc_id, text); the
    fingerprint as 16 hexadecimal digits.

    Documents are linked if their fingerprints differ in at most ``settings.distance`` bits; a
    component is what links reach, named after its smallest doc_id. Exact: no link is missed.

    Texts with fewer words than a shingle are one shingle; null and blank texts have the
    fingerprint zero and are linked like any other. A row without doc_id ties others together, and
    gets the name of its component; that is null if no row of it has a doc_id. Rows that repeat a
    doc_id each have their own fingerprint. Other columns are ignored.
    """
    signed = staged(fingerprints(documents, settings), "fingerprints")
    named = linked_fingerprints(signed, settings)
    least = signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    members = staged(named.join(least, "fingerprint"), "members")
    names = members.groupBy("component").agg(F.min("least").alias("component_id"))
    known = members.join(names, "component").select("fingerprint", "component_id")
    return signed.join(known, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
