"""Near duplicates by bottom-k sketches, inverted lists and exact confirmation."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import (
    columns_of,
    mixed,
    new_names,
    small_batches,
    staged,
    values,
    window_hashes,
    word_hashes,
)
from stratalake.llm.components import connected_components


@dataclass(frozen=True)
class NearDedup:
    """Settings.

    ``words``: words in a shingle. ``percent``: least similarity, as a percentage. ``k``: values in
    a sketch. ``least_shared``: share of a full sketch of the union that has to lie in both sets
    for a pair to be looked at. A pair exactly at the limit misses it with the probability that a
    binomial of ``k`` draws stays below: 2e-7 for 85 % and the values here, less above the limit.
    Sets of up to ``k`` times ``percent`` shingles are compared by the whole set and miss nothing.
    ``short_list``: lists up to this length are compared directly, longer ones by at most
    ``leaders`` members at a time.
    """

    words: int = 3
    percent: int = 85
    k: int = 64
    least_shared: float = 0.59375
    short_list: int = 32
    leaders: int = 256


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text with fewer words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def signatures(documents: DataFrame, settings: NearDedup) -> DataFrame:
    """Per row the size of its set, a fingerprint of the set and its bottom-k sketch."""
    k, width = settings.k, settings.words

    def sign(batches):
        for batch in batches:
            sizes, prints, sketches = [], [], []
            for text in values(batch, "text"):
                found = shingles(text, width)
                sizes.append(len(found))
                prints.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sketches.append(found[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "fingerprint", "sketch"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        sign, "doc_id long, n_shingles long, fingerprint binary, sketch array<long>"
    )


def _inverted_lists(classes: DataFrame, settings: NearDedup) -> DataFrame:
    """(value, id, n) of the retained values under which a class is looked up.

    Two sketches that share at least ``t`` values share one among the ``size - t + 1`` rarest of
    each, whatever the order, as long as it is the same for all. So each class is listed under its
    rarest values only, and values of widespread passages get long lists only from documents that
    consist of them.
    """
    entries = classes.select("id", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").count().where("count > 1")
    whole = F.col("n") * 100 <= settings.k * settings.percent
    least = F.when(whole, F.ceil(F.col("n") * settings.percent / 100.0)).otherwise(
        F.lit(int(np.ceil(settings.k * settings.least_shared)))
    )
    found = (
        entries.join(shared, "value")
        .groupBy("id", "n", "size")
        .agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("found"))
    )
    left = F.greatest(F.size("found") + 1 - least, F.lit(0)).cast("int")
    return found.select("id", "n", F.explode(F.slice("found", F.lit(1), left)).alias("entry")).select(
        F.col("entry.value").alias("value"), "id", "n"
    )


def _similar_size(x: str, y: str, settings: NearDedup):
    return F.least(x, y) * 100 >= F.greatest(x, y) * settings.percent


def _estimated(pairs: DataFrame, classes: DataFrame, settings: NearDedup) -> DataFrame:
    """Pairs whose sketch of the union holds enough values of both sets."""
    k, least = settings.k, settings.least_shared
    sketch = classes.select("id", "sketch")
    both = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")

    def estimate(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x = x.values.to_numpy().view(np.uint64)
                y = y.values.to_numpy().view(np.uint64)
                union = np.union1d(x, y)[:k]
                shared = np.intersect1d(x, y, assume_unique=True)
                keep.append(bool((shared <= union[-1]).sum() >= least * len(union)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(estimate, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, settings: NearDedup) -> DataFrame:
    """Pairs that reach the limit on their full sets."""
    width, percent = settings.words, settings.percent
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")

    def confirm(batches):
        known, name = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column("a"), values(batch, "x"), values(batch, "y"), strict=True):
                if name != (a, x):
                    known, name = shingles(x, width), (a, x)
                other = shingles(y, width)
                shared = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(bool(shared and 100 * shared >= percent * (len(known) + len(other) - shared)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long").distinct()


def _exact_lists(texts: DataFrame, settings: NearDedup) -> DataFrame:
    """(value, id, n, pos) of the rarest shingles of full sets, ``pos`` counted from the rarest.

    As with sketches, but with the exact bound: sets that reach the limit share one of the
    ``n - percent * n / 100 + 1`` rarest shingles of each.
    """
    width = settings.words

    def explode(batches):
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), values(batch, "text"), strict=True):
                found = shingles(text, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), id_, np.int64)),
                        pa.array(np.full(len(found), len(found), np.int64)),
                        pa.array(found.view(np.int64)),
                    ],
                    names=["id", "n", "value"],
                )

    entries = texts.mapInArrow(explode, "id long, n long, value long").distinct()
    shared = entries.groupBy("value").count().where("count > 1")
    found = (
        entries.join(shared, "value")
        .groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("found"))
    )
    alone = F.col("n") - F.size("found")
    return (
        found.select("id", "n", alone.alias("alone"), F.posexplode("found").alias("at", "entry"))
        .select(F.col("entry.value").alias("value"), "id", "n", (F.col("at") + F.col("alone")).alias("pos"))
        .where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * settings.percent / 100.0))
    )


def _reachable(x_n, x_pos, y_n, y_pos, settings: NearDedup):
    """Whether sets whose first common shingle is at these positions can reach the limit."""
    p = settings.percent
    return F.least(x_n - x_pos, y_n - y_pos) * (100 + p) >= (x_n + y_n) * p


def _pairs_of_short(lists: DataFrame, settings: NearDedup) -> DataFrame:
    """Pairs of different components within lists of bounded length."""
    rows = lists.groupBy("value").agg(F.collect_list(F.struct("id", "n", "pos", "component")).alias("all"))
    x = rows.select(F.explode("all").alias("x"), "all")
    partners = F.filter(
        "all",
        lambda y: (y["id"] > F.col("x.id"))
        & (y["component"] != F.col("x.component"))
        & _reachable(y["n"], y["pos"], F.col("x.n"), F.col("x.pos"), settings),
    )
    return (
        x.select(F.col("x.id").alias("a"), F.explode(partners).alias("y"))
        .select("a", F.col("y.id").alias("b"))
        .distinct()
    )


def _pairs_of_long(lists: DataFrame, settings: NearDedup) -> tuple[DataFrame, DataFrame]:
    """Everyone in a list against chosen members outside its largest component; the chosen."""
    largest = (
        lists.groupBy("value", "component")
        .count()
        .groupBy("value")
        .agg(F.max_by("component", F.struct("count", "component")).alias("largest"), F.sum("count").alias("all"), F.max("count").alias("in_largest"))
    )
    outside = lists.join(largest, "value").where("component <> largest")
    few = F.col("all") - F.col("in_largest") <= settings.leaders
    columns = ["value", "id", "n", "pos", "component"]
    chosen = staged(
        outside.where(few)
        .select(columns)
        .unionByName(
            outside.where(~few)
            .groupBy("value", F.pmod(F.xxhash64("id"), F.lit(settings.leaders)).alias("part"))
            .agg(F.min(F.struct(F.xxhash64("id"), *columns[1:])).alias("x"))
            .select("value", *(f"x.{c}" for c in columns[1:]))
        ),
        "leaders",
    )
    x = lists.join(chosen.toDF("value", "y_id", "y_n", "y_pos", "y_component"), "value")
    reachable = _reachable(F.col("n"), F.col("pos"), F.col("y_n"), F.col("y_pos"), settings)
    pairs = x.where((F.col("component") != F.col("y_component")) & reachable).select(
        F.least("id", "y_id").alias("a"), F.greatest("id", "y_id").alias("b")
    )
    return pairs.distinct(), chosen


def similar_documents(documents: DataFrame, settings: NearDedup = NearDedup()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents`` (doc_id, text).

    Two documents are linked if their sets of word shingles have a Jaccard similarity of at least
    ``settings.percent``; a component is what links reach, named after its smallest doc_id.

    1. Rows with equal sets form a class, represented by its smallest doc_id.
    2. Inverted lists over the rarest retained values of each class's bottom-k sketch.
    3. Each class is compared with the leader (smallest id) it shares most lists with.
    4. Members of lists that still span several components are listed again, under the rarest
       shingles of their full sets. Short lists are compared pair by pair across components. In
       long ones everyone is compared with members outside the list's largest component, which
       then leave the list, until it is short or of one component: no list is cut off.
    A pair is compared by the sketch of its union first, then by its full sets.

    Null and blank texts have an empty set and are linked with nothing. A null doc_id gets no
    links and no component, and is kept. Rows that repeat a doc_id are each judged by their own
    text. Other columns are ignored.
    """
    with small_batches(documents.sparkSession):  # all that runs on batches does so before this returns
        return _similar_documents(documents, settings)


def _similar_documents(documents: DataFrame, settings: NearDedup) -> DataFrame:
    signed = staged(signatures(documents, settings), "signatures")
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    representatives = (
        linkable.groupBy("fingerprint").agg(F.min("doc_id").alias("id")).toDF("same", "id")
    )
    members = signed.select("doc_id", "n_shingles", "fingerprint").join(
        representatives, F.col("fingerprint") == F.col("same"), "left"
    )
    classes = staged(
        linkable.join(
            representatives, (F.col("doc_id") == F.col("id")) & (F.col("fingerprint") == F.col("same"))
        )
        .select("id", F.col("n_shingles").alias("n"), "sketch")
        .distinct(),
        "classes",
    )
    lists = staged(_inverted_lists(classes, settings), "lists")
    listed = lists.select("id").distinct()
    texts = staged(
        documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(listed, "id", "left_semi"), "texts"
    )

    leaders = lists.groupBy("value").agg(F.min(F.struct("id", "n")).alias("leader"))
    best = (
        lists.join(leaders, "value")
        .where((F.col("id") != F.col("leader.id")) & _similar_size("n", "leader.n", settings))
        .groupBy("id", F.col("leader.id").alias("leader"))
        .agg(F.count("*").alias("overlap"))
        .groupBy("id")
        .agg(F.max_by("leader", F.struct("overlap", -F.col("leader"))).alias("leader"))
        .select(F.col("leader").alias("a"), F.col("id").alias("b"))
    )

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = staged(_estimated(pairs, classes, settings), "pairs")
        return staged(_confirmed(pairs, texts, settings), "links")

    links = links_of(best)
    components = staged(connected_components(links), "components")

    def still_open(lists: DataFrame) -> DataFrame:
        """Entries of lists that span several components, with their component and the length."""
        named = lists.join(components, F.col("id") == F.col("node"), "left").select(
            *lists.columns, F.coalesce("component", "id").alias("component")
        )
        spans = named.groupBy("value").agg(
            F.count("*").alias("length"), F.min("component").alias("low"), F.max("component").alias("high")
        )
        spans = spans.where("low <> high").select("value", "length")
        return staged(named.join(spans, "value"), "open")

    again = still_open(lists).select("id").distinct()
    rest = staged(_exact_lists(texts.join(again, "id", "left_semi"), settings), "exact-lists")
    while True:
        rest = still_open(rest)
        long = rest.where(F.col("length") > settings.short_list).drop("length")
        if long.isEmpty():
            break
        pairs, chosen = _pairs_of_long(long, settings)
        new = links_of(pairs)
        if not new.isEmpty():
            links = links.unionByName(new)
            components = staged(connected_components(links), "components")
        rest = rest.select("value", "id", "n", "pos").join(
            chosen.select("value", "id"), ["value", "id"], "left_anti"
        )
    links = links.unionByName(links_of(_pairs_of_short(rest, settings)))
    components = connected_components(links)
    return (
        members.join(components, F.col("id") == F.col("node"), "left")
        .withColumn(
            "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def _numbered(rows: DataFrame) -> DataFrame | None:
    """(doc_id, body, id), if a doc_id stands on several texts: a number for each of them, by
    rising doc_id and body. None if every doc_id has one text."""
    several = rows.groupBy("doc_id").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    if several.where("low <> high").isEmpty():
        return None
    distinct = rows.select("doc_id", "body").distinct()
    return staged(distinct.orderBy("doc_id", "body").withColumn("id", F.monotonically_increasing_id()), "numbered")


def drop_similar(documents: DataFrame, settings: NearDedup = NearDedup()) -> DataFrame:
    """``documents`` without those whose text is linked, directly or not, to one of a smaller doc_id.

    Each row is judged by its own text, also where a doc_id stands on several: of linked texts with
    the same doc_id one stays, that of the smallest hash, and those that are linked with nothing
    all do. Of rows with the same doc_id and text one stays. Rows without doc_id all stay.
    """
    key, text_hash, kept_id, kept_body = new_names(documents, "key", "body", "kept_id", "kept_body")
    hashed = documents.withColumns({key: F.col("doc_id").cast("long"), text_hash: F.xxhash64("text")})
    rows = hashed.select(F.col(key).alias("doc_id"), F.col(text_hash).alias("body"), "text").where("doc_id is not null")
    numbers = _numbered(rows)
    if numbers is None:
        judged = similar_documents(rows.select("doc_id", "text"), settings)
        kept = judged.where("kept").select(F.col("doc_id").alias(kept_id)).distinct()
        matches = F.col(key) == F.col(kept_id)
    else:
        texts = rows.join(numbers, ["doc_id", "body"]).select(F.col("id").alias("doc_id"), "text")
        judged = similar_documents(texts, settings).where("kept").select(F.col("doc_id").alias("id")).distinct()
        kept = numbers.join(judged, "id", "left_semi").select(
            F.col("doc_id").alias(kept_id), F.col("body").alias(kept_body)
        )
        matches = (F.col(key) == F.col(kept_id)) & (F.col(text_hash) == F.col(kept_body))
    known = hashed.where(F.col(key).isNotNull()).join(kept, matches, "left_semi").dropDuplicates([key, text_hash])
    return known.select(columns_of(documents)).unionByName(documents.where(F.col("doc_id").isNull()))
