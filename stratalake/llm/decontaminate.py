"""Test items in training texts: rare n-gram seeds, then local alignment."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stratalake.llm.common import columns_of, mixed, staged, values, word_hashes
from stratalake.llm.toxicity import CLEAN

FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Alignment:
    """``score``: least share of the best possible alignment score; items of fewer than ``short`` words
    have to stand in a text word by word. ``seeds``: how many seeds of an item a text needs to be
    aligned with it, if the item has as many that no copy can lose. ``sent``: bytes of n-gram hashes
    up to which they are sent to every task; beyond it n-grams are joined by a shuffle."""

    score: float = 0.5
    short: int = 8
    seeds: int = 3
    match: int = 2
    mismatch: int = 1
    gap: int = 1
    sent: int = 16_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(CLEAN).split()


def least_score(size: int, settings: Alignment) -> float:
    """The share of the best score that an item of so many words has to reach."""
    return 1 if size < settings.short else settings.score


def surviving(size: int, settings: Alignment) -> int:
    """How many pairs of neighbouring matches, with at most one edit between the two, any alignment
    has that reaches the least score of an item of ``size`` words.

    An alignment with M matches and E edits scores at most match * M - c * E, where c is what an
    edit costs at least. So E is at most match / c * (M - share * size). Of the M - 1 pairs at most
    E / 2 have two edits or more between them. What is left is least at one end of what M can be.
    """
    share = least_score(size, settings)
    each = settings.match / min(settings.mismatch, settings.gap) / 2
    left = (m - 1 - each * (m - share * size) for m in (share * size, size))
    return max(ceil(min(left) - 1e-9), 0)


def most_edits(size: int, settings: Alignment) -> int:
    """How many edits an alignment with an item can have at most that reaches the least score."""
    share = least_score(size, settings)
    return int(settings.match / min(settings.mismatch, settings.gap) * (size - share * size) + 1e-9)


def pair_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of words that are neighbours or have one word between them, the same for
    both kinds, and where each begins. A single word is a pair with itself."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = word_hashes(words)
    ends = [hashes[1:], hashes[2:]] if len(hashes) > 1 else [hashes]
    found = [mixed(hashes[: len(end)] * FACTOR + end) for end in ends]
    return np.concatenate(found).view(np.int64), np.concatenate([np.arange(len(f)) for f in found])


def single_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes = word_hashes(words)
    return mixed(hashes * FACTOR + hashes).view(np.int64), np.arange(len(hashes))


def _item_grams(items: DataFrame, settings: Alignment) -> DataFrame:
    """(item_id, item, size, needed, kept, gram, offset): the pairs of each item; of the places where
    they begin the ``kept`` rarest are enough for a copy to have ``needed`` of them."""

    def cut(batches):
        for batch in batches:
            for id_, item, text in zip(batch.column("item_id"), batch.column("item"), values(batch, "text"), strict=True):
                words = words_of(text)
                if not words:
                    continue
                found, offsets = pair_grams(words)
                places = max(len(words) - 1, 1)
                sure = max(surviving(len(words), settings), 1)
                needed = min(settings.seeds, sure)
                constant = {"item_id": id_.as_py(), "item": item.as_py(), "size": len(words), "needed": needed, "kept": places - (sure - needed)}
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(len(found), value, np.int64)) for value in constant.values()),
                        pa.array(found),
                        pa.array(offsets),
                    ],
                    names=[*constant, "gram", "offset"],
                )

    return items.mapInArrow(
        cut, "item_id long, item long, size long, needed long, kept long, gram long, offset long"
    )


def _known(rows: DataFrame, grams: DataFrame, settings: Alignment):
    """The sorted ``grams`` as a broadcast variable, None if they are too many."""
    if grams.count() * 8 > settings.sent:
        return None
    return rows.sparkSession.sparkContext.broadcast(np.sort(grams.toArrow().column("gram").to_numpy()))


def _finder(wanted: np.ndarray):
    """A function that gives the places of hashes that are among ``wanted``, and where they are there.

    A table of some of their bits is asked first, which few others pass.
    """
    mask = (1 << max(16, (16 * len(wanted)).bit_length())) - 1
    maybe = np.zeros(mask + 1, bool)
    maybe[wanted & mask] = True

    def find(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(maybe[hashes & mask])
        if not len(places):
            return places, places
        near = np.minimum(np.searchsorted(wanted, hashes[places]), len(wanted) - 1)
        there = wanted[near] == hashes[places]
        return places[there], near[there]

    return find


def _grams_of(text: bytes, singles: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    words = words_of(text)
    return [pair_grams(words)] + ([single_grams(words)] if singles and len(words) > 1 else [])


def _hits(rows: DataFrame, grams: DataFrame, settings: Alignment, singles: bool) -> DataFrame:
    """(doc_id, body, pos, gram): where the ``grams`` (gram) stand in texts."""
    known = _known(rows, grams, settings)

    def cut(batches):
        find = _finder(known.value) if known else lambda own: (np.arange(len(own)), None)
        for batch in batches:
            at, pos, found = [], [], []
            for i, text in enumerate(values(batch, "text")):
                for own, places in _grams_of(text, singles):
                    hit, _ = find(own)
                    if len(hit):
                        at.append(np.full(len(hit), i))
                        pos.append(places[hit])
                        found.append(own[hit])
            if at:
                index = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(index),
                        batch.column("body").take(index),
                        pa.array(np.concatenate(pos)),
                        pa.array(np.concatenate(found)),
                    ],
                    names=["doc_id", "body", "pos", "gram"],
                )

    hits = rows.mapInArrow(cut, "doc_id long, body long, pos long, gram long")
    return hits if known else hits.join(grams, "gram", "left_semi")


def _gram_counts(rows: DataFrame, grams: DataFrame, settings: Alignment, singles: bool) -> DataFrame:
    """(gram, n): how often each of the ``grams`` stands in all texts; those that never do are left out."""
    known = _known(rows, grams, settings)
    if known is None:
        return _hits(rows, grams, settings, singles).groupBy("gram").agg(F.count("*").alias("n"))

    def count(batches):
        wanted = known.value
        find, total = _finder(wanted), np.zeros(len(wanted), np.int64)
        for batch in batches:
            for text in values(batch, "text"):
                for own, _ in _grams_of(text, singles):
                    np.add.at(total, find(own)[1], 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[there]), pa.array(total[there])], names=["gram", "n"])

    counts = rows.select("text").mapInArrow(count, "gram long, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def _row_scores(left: np.ndarray, text: np.ndarray, settings: Alignment, local: bool):
    """Row after row the table of best scores of alignments that end at a word of each; those begin
    anywhere (``local``) or at the first words. A row is computed at once: what a gap in the row
    carries on is a running maximum."""
    slope = settings.gap * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64) if local else -slope
    yield above
    for word in left:
        row = np.empty_like(above)
        row[0] = 0 if local else above[0] - settings.gap
        row[1:] = np.maximum(above[:-1] + np.where(text == word, settings.match, -settings.mismatch), above[1:] - settings.gap)
        if local:
            np.maximum(row, 0, out=row)
        above = np.maximum.accumulate(row + slope) - slope
        yield above


def align(item: np.ndarray, text: np.ndarray, settings: Alignment) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: score, first word and end of the best stretch of ``text``.

    Two rows are kept. Where the stretch begins is found from its end, backwards.
    """
    best, last, end = 0, 0, 0
    for i, row in enumerate(_row_scores(item, text, settings, local=True)):
        if row.max() > best:
            best, last, end = int(row.max()), i, int(row.argmax())
    for row in _row_scores(item[:last][::-1], text[:end][::-1], settings, local=False):
        if best and row.max() == best:
            return best, end - int(row.argmax()), end
    return 0, 0, 0


def windows_around(hits: list[tuple[int, int]], size: int, edits: int, needed: int, words: int):
    """(first, end) of windows of a text that hold every alignment an item of ``size`` words can have
    by its seeds, with at most so many ``edits``; ``hits``: (where the item would begin, offset of
    the seed).

    An alignment is at most ``size + edits`` words long, and what its seeds say of where the item
    begins differs by ``edits`` at most. So all of them lie in one region around such hits, of which
    every stretch of that length is in one of the windows.
    """
    hits, at, long = sorted(hits), 0, size + edits
    while at < len(hits):
        upto = at
        while upto + 1 < len(hits) and hits[upto + 1][0] - hits[upto][0] <= edits:
            upto += 1
        if len({offset for _, offset in hits[at : upto + 1]}) >= needed:
            first, end = max(hits[at][0] - edits, 0), min(hits[upto][0] + long, words)
            while True:
                yield first, min(first + 2 * long, end)
                if first + 2 * long >= end:
                    break
                first += long
        at = upto + 1


def find_leaks(documents: DataFrame, items: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """(doc_id, item_id, score, first, end) for every document (doc_id, text) and test item (item_id,
    text) whose best local alignment of words reaches ``settings.score``; the aligned words are
    ``first`` to before ``end``, in words without punctuation and ASCII case.

    1. Seeds are pairs of words that are neighbours or have one word between them. Their counts over
       all texts say which are rare. An alignment that reaches the score keeps a certain number of
       pairs whatever was edited (``surviving``), so an item can do without its commonest places and
       still has ``settings.seeds`` in every copy: the rarest seeds find all copies.
    2. A text with that many seeds of an item hands on the windows around them.
    3. Windows with enough of the item's words are aligned with it.
    No pair that reaches the score is missed, if match is at most twice what an edit costs or the
    score is high enough for ``surviving`` to be above zero.

    Null or blank texts and items match nothing, null ids neither. Rows that repeat an id are each
    judged by their own text; a pair is returned once, with its best score. Other columns are ignored.
    """
    items = items.where("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct().withColumn("item", F.xxhash64("text"))
    own = staged(_item_grams(items, settings), "item-grams")
    rows = (
        documents.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("body", F.xxhash64("text"))
    )
    singles = not own.where("size = 1").isEmpty()
    counts = staged(_gram_counts(rows, own.select("gram").distinct(), settings, singles), "gram-counts")
    place = ["item_id", "item", "offset"]
    by_rarity = Window.partitionBy("item_id", "item").orderBy("n", "offset")
    rare = (
        own.join(counts, "gram", "left")
        .groupBy(*place, "kept")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        .withColumn("rank", F.row_number().over(by_rarity))
        .where("rank <= kept")
        .select(place)
    )
    seeds = staged(own.join(rare, place).select(*place, "size", "needed", "gram"), "seeds")
    hits = _hits(rows, seeds.select("gram").distinct(), settings, singles)
    item = ["item_id", "item", "size", "needed"]
    found = (
        hits.join(seeds, "gram")
        .groupBy("doc_id", "body", *item)
        .agg(F.collect_set(F.struct((F.col("pos") - F.col("offset")).alias("start"), "offset")).alias("hits"))
        .where(F.size(F.array_distinct("hits.offset")) >= F.col("needed"))
        .groupBy("doc_id", "body")
        .agg(F.collect_list(F.struct(*item, "hits")).alias("found"))
    )

    def cut(batches):
        for batch in batches:
            for doc, found, text in zip(batch.column("doc_id").to_pylist(), batch.column("found"), values(batch, "text"), strict=True):
                words, out = words_of(text), []
                for one in found.as_py():
                    hits = [(hit["start"], hit["offset"]) for hit in one["hits"]]
                    edits = most_edits(one["size"], settings)
                    for first, end in windows_around(hits, one["size"], edits, one["needed"], len(words)):
                        out.append((doc, one["item_id"], one["item"], first, b" ".join(words[first:end])))
                columns = list(zip(*out, strict=True)) or [()] * 5
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["doc_id", "item_id", "item", "from", "part"],
                )

    # A table: two steps in Python in one stage would take two workers for each task, and Spark keeps
    # as many for all that follows.
    windows = staged(
        rows.join(found, ["doc_id", "body"]).select("doc_id", "found", "text").mapInArrow(
            cut, "doc_id long, item_id long, item long, from long, part binary"
        ),
        "windows",
    )

    def judge(batches):
        number, own, known = {}, None, None
        for batch in batches:
            scores, firsts, ends = [], [], []
            columns = zip(batch.column("from").to_pylist(), values(batch, "part"), values(batch, "text"), strict=True)
            for start, part, text in columns:
                if text != known:
                    known, number = text, {}
                    own = np.array([number.setdefault(word, len(number)) for word in words_of(text)])
                    times, least = np.bincount(own), least_score(len(own), settings)
                words = np.array([number.get(word, -1) for word in part.split()])
                score = first = end = 0
                if np.minimum(np.bincount(words[words >= 0], minlength=len(times)), times).sum() >= least * len(own):
                    score, first, end = align(own, words, settings)
                share = score / (settings.match * len(own))
                scores.append(share if share >= least else None)
                firsts.append(start + first)
                ends.append(start + end)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("item_id"),
                    pa.array(scores, pa.float64()),
                    pa.array(firsts, pa.int32()),
                    pa.array(ends, pa.int32()),
                ],
                names=["doc_id", "item_id", "score", "first", "end"],
            )

    judged = windows.join(items, ["item_id", "item"]).select("doc_id", "item_id", "from", "part", "text").mapInArrow(
        judge, "doc_id long, item_id long, score double, first int, end int"
    )
    return (
        judged.where("score is not null")
        .groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("score", "first", "end"), F.struct("score", -F.col("first"))).alias("best"))
        .select("doc_id", "item_id", "best.score", "best.first", "best.end")
    )


def drop_leaks(documents: DataFrame, items: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """``documents`` without those in which a test item was found."""
    leaks = find_leaks(documents, items, settings).select("doc_id").distinct()
    return documents.join(leaks, "doc_id", "left_anti").select(columns_of(documents))
