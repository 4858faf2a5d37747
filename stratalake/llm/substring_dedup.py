"""Removal of repeated word windows, by super-k-mers."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import mixed, parts_of, staged, values, window_hashes, word_hashes


@dataclass(frozen=True)
class Windows:
    """``width``: words in a window. ``anchor``: words in a minimiser. ``longest``: windows in a
    super-k-mer at most. ``part``: super-k-mers that are sorted in one place, about; a bucket of more
    is dealt over several. ``share``: parts whose windows are compared in one place, about. ``chunk``:
    words, or windows, that are sorted together, at least those of a part or share."""

    width: int = 50
    anchor: int = 6
    longest: int = 128
    part: int = 1000
    share: int = 16
    chunk: int = 400_000


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    count = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], forth[width - 1 : width - 1 + count])


def super_kmers(words: list[bytes], settings: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each run of windows that share it."""
    anchors = window_hashes(word_hashes(words), settings.anchor)
    least = sliding_min(anchors, settings.width - settings.anchor + 1)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    counts = np.diff(np.append(starts, len(least)))
    if counts.max() > settings.longest:
        parts = -(-counts // settings.longest)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(starts + counts, parts)
        starts = np.repeat(starts, parts) + within * settings.longest
        counts = np.minimum(ends - starts, settings.longest)
    return starts, counts, least[starts]


def _runs(rows: DataFrame, settings: Windows) -> DataFrame:
    def find(batches):
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(values(batch, "text")):
                words = text.split()
                if len(words) >= settings.width:
                    found.append(super_kmers(words, settings))
                    at.append(np.full(len(found[-1][0]), i))
            if not found:
                continue
            starts, counts, least = (np.concatenate(part) for part in zip(*found, strict=True))
            at = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("body").take(at),
                    pa.array(starts.astype(np.int32)),
                    pa.array(counts.astype(np.int32)),
                    pa.array(least.view(np.int64)),
                ],
                names=["doc_id", "body", "start", "n", "minimiser"],
            )

    return rows.mapInArrow(find, "doc_id long, body long, start int, n int, minimiser long")


def _packed(joined: DataFrame, settings: Windows) -> DataFrame:
    """Each super-k-mer as one string of words."""
    width = settings.width

    def cut(batches):
        for batch in batches:
            for doc, body, runs, text in zip(
                batch.column("doc_id"), batch.column("body"), batch.column("runs"), values(batch, "text"), strict=True
            ):
                runs = runs.values.flatten()
                words = text.split()
                spans = zip(runs[0].to_pylist(), runs[1].to_pylist(), strict=True)
                packed = [b" ".join(words[start : start + n + width - 1]) for start, n in spans]
                size = len(packed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc.as_py()] * size, pa.int64()),
                        pa.array([body.as_py()] * size, pa.int64()),
                        runs[0],
                        runs[2],
                        runs[3],
                        pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "body", "start", "minimiser", "parts", "packed"],
                )

    return joined.mapInArrow(cut, "doc_id long, body long, start int, minimiser long, parts long, packed binary")


def sorted_windows(docs: np.ndarray, packed: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, window, again) of all windows, run by run; ``again`` says that the words also stand in a
    run of a smaller document.

    Windows are sorted by a hash of their words, and those that share one are compared word by
    word with the first of them; should words differ, the windows of that hash are told apart by
    their words themselves.
    """
    number: dict[bytes, int] = {}
    rows = [[number.setdefault(word, len(number)) for word in run.split(b" ")] for run in packed]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    ids = np.fromiter((i for row in rows for i in row), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    run = np.repeat(np.arange(len(rows)), sizes - width + 1)
    window = np.arange(len(run)) - np.repeat(np.cumsum(sizes - width + 1) - (sizes - width + 1), sizes - width + 1)
    at = (ends - sizes)[run] + window
    hashes = window_hashes(mixed(ids.astype(np.uint64)), width)[at]
    order = np.lexsort((docs[run], hashes))
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    differs = np.zeros(len(order), bool)
    for k in range(width):
        differs |= ids[at[order] + k] != ids[at[head] + k]
    again = docs[run[order]] > docs[run[head]]
    if differs.any():
        for value in np.unique(hashes[order][differs]):
            least: dict[bytes, int] = {}
            for j in np.flatnonzero(hashes[order] == value):
                words = ids[at[order[j]] : at[order[j]] + width].tobytes()
                again[j] = least.setdefault(words, docs[run[order[j]]]) < docs[run[order[j]]]
    repeats = np.zeros(len(order), bool)
    repeats[order[again]] = True
    return run, window, repeats


def repeated_windows(docs: np.ndarray, packed: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of the windows whose words also stand in a run of a smaller document."""
    run, window, again = sorted_windows(docs, packed, width)
    return run[again], window[again]


def _spans(run: np.ndarray, window: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run, first word and end of the stretches that neighbouring windows cover."""
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(run)) - 1
    return run[first], window[first], window[last] + width


WHOLE = 2**31 - 1  # the end of a span that covers the whole text


def _window_digests(packed: list[bytes], run: np.ndarray, window: np.ndarray, width: int) -> list[bytes]:
    """128-bit digests of the words of windows that are given run by run."""
    digests, known, words = [], None, []
    for r, w in zip(run.tolist(), window.tolist(), strict=True):
        if r != known:
            known, words = r, packed[r].split(b" ")
        digests.append(hashlib.blake2b(b" ".join(words[w : w + width]), digest_size=16).digest())
    return digests


BLOCK = 128  # windows in a row at most, so that rows stay as small as texts


def _sorted_parts(packed: DataFrame, settings: Windows) -> DataFrame:
    """(doc_id, body, first, end, minimiser, share, digest, docs, bodies, places) of every part of a
    bucket.

    Without a digest: spans that repeat a smaller document of the same part. With one: windows that
    repeat none there, if the bucket has other parts to be compared with, ``BLOCK`` to a row at most,
    their digests in one string. They are dealt over the shares of their bucket by their digest.
    """
    width = settings.width

    kinds = {name: pa.int64() for name in ("doc_id", "body", "minimiser", "share")}
    kinds |= {"first": pa.int32(), "end": pa.int32(), "digest": pa.binary(), "places": pa.list_(pa.int32())}
    kinds |= {"docs": pa.list_(pa.int64()), "bodies": pa.list_(pa.int64())}

    def table(**columns):
        """A batch of the given columns, the others null."""
        size = len(next(iter(columns.values())))
        arrays = [pa.array(columns[c], kind) if c in columns else pa.nulls(size, kind) for c, kind in kinds.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def judged(rows):
        doc, body, start, parts, text, minimiser = (list(column) for column in zip(*rows, strict=True))
        docs, bodies, starts = np.array(doc, np.int64), np.array(body, np.int64), np.array(start, np.int64)
        run, window, again = sorted_windows(docs, text, width)
        if again.any():
            at, first, end = _spans(run[again], window[again], width)
            yield table(doc_id=docs[at], body=bodies[at], first=starts[at] + first, end=starts[at] + end)
        parts = np.array(parts, np.int64)
        open_ = ~again & (parts > 1)[run]
        if open_.any():
            at, window = run[open_], window[open_]
            digests = np.array(_window_digests(text, at, window, width), "S16").view("<u8").reshape(-1, 2)
            shares = (digests[:, 0] % (-(-parts[at] // settings.share)).astype(np.uint64)).astype(np.int64)
            buckets = np.array(minimiser, np.int64)[at]
            order = np.lexsort((shares, buckets))
            at, window, digests, shares, buckets = (x[order] for x in (at, window, digests, shares, buckets))
            new = np.concatenate([[True], (buckets[1:] != buckets[:-1]) | (shares[1:] != shares[:-1])])
            group = np.flatnonzero(new)
            blocks = np.concatenate(
                [np.arange(i, end, BLOCK) for i, end in zip(group, np.append(group[1:], len(at)), strict=True)]
            )
            cut = [slice(i, end) for i, end in zip(blocks, np.append(blocks[1:], len(at)), strict=True)]
            yield table(
                minimiser=buckets[blocks],
                share=shares[blocks],
                digest=[digests[x].tobytes() for x in cut],
                docs=[docs[at[x]] for x in cut],
                bodies=[bodies[at[x]] for x in cut],
                places=[(starts[at[x]] + window[x]).astype(np.int32) for x in cut],
            )

    def count(batches):
        ready, part, key, words = [], [], None, 0

        def compared():  # sorted: more than one document, or other parts
            return part and (part[0][0] != part[-1][0] or part[0][3] > 1)

        for batch in parts_of(batches, 1024):
            names = ("minimiser", "part", "doc_id", "body", "start", "parts", "packed")
            for minimiser, number, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (minimiser, number) != key:
                    if compared():
                        ready += part
                        if words >= settings.chunk:
                            yield from judged(ready)
                            ready, words = [], 0
                    part, key = [], (minimiser, number)
                part.append((*row, minimiser))
                words += row[4].count(b" ") + 1
        if compared():
            ready += part
        if ready:
            yield from judged(ready)

    number = F.pmod(F.xxhash64("doc_id", "body", "start"), F.col("parts"))
    dealt = packed.withColumn("part", number).repartition("minimiser", "part")
    return dealt.sortWithinPartitions("minimiser", "part", "doc_id").mapInArrow(
        count,
        "doc_id long, body long, minimiser long, share long, first int, end int, digest binary,"
        " places array<int>, docs array<long>, bodies array<long>",
    )


def repeats_among(digests: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which of the windows have the digest, two numbers, of a window of a smaller document."""
    order = np.lexsort((docs, digests[:, 1], digests[:, 0]))
    digests, docs = digests[order], docs[order]
    new = np.concatenate([[True], (digests[1:] != digests[:-1]).any(axis=1)])
    least = docs[np.maximum.accumulate(np.where(new, np.arange(len(docs)), 0))]
    again = np.zeros(len(docs), bool)
    again[order[docs > least]] = True
    return again


def _across_parts(left: DataFrame, settings: Windows) -> DataFrame:
    """(doc_id, body, first, end) of the spans that repeat a smaller document of another part."""
    width = settings.width

    def judged(rows):
        digests, *columns = zip(*rows, strict=True)
        docs, bodies, places = map(np.concatenate, columns)
        again = repeats_among(np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2), docs)
        if again.any():
            order = np.lexsort((places[again], bodies[again], docs[again]))
            docs, bodies, places = (x[again][order] for x in (docs, bodies, places))
            new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (bodies[1:] != bodies[:-1])])
            text, first, end = _spans(np.cumsum(new) - 1, places, width)
            at = np.flatnonzero(new)[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs[at]), pa.array(bodies[at]), pa.array(first, pa.int32()), pa.array(end, pa.int32())],
                names=["doc_id", "body", "first", "end"],
            )

    def compare(batches):
        ready, key, size = [], None, 0
        for batch in parts_of(batches, 1024):
            keys = zip(batch.column("minimiser").to_pylist(), batch.column("share").to_pylist(), strict=True)
            lists = (batch.column(c) for c in ("docs", "bodies", "places"))
            for name, digest, *row in zip(keys, values(batch, "digest"), *lists, strict=True):
                if name != key and size >= settings.chunk:
                    yield from judged(ready)
                    ready, size = [], 0
                ready.append((digest, *(x.values.to_numpy() for x in row)))
                key, size = name, size + len(row[0])
        if ready:
            yield from judged(ready)

    dealt = left.repartition("minimiser", "share").sortWithinPartitions("minimiser", "share")
    return dealt.mapInArrow(compare, "doc_id long, body long, first int, end int")


def _repeats(packed: DataFrame, settings: Windows) -> DataFrame:
    """(doc_id, body, first, end) of the spans that repeat a smaller document.

    Each part of a bucket leaves one document's copies of a window at most, so that windows meet
    across parts by their digest as often as the bucket has parts, however often they occur.
    """
    judged = staged(_sorted_parts(packed, settings), "parts")
    left = judged.where("digest is not null").select("minimiser", "share", "digest", "docs", "bodies", "places")
    across = _across_parts(left, settings)
    return judged.where("digest is null").select(across.columns).unionByName(across)


COPY_GROUPS = 32


def _copies(rows: DataFrame) -> DataFrame:
    """(doc_id, body) of the rows whose text, by its 128-bit digest, a smaller document has too.

    All their windows are repeats, and whatever repeats one of them repeats that smaller document,
    so they need not travel. The copies of one text are dealt over ``COPY_GROUPS`` keys.
    """
    texts = rows.select("doc_id", "body", F.unhex(F.md5("text")).alias("digest"))
    least = texts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    groups = F.sequence(F.lit(0), F.lit(COPY_GROUPS - 1)).cast("array<long>")
    repeated = least.where("least < most").select("digest", "least", F.explode(groups).alias("dealt"))
    dealt = texts.withColumn("dealt", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_GROUPS)).cast("long"))
    return dealt.join(repeated, ["digest", "dealt"]).where("doc_id > least").select("doc_id", "body").distinct()


def remove_repeats(documents: DataFrame, settings: Windows = Windows()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``documents`` (doc_id, text): the words,
    joined by a space, without those covered by a window of ``settings.width`` words that also
    starts in a document with a smaller doc_id. All windows are judged on the given texts.

    1. Windows that follow each other and have the same minimiser (smallest hash of ``anchor``
       words) form a super-k-mer. Equal windows have equal minimisers, so only super-k-mers whose
       minimiser occurs in two documents can hold a repeat; the others go no further.
    2. Those travel, except from exact copies of a smaller document, as one packed string to the
       bucket of their minimiser. A bucket has a part for every ``settings.part`` strings, and its
       strings are dealt over the parts by document and place. Sorting a part finds equal windows.
    3. Windows of buckets with several parts that no smaller document of their part has are
       compared across parts by a 128-bit digest of their words. They travel in blocks, by bucket and
       share of the digests.
    4. The spans found join the texts again.

    Words are runs without ASCII white space. Null texts have none. A row with a null doc_id loses
    nothing and takes nothing from others. Rows that repeat a doc_id do not compete with each other;
    each is judged by its own text. Other columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("body", F.xxhash64("text"))
    copies = staged(_copies(rows.where("doc_id is not null")), "copies")
    runs = staged(_runs(rows.where("doc_id is not null"), settings), "super-k-mers")
    shared = (
        runs.groupBy("minimiser")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("all"))
        .where("low < high")
        .select("minimiser", F.ceil(F.col("all") / settings.part).alias("parts"))
    )
    travelling = (
        runs.join(shared, "minimiser")
        .groupBy("doc_id", "body")
        .agg(F.collect_set(F.struct("start", "n", "minimiser", "parts")).alias("runs"))
        .join(copies, ["doc_id", "body"], "left_anti")
    )
    joined = rows.join(travelling, ["doc_id", "body"]).select("doc_id", "body", "runs", "text")
    spans = _repeats(_packed(joined, settings), settings)
    spans = spans.unionByName(copies.select("*", F.lit(0).alias("first"), F.lit(WHOLE).alias("end")))
    of_document = spans.groupBy("doc_id", "body").agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    width = settings.width

    def remove(batches):
        for batch in parts_of(batches, 256):
            n_words, n_removed, kept = [], [], []
            for spans, text in zip(batch.column("spans"), values(batch, "text"), strict=True):
                words = text.split()
                n_words.append(len(words))
                if spans.is_valid and len(words) >= width:
                    first, end = (x.to_numpy() for x in spans.values.flatten())
                    end = np.minimum(end, len(words))
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, first, 1)
                    np.add.at(edges, end, -1)
                    free = np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()
                    words = [words[i] for i in free]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept)],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return rows.join(of_document, ["doc_id", "body"], "left").select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept string"
    )
