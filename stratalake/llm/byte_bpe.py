"""Byte-level BPE by overlapping chunks, and decoding."""

from __future__ import annotations

import base64
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from stratalake.llm.common import columns_of, map_batches, new_names, values


MOST_IDS, MOST_ROWS = 1_000_000, 256  # in a batch that a task hands on
AHEAD = 3  # characters after a boundary that the match before it may depend on


@dataclass(frozen=True)
class Vocabulary:
    """``ranks``: content of a rank file (base64 bytes and rank a line); ``pattern`` splits a text
    into the pieces that are encoded one by one."""

    ranks: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def table(self) -> dict[bytes, int]:
        lines = map(bytes.split, self.ranks.splitlines())
        return {base64.b64decode(token): int(rank) for token, rank in lines}


class PieceIds(dict):
    """Ids of pieces; forgets them when there are too many, as vocabularies of corpora have no bound."""

    MOST = 200_000

    def __init__(self, vocabulary: Vocabulary):
        # One piece is one match of this pattern, so the library merges it as a whole.
        self.whole = tiktoken.Encoding(
            "pieces", pat_str=r"[\s\S]+", mergeable_ranks=vocabulary.table(), special_tokens={}
        )

    def __missing__(self, piece: str) -> list[int]:
        ids = self.whole.encode_ordinary(piece)
        if len(piece) <= 64:
            if len(self) >= self.MOST:
                self.clear()
            self[piece] = ids
        return ids


def _with_ids(rows: DataFrame, vocabulary, column: str, upto: str | None = None) -> DataFrame:
    """``rows`` and the column ``ids`` of the texts in ``column``, of the pieces within their first
    ``upto`` characters if that is given; the rest is there to be looked at."""
    schema = StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType()))])

    def with_lists(rows, ids: list[np.ndarray]):
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "ids"])

    def encode(batches):
        known = PieceIds(Vocabulary(*vocabulary.value))
        pieces = regex.compile(vocabulary.value[1])
        for batch in batches:
            done, ids, size = 0, [], 0
            ends_at = batch.column(upto).to_pylist() if upto else repeat(None)
            for text, end in zip(values(batch, column), ends_at):
                found = pieces.findall(text.decode())
                if end is not None:
                    found = found[: bisect_right(list(accumulate(map(len, found))), end)]
                ids.append(np.fromiter(chain.from_iterable(map(known.__getitem__, found)), np.int32))
                size += len(ids[-1])
                if size >= MOST_IDS or len(ids) >= MOST_ROWS:
                    yield with_lists(batch.slice(done, len(ids)), ids)
                    done, ids, size = done + len(ids), [], 0
            yield with_lists(batch.slice(done), ids)

    return map_batches(rows, encode, schema)


def _stitched(long: DataFrame, vocabulary, chunk: int, overlap: int) -> DataFrame:
    """(key, i, upto, piece): long texts between boundaries that are known to be right. A piece has
    ``upto`` characters, and those that follow it as far as a match may look.

    A chunk starts anywhere, so its first boundaries may be off. From a true boundary on, though,
    how a text splits depends on what follows only. So the first boundary that a chunk and the
    next one have in common inside their overlap is a true one if those of the first are, and from
    there on the second is right. Boundaries are left out where the end of a chunk could have
    cut off what a match looks at.
    """
    count = F.ceil(F.length("text") / F.lit(float(chunk))).cast("int")
    chunks = long.select(
        "key", F.length("text").alias("size"), "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("i")
    ).select("key", "size", "i", F.expr(f"substring(text, i * {chunk} + 1, {chunk + overlap})").alias("chunk"))

    def split(batches):
        pieces = regex.compile(vocabulary.value[1])
        for batch in batches:
            heads, tails = [], []
            for i, text in zip(batch.column("i").to_pylist(), values(batch, "chunk"), strict=True):
                text = text.decode()
                ends = np.fromiter((found.end() for found in pieces.finditer(text)), np.int64)
                ends = ends[ends <= len(text) - AHEAD]
                heads.append((ends[ends < overlap] + i * chunk).tolist())
                tails.append((ends[ends >= chunk] + i * chunk).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("key", "size", "i", "chunk")),
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(tails, pa.list_(pa.int64())),
                ],
                names=["key", "size", "i", "chunk", "head", "tail"],
            )

    order = Window.partitionBy("key").orderBy("i")
    seams = (
        chunks.repartition("key", "i")
        .mapInArrow(split, "key string, size int, i int, chunk string, head array<long>, tail array<long>")
        .withColumn("next", F.lead("head").over(order))
        .withColumn("to", F.array_min(F.array_intersect("tail", "next")))
        .withColumn("last", F.col("next").isNull())
        .withColumn("to", F.when(F.col("last"), F.col("size").cast("long")).otherwise(F.col("to")))
        .withColumn("from", F.when(F.col("i") == 0, F.lit(0)).otherwise(F.lag("to").over(order)))
    )
    return seams.select(
        "key",
        "i",
        (F.col("to") - F.col("from")).cast("int").alias("upto"),
        F.expr(f"substring(chunk, cast(from - i * {chunk} + 1 as int), cast(to - from + {AHEAD} as int))").alias("piece"),
    )


def encode(
    documents: DataFrame, vocabulary: Vocabulary, *, chunk: int = 65536, overlap: int = 1024
) -> DataFrame:
    """``documents`` with the column ``ids`` (array<int>) of each ``text``, as the library's
    ``encode_ordinary`` gives them. Every match of the pattern is encoded by itself.

    Texts longer than ``chunk`` characters are cut into chunks that overlap, split side by side,
    stitched where the boundaries of neighbours agree, and the stitched parts encoded side by side.
    A text with a match longer than the overlap has no such place and is encoded as one.

    Null and empty texts get no ids. Rows are independent, repeated ones included; rows with the
    same long text share its work. A column named ``ids`` is replaced, the others are passed on.
    """
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))  # bounded: one rank file
    rows = documents.drop("ids")
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = _with_ids(rows.where(~is_long), shared, "text")

    (key,) = new_names(documents, "key")
    long = rows.where(is_long).withColumn(key, F.sha2("text", 256))
    texts = long.select(F.col(key).alias("key"), "text").dropDuplicates(["key"])
    parts = _with_ids(_stitched(texts, shared, chunk, overlap), shared, "piece", "upto")
    whole = (
        parts.groupBy("key")
        .agg(
            F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("parts"),
            F.bool_and(F.col("piece").isNotNull()).alias("stitched"),
        )
        .where("stitched")
        .select(F.col("key").alias(key), F.flatten("parts.ids").alias("ids"))
    )
    joined = long.join(whole, key, "left")
    columns = columns_of(rows)
    done = joined.where("ids is not null").select(*columns, "ids")
    apart = _with_ids(joined.where("ids is null").select(*columns), shared, "text")
    return short.unionByName(done).unionByName(apart)


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with the column ``decoded`` (binary): the bytes of ``ids``, put together.

    Null ids decode to no bytes; an id outside the vocabulary is an error. Bytes need not be valid
    UTF-8 unless the ids stand for a whole text. A column named ``decoded`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))
    rows = rows.drop("decoded")
    schema = StructType([*rows.schema.fields, StructField("decoded", BinaryType())])

    def join(batches):
        table = {rank: token for token, rank in Vocabulary(*shared.value).table().items()}
        for whole in batches:
            for at in range(0, whole.num_rows, MOST_ROWS):
                batch = whole.slice(at, MOST_ROWS)
                texts = [
                    b"".join(map(table.__getitem__, one.values.to_numpy().tolist())) if one.is_valid else b""
                    for one in batch.column("ids")
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"]
                )

    return map_batches(rows, join, schema)


def digest_of_ids(ids):
    """SHA-256 of the decimal ids, joined by a space."""
    return F.sha2(F.array_join(F.coalesce(ids, F.array().cast("array<int>")).cast("array<string>"), " "), 256)
