"""Token counts that follow edits, by segment trees over pre-tokens."""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.byte_bpe import AHEAD, PieceIds, Vocabulary
from stratalake.llm.common import staged, values
from stratalake.llm.secret_scan import Rule

LEAF = 64  # pre-tokens in a leaf
REGION = 256  # characters beyond an edit that are split at first


class PieceCounts(PieceIds):
    """Numbers of tokens of pieces."""

    def __missing__(self, piece: str) -> int:
        count = len(self.whole.encode_ordinary(piece))
        if len(piece) <= 64:
            if len(self) >= self.MOST:
                self.clear()
            self[piece] = count
        return count


class SegmentTree:
    """Characters and tokens of leaves, and the sums of all subtrees: node ``i`` of ``sums`` holds
    those of its children ``2 i`` and ``2 i + 1``, the root is 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = len(chars)
        self.first = 1 << max(self.leaves - 1, 0).bit_length()
        self.sums = np.zeros((2 * self.first, 2), np.int64)
        self.sums[self.first : self.first + self.leaves, 0] = chars
        self.sums[self.first : self.first + self.leaves, 1] = tokens
        level = self.first
        while level > 1:
            level //= 2
            self.sums[level : 2 * level] = self.sums[2 * level : 4 * level].reshape(-1, 2, 2).sum(axis=1)

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins; past the end, the last leaf."""
        node, begin = 1, 0
        while node < self.first:
            node *= 2
            if position >= begin + self.sums[node, 0] and self.sums[node + 1, 0] > 0:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.first, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.first + leaf
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


def build_tree(text: str, pieces: regex.Pattern, counts: PieceCounts) -> SegmentTree:
    found = pieces.findall(text)
    if not found:
        return SegmentTree([0], [0])
    starts = np.arange(0, len(found), LEAF)
    chars = np.add.reduceat(np.fromiter(map(len, found), np.int64, len(found)), starts)
    tokens = np.add.reduceat(np.fromiter(map(counts.__getitem__, found), np.int64, len(found)), starts)
    return SegmentTree(chars.tolist(), tokens.tolist())


def apply_edit(
    tree: SegmentTree, text: str, start: int, end: int, new: str, pieces: regex.Pattern, counts: PieceCounts
) -> tuple[str, int]:
    """The edited text and the number of characters that were split again; ``tree`` follows.

    How a text splits from a boundary on depends only on what follows. So splitting starts at the
    last leaf that begins AHEAD characters before the edit, and stops at the first boundary
    after it that was the beginning of a leaf before: from there on nothing has changed.
    """
    edited = text[:start] + new + text[end:]
    shift = len(edited) - len(text)
    leaf, begin = tree.leaf_at(max(start - AHEAD, 0))
    old_begins, position, last = [], begin, leaf
    reach = max(REGION, 8 * LEAF)
    while True:
        while last < tree.leaves and position <= end + reach:
            position += int(tree.sums[tree.first + last, 0])
            last += 1
            old_begins.append(position)
        at_end = last >= tree.leaves
        part = edited[begin : len(edited) if at_end else position + shift]
        found = pieces.findall(part)
        ends = list(accumulate(map(len, found), initial=begin))
        sure = len(edited) if at_end else begin + len(part) - AHEAD
        known = set(ends)
        stop = None
        for index, old in enumerate(old_begins):
            if old >= end and old + shift in known and (old + shift <= sure or at_end) and old + shift >= start + len(new):
                stop = index
                break
        if stop is not None:
            break
        reach *= 4
    found = found[: bisect_right(ends, old_begins[stop] + shift) - 1]
    share = -(-len(found) // (stop + 1)) if found else 0
    for offset in range(stop + 1):
        own = found[offset * share : (offset + 1) * share]
        tree.set(leaf + offset, sum(map(len, own)), sum(map(counts.__getitem__, own)))
    return edited, sum(map(len, found))


def count_tokens(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, body, n_tokens, leaf_chars, leaf_tokens): the segment tree of every text.

    Null texts count as empty. ``body`` is a hash of the text that the tree belongs to.
    """
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))

    def build(batches):
        counts, pieces = PieceCounts(Vocabulary(*shared.value)), regex.compile(shared.value[1])
        for batch in batches:
            tokens, leaf_chars, leaf_tokens = [], [], []
            for text in values(batch, "text"):
                tree = build_tree(text.decode(), pieces, counts)
                own = tree.sums[tree.first : tree.first + tree.leaves]
                tokens.append(tree.tokens)
                leaf_chars.append(own[:, 0])
                leaf_tokens.append(own[:, 1])
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("body"),
                    pa.array(tokens, pa.int64()),
                    pa.array(leaf_chars, lists),
                    pa.array(leaf_tokens, lists),
                ],
                names=["doc_id", "body", "n_tokens", "leaf_chars", "leaf_tokens"],
            )

    return _rows(documents).mapInArrow(
        build, "doc_id long, body long, n_tokens long, leaf_chars array<long>, leaf_tokens array<long>"
    )


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("body", F.xxhash64("text"))


def recount_edited(
    documents: DataFrame, edits: DataFrame, vocabulary: Vocabulary, trees: DataFrame | None = None
) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_chars_split, text) for every document.

    ``edits``: (doc_id, start, end, replacement) in code points of the original text, end exclusive,
    and, if the same doc_id stands on several texts, ``body``, the hash of the text an edit is meant
    for (as ``redactions`` gives it). Without ``body`` all texts of a doc_id get its edits. They are
    clipped to the text; of edits that overlap the one that starts first counts, of those that start
    together the shortest. They are applied from the last to the first, each splitting and encoding
    only around itself. ``trees``: the result of ``count_tokens`` on ``documents`` if it is at hand.
    Documents without edits are not touched; null replacements delete, and edits with a null doc_id,
    body, start or end are left out. A repeated edit counts once.
    """
    trees = staged(count_tokens(documents, vocabulary), "trees") if trees is None else trees
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))
    meant_for = ["doc_id", "body"] if "body" in edits.columns else ["doc_id"]
    given = [F.col(name).isNotNull() for name in [*meant_for, "start", "end"]]
    of_document = staged(
        edits.where(reduce(lambda x, y: x & y, given))
        .select(*meant_for, F.struct("start", "end", F.coalesce("replacement", F.lit("")).alias("new")).alias("edit"))
        .groupBy(*meant_for)
        .agg(F.sort_array(F.collect_set("edit")).alias("edits")),
        "edits",
    )
    edited = _rows(documents).join(of_document, meant_for).join(
        trees.dropDuplicates(["doc_id", "body"]), ["doc_id", "body"]
    )

    def recount(batches):
        counts, pieces = PieceCounts(Vocabulary(*shared.value)), regex.compile(shared.value[1])
        for batch in batches:
            applied, after, split, texts = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("leaf_chars", "leaf_tokens", "edits"))
            for chars, tokens, edits, text in zip(*columns, values(batch, "text"), strict=True):
                tree, text, again, apart = SegmentTree(chars, tokens), text.decode(), 0, []
                for edit in edits:
                    start = min(max(edit["start"], 0), len(text))
                    end = max(min(edit["end"], len(text)), start)
                    if not apart or start >= apart[-1][1]:
                        apart.append((start, end, edit["new"]))
                for start, end, new in reversed(apart):
                    text, chars_again = apply_edit(tree, text, start, end, new, pieces, counts)
                    again += chars_again
                applied.append(len(apart))
                after.append(tree.tokens)
                split.append(again)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_tokens"),
                    pa.array(applied, pa.int64()),
                    pa.array(after, pa.int64()),
                    pa.array(split, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_split", "text"],
            )

    done = edited.select("doc_id", "n_tokens", "leaf_chars", "leaf_tokens", "edits", "text").mapInArrow(
        recount, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars_split long, text string"
    )
    same = trees.join(of_document, meant_for, "left_anti").select(
        "doc_id", "n_tokens", F.lit(0).cast("long").alias("n_edits"), F.col("n_tokens").alias("n_tokens_after"),
        F.lit(0).cast("long").alias("n_chars_split"), F.lit(None).cast("string").alias("text"),
    )
    return done.unionByName(same)


# E-mail addresses and long hexadecimal numbers, which are what personal data are most often made of.
PERSONAL = (
    Rule("email", r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]{1,64}@[A-Za-z0-9.-]+", needs="@"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)


def redactions(
    documents: DataFrame, rules: tuple[Rule, ...] = PERSONAL, replacement: str = "[removed]"
) -> DataFrame:
    """Edits (doc_id, body, start, end, replacement) that replace what the rules find; of findings
    that overlap the first one counts. ``body`` is a hash of the text in which they were found."""

    def find(batches):
        ready = [(rule, re.compile(rule.pattern, rule.flags)) for rule in rules]
        for batch in batches:
            found = []
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), values(batch, "text"), strict=True)
            for doc, body, text in rows:
                text, done = text.decode(), 0
                for start, end in sorted(span for rule, compiled in ready for span in rule.spans(text, compiled)):
                    if start >= done:
                        found.append((doc, body, start, end))
                        done = end
            columns = zip(*found, strict=True) if found else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], names=["doc_id", "body", "start", "end"]
            )

    edits = _rows(documents).mapInArrow(find, "doc_id long, body long, start long, end long")
    return edits.withColumn("replacement", F.lit(replacement))
