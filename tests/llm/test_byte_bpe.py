import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from stratalake.llm.byte_bpe import Vocabulary, decode, encode
from stratalake.llm.queries import QUERIES
from stratalake.llm.token_counts import count_tokens, recount_edited, redactions

VOCABULARY = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=VOCABULARY.table(), special_tokens={})


def texts():
    r = random.Random(9)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "'s", "'re", "'l", "'", "1", "23", "!", "?!", "漢", "🙂", " ", "\t", "<|endoftext|>", "word"]
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 400))) for _ in range(60)]
    return out + ["", None, " ", "a" * 700, " " * 500 + "x", "'r" * 90, "ab " * 300, ("x" * 50 + " ") * 10]


@pytest.mark.parametrize(("chunk", "overlap"), [(65536, 1024), (40, 20), (64, 64), (33, 8)])
def test_equals_the_library(spark, library, chunk, overlap):
    rows = list(enumerate(texts())) + [(None, "no id"), (7, "same id")]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, ids string, decoded int")
    got = decode(encode(df, VOCABULARY, chunk=chunk, overlap=overlap), VOCABULARY).collect()
    seen = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", list(r.ids), bytes(r.decoded)) for r in got)
    want = [(d if d is not None else -1, t or "", library.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows]
    assert seen == sorted(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(empty, VOCABULARY), VOCABULARY).collect() == []


def test_query_digests(spark, library):
    got = QUERIES["op10_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    known = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    assert len(got) == len(known)
    for row in got:
        ids = library.encode_ordinary(known[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(known[row.doc_id].encode()).hexdigest()


def test_counts_follow_edits(spark, library):
    r = random.Random(3)
    rows = [(i, (t or "") * 12) for i, t in enumerate(texts())] + [(500, None), (501, "")]
    edits = []
    for doc, text in rows:
        cuts = sorted(r.sample(range(len(text or "") + 1), min(6, len(text or "") + 1)))
        for start, end in zip(cuts[::2], cuts[1::2]):
            edits.append((doc, start, end, r.choice(["", " ", "new words", "'s", None, "x" * 40, "\n\n"])))
    edits += [(500, 0, 0, "from nothing"), (501, 5, 9, "past the end"), (None, 0, 1, "x"), (2, None, 1, "x"), edits[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = recount_edited(df, spark.createDataFrame(edits, "doc_id long, start long, end long, replacement string"), VOCABULARY)
    result = {row.doc_id: row for row in got.collect()}
    for doc, text in rows:
        text = text or ""
        assert result[doc].n_tokens == len(library.encode_ordinary(text))
        own = {e for e in edits if e[0] == doc and e[1] is not None}
        for _, start, end, new in sorted(own, key=lambda e: -e[1]):
            text = text[:start] + (new or "") + text[end:]
        assert result[doc].n_tokens_after == len(library.encode_ordinary(text)), doc
        assert result[doc].n_edits == len(own)
        assert result[doc].text == (text if own else None)


@pytest.mark.parametrize("spread", [1, 2, 5])
def test_edits_touch_only_the_text_they_were_found_in(spark, library, spread):
    """One doc_id on several texts, and rows that are repeated."""
    mail, plain = "mail joe@example.org now", "nothing of the kind stands in this text"
    rows = [(1, mail, "x", 7), (1, plain, "y", 8), (1, mail, "z", 9), (2, plain, "x", 1), (None, mail, "x", 2), (1, None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, body string, n_edits int").repartition(spread)
    edits = redactions(df)
    got = recount_edited(df, edits, VOCABULARY).collect()
    count = lambda text: len(library.encode_ordinary(text))
    done = "mail [removed] now"
    want = [(1, count(mail), 1, count(done), done)] * 2 + [(1, count(plain), 0, count(plain), None)]
    want += [(2, count(plain), 0, count(plain), None), (None, count(mail), 0, count(mail), None), (1, 0, 0, 0, None)]
    assert sorted(((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after, r.text) for r in got), key=str) == sorted(want, key=str)


def test_of_overlapping_edits_the_first_counts(spark, library):
    text = "zero one two three four five"
    edits = [(1, 5, 12, "A"), (1, 9, 18, "B"), (1, 5, 8, "C"), (1, 8, 8, "+"), (1, -4, 2, "D"), (1, 24, 99, "E"), (1, 30, 20, "F")]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    frame = spark.createDataFrame(edits, "doc_id long, start long, end long, replacement string")
    row = recount_edited(df, frame, VOCABULARY).first()
    left, out = 0, []
    for start, end, new in sorted((min(max(s, 0), 28), e, n) for _, s, e, n in edits):
        end = max(min(end, 28), start)
        if start >= left:
            out.append((start, end, new))
            left = end
    want = text
    for start, end, new in reversed(out):
        want = want[:start] + new + want[end:]
    assert row.text == want and row.n_edits == len(out) and row.n_tokens_after == len(library.encode_ordinary(want))


def test_only_the_edited_region_is_split(spark):
    text = "some words " * 5000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 30000, 30004, "other")], "doc_id long, start long, end long, replacement string")
    assert recount_edited(df, edits, VOCABULARY).first().n_chars_split < 1500


def test_count_query(spark, library):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    edits = redactions(documents).collect()
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for doc, text in documents.collect():
        own = sorted((e for e in edits if e.doc_id == doc), key=lambda e: -e.start)  # ids are unique here
        assert got[doc].n_tokens == len(library.encode_ordinary(text))
        for e in own:
            text = text[: e.start] + e.replacement + text[e.end :]
        assert (got[doc].n_tokens_after, got[doc].n_edits) == (len(library.encode_ordinary(text)), len(own))
    assert count_tokens(documents.limit(0), VOCABULARY).collect() == []
