import random

import numpy as np
import pytest

from stratalake.llm import substring_dedup
from stratalake.llm.substring_dedup import Windows, remove_repeats, repeated_windows, sliding_min


def brute_force(rows, width):
    first = {}
    for doc, text in rows:
        if doc is not None:
            words = (text or "").encode().split()
            for i in range(len(words) - width + 1):
                key = tuple(words[i : i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[i : i + width])] < doc:
                gone |= set(range(i, i + width))
        out.append((doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(5)
    passages = [" ".join(r.choice("abcdefgh") + str(r.randrange(40)) for _ in range(r.randint(8, 60))) for _ in range(6)]
    rows = []
    for doc in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else " ".join(f"u{r.randrange(10**6)}" for _ in range(12)) for _ in range(5)]
        rows.append((doc, "\n".join(parts)))
    rows += [(70, "ha " * 400), (71, "ha " * 300), (72, None), (73, ""), (74, " \t\n"), (75, "é x " * 30)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (80, rows[4][1]), (80, rows[5][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [
    Windows(width=10, anchor=3),
    Windows(width=10, anchor=2, longest=4, part=5, chunk=50),
    Windows(width=10, anchor=10, part=1),
    Windows(width=10, anchor=3, part=100_000),
])
def test_equals_all_windows(spark, settings):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeats(df, settings).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(rows, settings.width)


def test_fifty_words(spark):
    fifty = " ".join(f"w{i}" for i in range(50))
    rows = [(1, "x " + fifty), (2, fifty + " y"), (3, fifty[:-3])]
    got = {r.doc_id: (r.n_removed, r.kept) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][0] == 0 and got[2] == (50, "y") and got[3][0] == 0


def test_a_passage_of_all_documents(spark):
    r = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(doc, f"{' '.join(f'u{r.randrange(10**6)}' for _ in range(8))} {passage} v{doc} " + f"w{doc % 9} " * 12) for doc in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for part in (7, 100):
        got = remove_repeats(df, Windows(width=10, anchor=3, part=part)).collect()
        assert sorted(map(tuple, got), key=repr) == brute_force(rows, 10)


def test_parts_hand_on_no_more_than_a_document_of_each_window(spark):
    words = " ".join(f"p{i}" for i in range(10))
    rows = [(doc, 0, 0, 1, 5, words.encode()) for doc in range(1000)]
    packed = spark.createDataFrame(rows, "doc_id long, body long, start int, minimiser long, parts long, packed binary")
    judged = substring_dedup._sorted_parts(packed, Windows(width=10, anchor=3)).collect()
    assert 1 <= sum(x.digest is not None for x in judged) <= 5 and len(judged) == 1000


def test_a_repeated_line_is_handed_on_once(spark):
    rows = [(doc, doc, start, 1, 50, b" ".join([b"ha"] * 15)) for doc in (1, 2) for start in range(0, 400, 6)]
    packed = spark.createDataFrame(rows, "doc_id long, body long, start int, minimiser long, parts long, packed binary")
    judged = substring_dedup._sorted_parts(packed.coalesce(1), Windows(width=10, anchor=3, chunk=10**6)).collect()
    handed_on = [x for x in judged if x.digest is not None]
    assert len(handed_on) <= 8 and sum(len(x.places) for x in handed_on) >= 67 * 6
    got = substring_dedup._repeats(packed, Windows(width=10, anchor=3)).collect()
    assert {x.doc_id for x in got} == {2}
    covered = {i for x in got for i in range(x.first, x.end)}
    assert covered == set(range(0, 396 + 15))


def test_windows_of_near_copies_are_handed_on_in_blocks(spark):
    r = random.Random(3)
    rows = []
    for doc in range(400):  # each with a changed word of its own, so that few windows are the same
        words = [f"p{i}" for i in range(40)]
        words[r.randrange(18)] = words[-1 - r.randrange(18)] = f"u{doc}"
        rows.append((doc, doc, 0, 1, 40, " ".join(words).encode()))
    packed = spark.createDataFrame(rows, "doc_id long, body long, start int, minimiser long, parts long, packed binary")
    small = Windows(width=10, anchor=3, share=4, chunk=100)
    judged = substring_dedup._sorted_parts(packed, small).collect()
    assert len(judged) < 3 * len(rows)  # of 31 windows each
    for settings in (small, Windows(width=10, anchor=3, chunk=100)):
        want = {(doc, i) for doc, *_, text in rows for i in range(31) if again(rows, text.split()[i : i + 10], doc)}
        got = {(x.doc_id, i) for x in substring_dedup._repeats(packed, settings).collect() for i in range(x.first, x.end - 9)}
        assert got == want


def again(rows, window, doc):
    text = b" %b " % b" ".join(window)
    return any(text in b" %b " % packed for other, *_, packed in rows if other < doc)


def test_collisions_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring_dedup, "window_hashes", lambda h, width: np.zeros(len(h) - width + 1, np.uint64))
    run, window = repeated_windows(np.array([1, 2, 3]), [b"a b c", b"b c d", b"x a b c"], 3)
    assert list(zip(run.tolist(), window.tolist())) == [(2, 1)]


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 50, 101).astype(np.uint64)
    for width in (1, 2, 7, 100, 101):
        assert sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(len(x) - width + 1)]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, body string, spans int")
    assert remove_repeats(empty).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    clash = spark.createDataFrame([(1, text, "b", 1), (2, text, "c", 2)], "doc_id long, text string, body string, spans int")
    assert sorted((r.doc_id, r.n_removed) for r in remove_repeats(clash).collect()) == [(1, 0), (2, 60)]
