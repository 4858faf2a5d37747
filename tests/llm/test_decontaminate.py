import random

import numpy as np
import pytest

from stratalake.llm.decontaminate import (
    Alignment,
    align,
    drop_leaks,
    find_leaks,
    least_score,
    most_edits,
    surviving,
    windows_around,
    words_of,
)
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_score(a, b, s):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = s.match if x == y else -s.mismatch
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] - s.gap, table[i][j - 1] - s.gap)
    return max(map(max, table))


def test_alignment_equals_the_plain_recurrence():
    r = np.random.default_rng(3)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(1, 25)), r.integers(0, 6, r.integers(1, 40))
        score, first, end = align(a, b, Alignment())
        assert score == plain_score(a.tolist(), b.tolist(), Alignment())
        assert score == 0 or plain_score(a.tolist(), b[first:end].tolist(), Alignment()) == score


def brute_force(docs, items, settings=Alignment()):
    """{(doc, item): score} of all pairs, by aligning each text as a whole."""
    out = {}
    for doc, text in docs:
        words = words_of((text or "").encode())
        for item, wanted in items:
            own = words_of((wanted or "").encode())
            number = {w: n for n, w in enumerate(dict.fromkeys(own))}
            if doc is None or item is None or not own or not words:
                continue
            a, b = (np.array([number.get(w, -1) for w in x]) for x in (own, words))
            score = align(a, b, settings)[0] / (settings.match * len(own))
            if score >= least_score(len(own), settings):
                out[doc, item] = max(score, out.get((doc, item), 0))
    return out


def leaks_of(spark, docs, items, settings=Alignment()):
    got = find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        settings,
    ).collect()
    return {(r.doc_id, r.item_id): r.score for r in got}


def edited(words, pattern, r):
    """A copy with edits of some pattern, most of which take it near the limit."""
    other = lambda: f"z{r.randrange(10**6)}"
    n = len(words)
    if pattern == "every third word":
        return [other() if i % 3 == 2 else w for i, w in enumerate(words)]
    if pattern == "every second word of half":
        return [other() if i % 2 and i < n // 2 else w for i, w in enumerate(words)]
    if pattern == "a word between all":
        return [x for w in words for x in (w, other())]
    if pattern == "every fourth word gone":
        return [w for i, w in enumerate(words) if i % 4 != 3]
    if pattern == "every third word gone":
        return [w for i, w in enumerate(words) if i % 3 != 2]
    if pattern == "half":
        return words[n // 4 : n // 4 + n // 2 + 1]
    if pattern == "blocks":
        return [w for i in range(0, n, 9) for w in [*words[i : i + 9], other(), other(), other()]]
    out = list(words)
    for _ in range(int(n * {"random few": 0.1, "random many": 0.33, "random most": 0.5}[pattern])):
        i = r.randrange(len(out))
        out[i : i + 1] = r.choice([[other()], [], [out[i], other()]])
    return out


PATTERNS = [
    "every third word", "every second word of half", "a word between all", "every fourth word gone",
    "every third word gone", "half", "blocks", "random few", "random many", "random most",
]


@pytest.mark.parametrize("settings", [Alignment(), Alignment(seeds=1), Alignment(seeds=9, score=0.4), Alignment(sent=0)])
def test_every_copy_that_reaches_the_score_is_found(spark, settings):
    """Copies of 50-word items by ten patterns of edits, against all pairs."""
    r = random.Random(5)
    common = [f"c{i}" for i in range(15)]
    items = [(i, " ".join(f"i{r.randrange(400)}" if r.random() < 0.5 else r.choice(common) for _ in range(50))) for i in range(6)]
    items += [(90, "three common words"), (91, "c1 c2 c3 c4 c5 c6 c7 c8"), (92, "c1"), (93, "c3 c3 c3 c3 c3 c3 c3 c3 c3 c3")]
    docs = []
    for n in range(120):
        copy = edited(r.choice(items[:6])[1].split(), PATTERNS[n % 10], r)
        around = [[r.choice(common) for _ in range(r.randrange(60))] for _ in range(2)]
        docs.append((n, " ".join(around[0] + copy + around[1])))
    want = brute_force(docs, items, settings)
    assert leaks_of(spark, docs, items, settings) == pytest.approx(want)
    patterns = {PATTERNS[doc % 10] for doc, item in want if item < 6}
    assert {"every third word", "a word between all", "half", "random few", "random many"} <= patterns


def test_no_copy_keeps_fewer_seeds_than_reckoned():
    """Random alignments: pairs with at most one edit between them, against the bound."""
    r = random.Random(1)
    for settings in (Alignment(), Alignment(score=0.3), Alignment(match=1), Alignment(match=3, mismatch=2, gap=1)):
        cost = {"x": settings.mismatch, "d": settings.gap, "i": settings.gap}
        for _ in range(4000):
            size = r.randint(8, 30)
            steps = [r.choice("mmmmxdi") for _ in range(60)]
            used, path = 0, []
            for step in steps:
                if step != "i":
                    if used == size:
                        break
                    used += 1
                path.append(step)
            score = sum(settings.match if s == "m" else -cost[s] for s in path)
            if score < settings.score * settings.match * size:
                continue
            inner = "".join(path).strip("xdi")
            edits = inner.split("m")[1:-1]
            assert len(inner) - inner.count("m") <= most_edits(size, settings)
            assert sum(len(e) <= 1 for e in edits) >= surviving(size, settings)


def test_all_pairs_of_the_smallest_table(spark):
    docs = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.score for r in QUERIES["op7_decontaminate"](spark, SF_DIR).collect()}
    assert got == pytest.approx(brute_force(docs, items)) and got


def test_a_long_text_that_repeats_an_item(spark):
    """Windows of bounded size, and the same result as of the whole."""
    r = random.Random(2)
    item = [f"q{r.randrange(150)}" for _ in range(200)]
    text = " ".join(" ".join(edited(item, "random many", r)) for _ in range(120))
    sizes = [end - first for first, end in windows_around([(i, i % 200) for i in range(0, 24000, 3)], 200, 200, 3, 24000)]
    assert max(sizes) == 800 and len(sizes) < 70
    got = leaks_of(spark, [(1, text)], [(1, " ".join(item))])
    assert got == pytest.approx(brute_force([(1, text)], [(1, " ".join(item))])) and got


def test_repeated_ids_of_items(spark):
    docs = [(1, "a1 a2 a3 a4 a5 a6 a7 a8 a9"), (2, "b1 b2 b3 b4 b5 b6 b7 b8 b9"), (1, "b1 b2 b3 b4 b5 b6 b7 b8 b9")]
    items = [(7, docs[0][1]), (7, docs[1][1]), (8, docs[1][1])]
    assert leaks_of(spark, docs, items) == {(1, 7): 1.0, (2, 7): 1.0, (2, 8): 1.0, (1, 8): 1.0}


def corpus():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7)))
    common = [word() for _ in range(20)]
    items = [(i, " ".join(word() if r.random() < 0.7 else r.choice(common) for _ in range(r.randint(14, 50)))) for i in range(20)]
    docs, leaks = [], set()
    for doc in range(200):
        words = [word() if r.random() < 0.5 else r.choice(common) for _ in range(r.randint(5, 300))]
        if doc % 5 == 0:
            item = r.choice(items)
            copy = item[1].split()
            for _ in range(len(copy) // 10 if doc % 10 == 0 else 0):  # edited copies
                at = r.randrange(len(copy))
                copy[at : at + 1] = r.choice([[], [word()], [copy[at], word()]])
            at = r.randrange(len(words))
            words[at:at] = [w.upper() + r.choice(["", ",", "."]) for w in copy]
            leaks.add((doc, item[0]))
        docs.append((doc, " ".join(words)))
    return docs, items, leaks


@pytest.mark.parametrize("settings", [Alignment(), Alignment(sent=0)])
def test_finds_exact_and_edited_copies_alone(spark, settings):
    docs, items, leaks = corpus()
    documents = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, found int").repartition(3)
    benchmark = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    got = find_leaks(documents, benchmark, settings).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks
    assert all(0.5 <= r.score <= 1 and r.first < r.end for r in got)
    left = drop_leaks(documents, benchmark, settings)
    assert left.columns == documents.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in leaks}


def test_an_item_that_leaked_everywhere(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = [(i, f"start{i} {item} end{i}") for i in range(300)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item), (1, item)], "item_id long, text string"))
    assert sorted((r.doc_id, r.score) for r in got.collect()) == [(i, 1.0) for i in range(300)]


@pytest.mark.parametrize("settings", [Alignment(), Alignment(sent=0)])
def test_cut_copies_that_outnumber_whole_ones(spark, settings):
    item = [f"q{i}" for i in range(50)]
    parts = [item[:26], item[24:], item[12:38]]
    docs = [(i, " ".join([f"start{i}", *parts[i % 3], f"end{i}"])) for i in range(600)]
    docs += [(600, " ".join(item)), (601, " ".join(item[:20]) + " other words")]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for most in (0, 1):  # one kind of part alone, then all three
        some = documents if most else documents.where("doc_id >= 600 or doc_id % 3 = 0")
        got = {r.doc_id: r.score for r in find_leaks(some, items, settings).collect()}
        assert got == {r.doc_id: 1.0 if r.doc_id == 600 else 0.52 for r in some.where("doc_id != 601").collect()}


def test_nulls_short_items_and_empty_tables(spark):
    docs = [(1, "the two words here"), (2, None), (3, ""), (None, "two words"), (1, "the two words here"), (4, "two other words"), (5, "word " * 5000)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "two words"), (2, None), (3, " . "), (None, "two words"), (4, "words")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in find_leaks(documents, items).collect())
    assert got == [(1, 1), (1, 4), (4, 4)]
    assert find_leaks(documents.limit(0), items).collect() == []
    assert find_leaks(documents, items.limit(0)).collect() == []
    assert drop_leaks(documents, items).where("doc_id is null").count() == 1


def test_a_stage_has_one_step_in_python(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))], "doc_id long, text string")
    found = find_leaks(docs, docs.withColumnRenamed("doc_id", "item_id"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert [tuple(row)[:2] for row in found.collect()] == [(1, 1)]
