import random
import re

import numpy as np

from stratalake.llm.quality_rules import COUNTS, IsolationForest, count_rules, features, judge_quality, tree_samples


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_counts_equal_their_definition():
    r = random.Random(1)
    parts = ["a", "b", "é漢", " ", "\n", "\n\n", "#", "a b c", "\x0b", "\x1c", "same line\n", "|", "\r", "", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(300)] + ["", " ", "x" * 40000]
    for text in texts:
        assert count_rules(text.encode())[:5] == plain_counts(text), repr(text)


def test_isolation_forest_finds_what_lies_apart():
    random_ = np.random.default_rng(0)
    rows = np.concatenate([random_.normal(size=(2000, 3)), [[9.0, 9, 9]]])
    scores = IsolationForest.fit(rows).score(rows)
    assert scores.argmax() == 2000 and scores[2000] > 0.7 > np.quantile(scores, 0.99)
    same = np.ones((50, 3))
    assert len(set(IsolationForest.fit(same).score(same))) == 1


def test_each_tree_draws_from_all_rows(spark):
    statistics = spark.range(20000).selectExpr("id as doc_id", *(f"id as {c}" for c in COUNTS))
    samples = tree_samples(statistics, 200, 64)
    assert all(len(set(sample[:, 0])) == len(sample) == 64 for sample in samples)
    assert len({n for sample in samples for n in sample[:, 0]}) > 8192
    again = tree_samples(statistics.repartition(9), 200, 64)
    assert all((a == b).all() for a, b in zip(samples, again, strict=True))
    same = statistics.where("doc_id < 1").crossJoin(spark.range(5000)).select("doc_id", *COUNTS)
    assert {len(sample) for sample in tree_samples(same, 5, 64)} <= {0, 64}
    assert {len(sample) for sample in tree_samples(statistics.where("doc_id < 40"), 5, 64)} == {40}


def documents(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        bad = i % 10 == 0
        words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(r.randint(60, 200))]
        rows.append((i, " ".join(w + "#%*" for w in words) if bad else " ".join(words), 1, "x"))
        labels.append((i, 0 if bad else 1))
    rows += [(900, None, 1, "x"), (901, "", 1, "x"), (902, "few words", 1, "x"), (903, "a b c " * 100, 1, "x"), (None, rows[1][1], 1, "x"), rows[2]]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, anomaly string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_verdicts(spark):
    docs, labels = documents(spark)
    got = judge_quality(docs, labels).collect()
    assert len(got) == 306
    by_id = {r.doc_id: r for r in got}
    for i in (900, 901, 902, 903):
        assert by_id[i].base_failed and not by_id[i].kept
    good = [r for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 10]
    assert all(not r.base_failed and r.kept for r in good)
    assert sum(not by_id[i].kept for i in range(0, 300, 10)) > 15
    again = {r.doc_id: r.anomaly for r in judge_quality(docs.repartition(7), labels).collect()}
    assert again == {r.doc_id: r.anomaly for r in got}


def test_without_labels_and_empty(spark):
    docs, labels = documents(spark)
    kept = judge_quality(docs, labels.limit(0)).where("kept").count()
    assert kept == 302
    assert judge_quality(docs.limit(0), labels).collect() == []
    assert features(np.zeros((1, len(COUNTS)))).shape == (1, 4)
