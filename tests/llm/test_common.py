import numpy as np

from stratalake.llm.common import hash_sample, window_hashes


def test_sample_is_the_same_however_rows_are_spread(spark):
    rows = spark.range(50_000)
    a = {r.id for r in hash_sample(rows, ["id"], 500).collect()}
    b = {r.id for r in hash_sample(rows.repartition(17), ["id"], 500).collect()}
    assert a == b and len(a) == 500
    ordered = rows.selectExpr("id", "xxhash64(id) AS h").orderBy("h").limit(500)
    assert a == {r.id for r in ordered.collect()}
    assert hash_sample(rows.limit(0), ["id"], 500).count() == 0
    assert hash_sample(rows.limit(7), ["id"], 500).count() == 7


def test_window_hashes_tell_windows_apart():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], np.uint64)
    for width in range(1, 9):
        hashes = window_hashes(words, width)
        windows = [tuple(words[i : i + width].tolist()) for i in range(len(words) - width + 1)]
        assert len(hashes) == len(windows)
        assert len({(w, h) for w, h in zip(windows, hashes.tolist())}) == len(set(windows)) == len(set(hashes.tolist()))
