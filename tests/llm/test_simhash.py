import random
import re

import pytest
import xxhash

from stratalake.llm import simhash
from stratalake.llm.simhash import SimHash, ball, ball_size, linked_documents, linked_fingerprints


def plain_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    width = min(width, len(words))
    said = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in said]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """The smallest name reachable, for [(name, fingerprint)], by comparing all pairs."""
    names = [name for name, _ in prints]
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j][1]).bit_count() <= distance and names[i] != names[j]:
                    names[i] = names[j] = min(names[i], names[j])
                    changed = True
    return names


def flipped(r, value, bits):
    for bit in r.sample(range(64), bits):
        value ^= 1 << bit
    return value


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def scattered(seed, count=60):
    """Groups of fingerprints around the limit, and chains of them."""
    r = random.Random(seed)
    out = [0, (1 << 64) - 1, 1 << 63, 15, 31]
    for _ in range(8):
        last = r.getrandbits(64)
        for _ in range(count // 8):
            last = flipped(r, last, r.randint(3, 6))
            out.append(last)
        out += [flipped(r, out[-1], n) for n in range(7)]
    return sorted(set(out))


def check_links(spark, prints, settings):
    df = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long").repartition(3)
    got = dict(map(tuple, linked_fingerprints(df, settings).collect()))
    names = components(list(enumerate(prints)), settings.distance)
    groups = {}
    for print_, name in zip(prints, names, strict=True):
        groups.setdefault(name, set()).add(got[signed(print_)])
    assert len(got) == len(prints)
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


@pytest.mark.parametrize("settings", [SimHash(), SimHash(segments=2), SimHash(segments=5)])
def test_equals_all_pairs(spark, settings):
    check_links(spark, scattered(settings.segments), settings)


def test_crowded_buckets(spark, monkeypatch):
    """With a bound that every bucket of two is beyond, all that tables leave out is still found."""
    monkeypatch.setattr(simhash, "ball_size", lambda bits, radius: 1)
    check_links(spark, scattered(9), SimHash())


def test_dense_group(spark):
    """A group around one point, with all pairs of it in the same buckets."""
    r = random.Random(3)
    middle = r.getrandbits(64)
    check_links(spark, sorted({flipped(r, middle, r.randint(0, 6)) for _ in range(300)}), SimHash())


def test_balls():
    assert len(ball(64, 2)) == len(set(ball(64, 2))) == ball_size(64, 2) == 2081
    assert ball(3, 1) == [0, 1, 2, 4]


def test_documents(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(400)]
    texts = [" ".join(base[:n] + ["new"] + base[n + 1 :]) for n in range(0, 400, 40)]
    texts += ["", None, " \t\n", "one", "One", "a b c d", "a b\x0bc\nD", "a b c\x1cd", "é É ß", "x " * 50_000, "漢字 🙂 " * 900]
    rows = list(enumerate(texts)) + [(3, "repeated id"), (3, texts[3]), (None, texts[0]), (None, "nobody else's")]
    df = spark.createDataFrame(
        [(doc, text, "x", 1) for doc, text in rows], "doc_id long, text string, fingerprint string, component_id int"
    ).repartition(4)
    got = sorted(map(tuple, linked_documents(df).collect()), key=str)
    prints = [plain_fingerprint(text) for _, text in rows]
    names = components([(10**9 if doc is None else doc, p) for (doc, _), p in zip(rows, prints, strict=True)])
    want = [
        (doc, f"{p:016x}", None if name == 10**9 else name)
        for (doc, _), p, name in zip(rows, prints, names, strict=True)
    ]
    assert got == sorted(want, key=str)
    assert linked_documents(df.limit(0)).collect() == []


def test_no_other_distances(spark):
    with pytest.raises(ValueError):
        linked_fingerprints(spark.range(1).toDF("fingerprint"), SimHash(distance=3))
