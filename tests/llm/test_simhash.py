"""SimHash fingerprints and their groups against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from supportlens.llm import simhash
from supportlens.llm.rows import AT, FILE

SCHEMA = "doc_id long, text string, fp string, component string, key int"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Index of the group of each fingerprint, by all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_fingerprints():
    for text in (None, "", " \t\n", "One", "one TWO", "É a\x0bb c d e f", "x " * 300, "a b c d e f g h"):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprints_of_long_texts_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def clusters(chance, count, size):
    out = set()
    for _ in range(count):
        base = chance.getrandbits(64)
        for _ in range(size):
            for b in chance.sample(range(64), chance.randint(0, 3)):
                base ^= 1 << b
            out.add(base)
    return list(out)


@pytest.mark.parametrize("direct", [8192, 3])
def test_links_connect_all_pairs_within_three_bits(spark, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    chance = random.Random(11)
    fps = clusters(chance, 30, 8) + [chance.getrandbits(64) for _ in range(100)]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()]
    place = {f: i for i, f in enumerate(signed)}
    label = simhash.forest(len(fps), *[np.array([place[x[k]] for x in links]) for k in (0, 1)])
    assert label.tolist() == groups(fps)
    assert all(bin(fps[place[a]] ^ fps[place[b]]).count("1") <= 3 or groups(fps)[place[a]] == groups(fps)[place[b]] for a, b in links)


def run(spark, rows):
    found = simhash.near_duplicates(spark.createDataFrame([(*r, "f", "c", 1) for r in rows], SCHEMA))
    return found.collect()


def test_groups_of_documents(spark):
    chance = random.Random(3)
    base = [" ".join(f"w{chance.randint(0, 999)}" for _ in range(200)) for _ in range(12)]
    rows = []
    for i in range(90):
        words = chance.choice(base).split(" ")
        for _ in range(chance.randint(0, 3)):
            words[chance.randrange(200)] = "new"
        rows.append((i * 7 % 90, " ".join(words)))
    rows += [(None, base[0]), (200, None), (201, ""), (None, " "), (202, "one"), (203, "One"), (5, rows[0][1]), (5, rows[0][1]), (204, "a b " * 30_000)]
    got = run(spark, rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    label = groups(fps)
    want = []
    for (key, _), fp, group in zip(rows, fps, label, strict=True):
        keys = [k for (k, _), g in zip(rows, label, strict=True) if g == group and k is not None]
        want.append((key, f"{fp:016x}", min(keys)))
    hexed = [(r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in got]
    assert sorted(hexed, key=str) == sorted(want, key=str)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(set(label)) == len({r["component"] for r in got})
    assert all(r["doc_id"] == r["component_id"] for r in kept)
    assert len({(r[FILE], r[AT]) for r in got}) == len(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty_and_null_tables(spark, rows):
    got = run(spark, rows)
    assert [(r["doc_id"], r["fp"], r["component_id"], r["kept"]) for r in got] == [(None, 0, None, True)] * len(rows)
