"""The manifest against a tree built level by level in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from supportlens.llm import merkle
from supportlens.llm.queries import tampered

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, i long, proof string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)])


def tree(leaves):
    """Root, and per leaf the list of (left siblings, right siblings)."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i // 8 * 8
            proofs[k].append((level[first:i], level[i + 1 : first + 8]))
            at[k] = i // 8
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0] if level else None, proofs


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    out, subroots, found = {}, {}, {}
    for lang in {r[2] for r in rows}:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        subroots[lang], proofs = tree([leaf(r, r[4]) for r in own])
        found[lang] = list(zip(own, proofs, strict=True))
    order = sorted(subroots, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([subroots[x] for x in order])
    for lang, top in zip(order, tops, strict=True):
        for row, proof in found[lang]:
            path = proof + top
            changed = row[4] is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            folded = leaf(row, lower(row[4]) if changed else row[4])
            for left, right in path:
                folded = h(*left, folded, *right)
            digests = "".join(d for left, right in path for d in left + right)
            out.setdefault((row[0], leaf(row, row[4])), []).append((subroots[lang], root, h(digests), folded, folded == root))
    return out


def check(spark, rows, tmp_path, depth=merkle.DEPTH):
    docs = spark.createDataFrame([(*r, "g", 1, "p") for r in rows], SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    got = {}
    for r in tampered(spark.read.parquet(str(tmp_path / "docs")), depth).collect():
        got.setdefault((r["doc_id"], r["leaf"]), []).append((r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]))
    want = brute(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return got


def some(n, langs, seed=1):
    draw = random.Random(seed)
    return [(i * 3 - 7, draw.choice(["a", "b", None]), draw.choice(langs), i if i % 5 else None, draw.choice(["Some Text", "x" * i, "É é", "", None])) for i in range(n)]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (2, ["en", None]), (9, ["en"]), (65, [None]), (40, [f"l{k}" for k in range(30)] + [None, "é", "Z", ""])])
def test_small_trees(spark, tmp_path, n, langs):
    check(spark, some(n, langs), tmp_path)


def test_more_subtrees_than_one(spark, tmp_path):
    got = check(spark, some(1100, ["en"] * 6 + ["de"], 2), tmp_path)
    flat = [v for vs in got.values() for v in vs]
    assert {v[-1] for v in flat} == {True, False}


def test_several_rounds(spark, tmp_path):
    check(spark, some(700, ["en"] * 9 + [f"l{k}" for k in range(70)], 3), tmp_path, 1)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "a", "en", 1, "Same")] * 11 + [(None, "a", "en", 1, "T")] * 2 + [(None, None, None, None, None)] * 9 + [(1, "a", "en", 2, "x")]
    check(spark, rows, tmp_path)


def test_proofs_are_parts_of_siblings(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "g", 1, "p") for r in some(20, ["en", "de"])], SCHEMA)
    for r in merkle.manifest(docs).collect():
        assert merkle.fold(r["leaf"], r["proof"]) == r["root"] and r["other"] is None
        assert all(len(p) % 64 == 1 and int(p[0]) <= len(p) // 64 for p in r["proof"].split("/"))


def test_queue_delivers_by_label():
    queue, seen = merkle.Queue(), []
    for label in [(16, 1), (8, 1), (64, 2), (8, 1)]:
        queue.send(label, len(seen), label)
    assert [(k, len(v)) for k, v in queue.delivered((16, 1))] == [((8, 1), 2)]
    assert [k for k, _ in queue.delivered()] == [(16, 1), (64, 2)]


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents(spark, small_dir):
    got = tampered(spark.read.parquet(f"{small_dir}/documents.parquet"))
    assert got.filter(~F.col("verified")).count() > 0 and got.select("root").distinct().count() == 1
