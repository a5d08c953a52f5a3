"""The Merkle manifest against SQL and a plain tree, its layout, and its results for odd rows."""

import hashlib
import zlib

import numpy as np
import pytest

from tests.compare import connect, difference
from tidemark.llm import manifest
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, run string, pos int"


def odd_docs(spark):
    rows = [(i, "web", "en", i, f"text {i}") for i in range(37)]
    rows += [(5, "web", "de", 3, "ä 日本"), (None, "web", "de", 3, "x"), (None, None, "de", None, None)]
    rows += [(2**53 + 1, "web", "de", 3, "long id"), (-9, "", "", 2**63 - 1, "")]
    rows += [(50, "s", None, 1, "no language"), (50, "s", None, 1, "no language"), (50, "s", None, 2, "other")]
    rows += [(i, "s", "zz", None, "z" * 100_000) for i in (60, 61)] + [(62, "s", "ß", 1, "late")]
    rows += [(70, "s", "hot", 1, "same")] * 21
    return spark.createDataFrame([(*r, 1, "r", 2) for r in rows], SCHEMA)


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    def leaf(r, more=0):
        n = r["n_chars"]
        values = [r["doc_id"], r["source"], r["lang"], None if n is None else n + more, r["text"]]
        return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    def layers(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([digest(found[-1][i : i + 2]) for i in range(0, len(found[-1]), 2)])
        return found

    def climb(tree, i, node):
        proof = []
        for layer in tree[:-1]:
            pair = layer[i - i % 2 : i - i % 2 + 2]
            proof += [x for j, x in enumerate(pair) if j != i % 2]
            node = digest([*pair[: i % 2], node, *pair[i % 2 + 1 :]])
            i //= 2
        return proof, node

    runs = {}
    for r in rows:
        crc = None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode())
        tampered = crc is not None and crc % 7 == 0 and r["n_chars"] is not None
        key = (r["lang"] is not None, (r["lang"] or "").encode())
        order = (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))
        runs.setdefault(key, []).append((order, r["doc_id"], leaf(r), leaf(r, 1) if tampered else leaf(r)))
    trees = {k: layers([x[2] for x in sorted(runs[k], key=lambda x: x[0])]) for k in sorted(runs)}
    top = layers([t[-1][0] for t in trees.values()])
    out = []
    for at, (key, tree) in enumerate(trees.items()):
        for i, (_, doc_id, own, changed) in enumerate(sorted(runs[key], key=lambda x: x[0])):
            proof, node = climb(tree, i, changed)
            more, node = climb(top, at, node)
            root = top[-1][0]
            out.append((doc_id, own, tree[-1][0], root, digest(proof + more), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_of_odd_rows(spark, height):
    docs = odd_docs(spark)
    rows = manifest.manifest(docs, manifest.Settings(height=height)).collect()
    assert sorted(map(tuple, rows), key=str) == plain(docs.collect())
    assert {r["verified"] for r in rows} == {True, False}
    assert manifest.manifest(docs.limit(0)).count() == 0
    assert manifest.manifest(docs.limit(1)).count() == 1


def test_manifest_against_sql(spark):
    assert difference(QUERIES["op13_manifest"](spark, SF), connect(SF), SQL["op13_manifest"]) is None


def test_layout():
    """Every address once, subtrees in one stretch, and paths that touch few stretches of 16."""
    for levels in range(1, 12):
        found = np.concatenate([manifest.address(levels, d, np.arange(2**d)) for d in range(levels)])
        assert sorted(found) == list(range(2**levels - 1))
    levels, top = 8, 4
    for root in range(2**top):
        below = [manifest.address(levels, top + d, np.arange(root << d, (root + 1) << d)) for d in range(4)]
        below = np.sort(np.concatenate(below))
        assert (np.diff(below) == 1).all()
    path = [int(manifest.address(levels, d, np.array([101 >> (7 - d)]))[0]) // 15 for d in range(levels)]
    assert len(set(path)) == 2


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_block(n):
    leaves = [digest([str(i)]) for i in range(n)]
    for height in ((n - 1).bit_length(), 4):
        block = manifest.Block.built(leaves, height)
        for leaf, path in zip(leaves, block.paths()):
            assert len(path) == height and manifest.folded(leaf, path) == block.level(0)[0]
