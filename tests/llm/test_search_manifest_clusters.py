"""Top-k search, Merkle manifest and clustering against plain versions."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import clustering, merkle, topk

VECTORS = "vec_id long, embedding array<double>, v string, row string, dim string, length string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "v", "r", "d", "l") for i, e in rows], VECTORS).repartition(3)


def odd_rows(dims=8, n=300, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    base *= np.exp(rng.normal(size=(n, 1)))
    rows = [(i, x.tolist()) for i, x in enumerate(base)]
    same = base[7].tolist()
    rows += [(1000 + i, same) for i in range(120)]  # a hot vector: one length, ties everywhere
    rows += [(20, rows[20][1]), (20, rows[20][1]), (None, same), (2000, [0.0] * dims), (2010, [0.0] * dims)]
    rows += [(3000, None), (3010, [1.0] * (dims - 1) + [None]), (3020, [1.0] * (dims - 1) + [math.nan])]
    rows += [(3030, [math.inf] + [0.0] * (dims - 1)), (3040, [2.0, 3.0]), (3050, [1.0, -1.0]), (3060, [])]
    return rows


def usable(e):
    return e is not None and all(x is not None and math.isfinite(x) for x in e)


def plain_top_k(rows, asks, k):
    kept = [(n, i, [math.floor(256 * x) for x in e]) for n, (i, e) in enumerate(rows) if usable(e)]
    out = []
    for n, i, e in kept:
        if i is None or not asks(i):
            continue
        scored = [(-sum(a * b for a, b in zip(e, f)), j is None, j or 0, m) for m, j, f in kept if m != n and len(f) == len(e)]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket,block", [(16, 8), (64, 1000)])
def test_top_k(spark, bucket, block):
    rows = odd_rows()
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 5, bucket_rows=bucket, block_rows=block).collect()
    assert sorted([tuple(r) for r in found], key=str) == plain_top_k(rows, lambda i: i % 10 == 0, 5)


def test_top_k_empty(spark):
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 10 == 0, 5).count() == 0
    assert topk.top_k(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 10 == 0, 5).count() == 0
    assert topk.top_k(vectors(spark, [(10, [1.0])]), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_bucket_is_pruned_by_both_means():
    rng = np.random.default_rng(5)
    near = np.eye(16)[3] * 100 + rng.normal(size=(50, 16))
    p = np.concatenate([near, rng.normal(size=(950, 16)) * 25])
    p = p[np.argsort(-np.linalg.norm(p, axis=1))]
    lengths = np.linalg.norm(p, axis=1)
    q = np.stack([np.eye(16)[3] * 10.0, rng.normal(size=16)])
    products = q @ p.T
    theta = np.array([np.sort(products[0])[-5], np.sort(products[1])[-5]])
    found = dict(topk.search_bucket(q, np.linalg.norm(q, axis=1), theta, p, lengths))
    for i in range(2):
        assert set(np.flatnonzero(products[i] >= theta[i])) <= set(found[i])
    assert len(found[0]) < 100
    # a threshold that no vector of the bucket can reach
    assert topk.search_bucket(q, np.linalg.norm(q, axis=1), np.full(2, 1e9), p, lengths) == []


def test_switch_point():
    local = np.array([0.9, 0.8, 0.3])
    assert topk.switch_point(local, np.array([1, 2, 90]), np.array([100, 100, 100])) == 0.3
    assert topk.switch_point(local, np.array([1, 99, 100]), np.array([100, 100, 100])) == 0.9
    assert topk.switch_point(local, np.array([99, 99, 100]), np.array([100, 100, 100])) == math.inf


DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, leaf string, key string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "t", 0, "l", "k") for r in rows], DOCS).repartition(4)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(doc_id, source, lang, n_chars, text):
        return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))

    def climb(nodes):
        """Root, and for each leaf its list of (siblings before, siblings after)."""
        proofs, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i in range(len(proofs)):
                run = at[i] // 2 * 2
                proofs[i].append(("".join(nodes[run : at[i]]), "".join(nodes[at[i] + 1 : run + 2])))
                at[i] //= 2
            nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        return nodes[0], proofs

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((mine, *climb([leaf(*r) for r in mine])))
    root, upper = climb([t[1] for t in trees])
    out = []
    for (mine, subroot, proofs), above in zip(trees, upper):
        for r, proof in zip(mine, proofs):
            node = leaf(*r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                node = leaf(*r[:3], r[3] + 1, r[4])
            for before, after in proof + above:
                node = sha(before + node + after)
            siblings = sha("".join(b + a for b, a in proof + above))
            out.append((r[0], r[2], leaf(*r), subroot, root, siblings, node, node == root))
    return sorted(out, key=str)


def found_manifest(docs):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"n_chars": n_chars})
    return sorted([tuple(r) for r in found.collect()], key=str)


def test_manifest(spark):
    rows = [(i, f"s{i % 3}", "en", 10 + i, f"text {i}") for i in range(700)]  # several passes above 256 leaves
    rows += [(i, None, "fr", None, "déjà vu") for i in range(5)]
    rows += [(9, "s", None, 1, None), (10, "s", "z", 2, ""), (None, "s", "z", 3, "x"), (10, "s", "z", 2, ""), (10, "s", "z", 2, "a")]
    rows += [(11, "s", "Z", 2, "long " * 40_000), (12, "s", "", 0, "é")]
    assert found_manifest(documents(spark, rows)) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    assert found_manifest(documents(spark, rows)) == (plain_manifest(rows) if n else [])


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, np.array([math.floor(256 * x) for x in e], dtype=object)) for i, e in rows if usable(e) and len(e) == dims]
    named = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1].tolist())
    )
    centres = [r[1] for r in named[:k]]

    def nearest(x):
        gaps = [int(((x - c) ** 2).sum()) for c in centres]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        where = [nearest(x)[0] for _, x in kept]
        for c in range(len(centres)):
            mine = [x for (_, x), w in zip(kept, where) if w == c]
            if mine:
                centres[c] = np.array([int(s) // len(mine) for s in sum(mine)], dtype=object)
    found = [(i, *nearest(x)) for i, x in kept]
    total, per = sum(f[2] for f in found), {}
    for f in found:
        per[f[1]] = per.get(f[1], 0) + f[2]
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, c, d, per[c], total, texts[c]) for i, c, d in found], key=str)


@pytest.mark.parametrize("k,rounds", [(6, 5), (40, 3), (1, 2), (5, 0)])
def test_clusters(spark, k, rounds):
    rows = odd_rows(n=150)
    found = clustering.cluster_vectors(vectors(spark, rows), k, rounds, dims=8).drop("scanned").collect()
    assert sorted([tuple(r) for r in found], key=str) == plain_clusters(rows, k, rounds, 8)


def test_clusters_of_none_and_few(spark):
    assert clustering.cluster_vectors(vectors(spark, []), 4, 2, dims=8).count() == 0
    few = clustering.cluster_vectors(vectors(spark, [(1, [1.0] * 8), (2, [1.0] * 8), (3, [1e300] * 8)]), 40, 2, dims=8).collect()
    assert {r["vec_id"] for r in few} == {1, 2, 3} and all(r["inertia"] == 0 for r in few)


def test_loosening_bounds_every_shrinkage():
    rng = np.random.default_rng(1)
    below = 0
    for _ in range(40):
        before = rng.normal(size=(5, 4)) * 10
        after = before + rng.normal(size=(5, 4)) * rng.choice([0.1, 3.0, 20.0])
        radius = rng.uniform(0, 8, size=5)
        table = clustering.loosening(before, after, radius)
        drift = np.linalg.norm(after - before, axis=1)
        assert (table <= drift * (1 + 1e-6)).all()
        below += (table < 0.9 * drift).sum()
        for i in range(5):
            way = rng.normal(size=(400, 4))
            points = before[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, size=(400, 1)) ** 0.2
            for j in range(5):
                shrunk = np.linalg.norm(points - before[j], axis=1) - np.linalg.norm(points - after[j], axis=1)
                assert shrunk.max() <= table[i, j] + 1e-6
    assert below > 200  # tighter than full drift for many


def test_bounds_spare_scans(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 8)) * 40
    rows = [(i, (centres[i % 8] + rng.normal(size=8)).tolist()) for i in range(800)]
    found = clustering.cluster_vectors(vectors(spark, rows), 8, 5, dims=8).select("scanned").first()
    assert found["scanned"] < 800
