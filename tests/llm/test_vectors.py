"""Near-duplicate vectors, integer clustering and ranked search against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import near_vectors as nv
from sensorloom.llm import ranked as rk
from sensorloom.llm.centroids import GREATEST, centroid_clusters, nearest
from sensorloom.llm.vectors import axes, products

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<double>, label int"


# near-duplicate vectors


def sound(row):
    key, v, label = row
    return key is not None and label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, least=0.93):
    ok = [i for i, r in enumerate(rows) if sound(r)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                if nv.cosine(np.array(rows[a][1], float), np.array(rows[b][1], float)) >= least:
                    links[a].add(b)
                    links[b].add(a)
    same = {}
    for i in ok:
        same.setdefault(rows[i][0], []).append(i)
    least_id = {}
    for i in ok:
        if i in least_id:
            continue
        open_, reached = [i], {i}
        while open_:
            x = open_.pop()
            fresh = (links[x] | set(same[rows[x][0]])) - reached
            reached |= fresh
            open_ += fresh
        for x in reached:
            least_id[x] = min(rows[y][0] for y in reached)
    out = []
    for i, (key, _, _) in enumerate(rows):
        component = least_id.get(i, key)
        out.append((key, len(links[i]), component, key is None or component == key))
    return sorted(out, key=repr)


def drawn(n, d, seed, ids=400):
    r = np.random.default_rng(seed)
    base = r.normal(size=(12, d))
    rows = []
    for _ in range(n):
        v = (base[r.integers(12)] + r.normal(size=d) * r.choice([0, 0.05, 0.25, 0.4])).astype(np.float32) * r.choice([1, 3, -1])
        rows.append((int(r.integers(ids)), v.tolist(), int(r.integers(3)) if r.random() < 0.95 else None))
    return rows


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [None] + [1.0] * 23, 1), (904, [math.nan] + [1.0] * 23, 1),
    (905, [math.inf] * 24, 1), (None, [1.0] * 24, 1), (906, [1.0] * 24, 1), (907, [1.0] * 24, 1), (908, [1e-310] * 24, 1),
    (909, [1e308] * 24, 1), (910, [1.0] * 3, 1), (911, [2.0] * 3, 1), (912, [2.0], 1), (913, [4.0], 1), (914, [-0.0, 1.0], 1),
    (915, [0.0, 1.0], 1), (916, [1.0] * 24, None),
]


@pytest.mark.parametrize("tile,fan,top", [(2048, 8, 64), (16, 8, 64), (4, 2, 4)])
def test_links_equal_brute_force(spark, monkeypatch, tile, fan, top):
    monkeypatch.setattr(nv, "FAN", fan)
    monkeypatch.setattr(nv, "TOP", top)
    rows = drawn(200, 24, 5) + ODD
    got = nv.near_vectors(spark.createDataFrame(rows, VECTORS), tile=tile).collect()
    assert sorted(map(tuple, got), key=repr) == brute_links(rows)


def test_vectors_of_clashing_columns_and_empty_tables(spark):
    rows = [(i, v, label, "x", 7) for i, (_, v, label) in enumerate(drawn(20, 8, 1))]
    df = spark.createDataFrame(rows, VECTORS + ", tile string, n_links int").withColumnRenamed("vec_id", "one")
    got = nv.near_vectors(df, key="one").collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(tuple(r)[:3] for r in brute_links([r[:3] for r in rows]))
    assert nv.near_vectors(df.limit(0), key="one").count() == 0


def test_a_group_of_copies_links_all_its_rows(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, one, 1) for i in range(300)] + [(500 + i, [1.0, 2.0, 3.0, 4.0 + i / 1000], 1) for i in range(1, 41)] + [(900, [4.0, -3.0, 2.0, -1.0], 1)]
    got = {r["vec_id"]: r for r in nv.near_vectors(spark.createDataFrame(rows, VECTORS), tile=8).collect()}
    assert all(got[i]["n_links"] == 339 and got[i]["component_id"] == 0 for i, _, _ in rows[:-1])
    assert got[900]["n_links"] == 0 and got[900]["kept"]


def test_tiled_products_stop_only_where_nothing_can_be_linked():
    r = np.random.default_rng(3)
    for d in (3, 8, 9, 64, 100):
        x = r.normal(size=(60, d))
        x[::3] = x[0] + r.normal(size=(20, d)) * 0.2
        u = nv.unit(x) @ axes(nv.unit(x).T @ nv.unit(x))
        i, j = nv.linked(u, u, x, x, 0.9)
        exact = np.array([[nv.cosine(p, q) >= 0.9 for q in x] for p in x])
        found = np.zeros_like(exact)
        found[i, j] = True
        assert (found == exact).all()


def test_tile_pairs_are_dropped_by_their_boxes(spark):
    """Two far groups in one label: no pair of tiles across them is left."""
    r = np.random.default_rng(8)
    rows = [(i, (np.eye(16)[i % 2 * 8] + r.normal(size=16) * 0.01).tolist(), 1) for i in range(64)]
    tiles = []
    keep = nv.tile_pairs

    def spied(boxes, least):
        pairs = keep(boxes, least)
        tiles.append((boxes.count(), pairs.count()))
        return pairs

    nv.tile_pairs = spied
    try:
        got = nv.near_vectors(spark.createDataFrame(rows, VECTORS), tile=8).collect()
    finally:
        nv.tile_pairs = keep
    assert all(r["n_links"] == 31 for r in got)
    n, pairs = tiles[0]
    assert n >= 8 and pairs < n * (n + 1) / 2 * 0.7


def test_axes_are_orthonormal_and_sums_equal_numpy(spark):
    rows = drawn(50, 6, 2)
    df = spark.createDataFrame(rows, VECTORS).filter("label is not null")
    x = np.array([v for _, v, label in rows if label is not None])
    m = products(df, "embedding", False)[6]
    assert np.allclose(m[:6, :6], x.T @ x) and np.allclose(m[6, :6], x.sum(axis=0)) and m[6, 6] == len(x)
    turn = axes(m[:6, :6])
    assert np.allclose(turn.T @ turn, np.eye(6))


# integer clustering


def brute_clusters(rows, k=8, rounds=10, size=64):
    keep = []
    for key, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            keep.append((key, [math.floor(1024 * x) for x in v]))
    seed = sorted(keep, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in seed]

    def assign():
        out = []
        for key, v in keep:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((key, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        groups = {}
        for _, v, c, _ in assign():
            groups.setdefault(c, []).append(v)
        for c, vs in groups.items():
            centroids[c] = [sum(col) // len(vs) for col in zip(*vs)]
    last = assign()
    mark = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((key, c, d, sum(x[3] for x in last if x[2] == c), sum(x[3] for x in last), mark[c]) for key, _, c, d in last), key=repr
    )


def test_clusters_equal_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=64) * 0.2 + r.integers(3)).astype(np.float32).tolist()) for i in range(120)]
    rows += [(5, rows[7][1]), (None, rows[8][1]), (200, rows[8][1]), (201, None), (202, []), (203, [0.0] * 63), (204, [0.0] * 65)]
    rows += [(205, [math.nan] + [0.0] * 63), (206, [None] + [0.0] * 63), (207, [math.inf] * 64), (208, [0.0] * 64), (209, [-1.0] * 64), (210, [1e-9] * 64)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("x"))
    got = centroid_clusters(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    got = centroid_clusters(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(rows)


def test_vectors_beyond_the_range_have_no_row(spark):
    rows = [(1, [1.0] * 64), (2, [GREATEST / 1024.0] * 64), (3, [1e300] * 64), (4, [-131071.0] * 64)]
    got = centroid_clusters(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 4]


def test_bounds_leave_centroids_unverified_and_never_the_nearest():
    r = np.random.default_rng(6)
    x = (r.normal(size=(400, 64)) * 100 + r.integers(0, 5, (400, 1)) * 800).astype(np.int64)
    c = x[:8].copy()
    mean = x.mean(axis=0)
    turn = axes((x - mean).T @ (x - mean))
    lead = lambda v: (((v - mean) @ turn)[:, :16], np.sqrt((((v - mean) @ turn)[:, 16:] ** 2).sum(axis=1)))
    number, distance, tried = nearest(x, *lead(x), c, *lead(c))
    d = ((x[:, None] - c) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert tried < 0.6 * d.size


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(docs, items, top):
    counts = [(key, Counter(t := terms_of(text)), len(t)) for key, text in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c, n in counts:
            score = 0
            for t in set(terms_of(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, key is None, key))
        for rank, (s, _, key) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out.append((item, rank, key, -s))
    return sorted(out, key=repr)


def phrases(n, seed, words=60):
    r = np.random.default_rng(seed)
    some = [f"w{i}" for i in range(words)] + ["Élan", "naïve", "x7", "ÀB", "straße"]
    return [" ".join(r.choice(some, r.integers(1, 40)) + r.choice(["", ",", "-", "!"])) for _ in range(n)]


@pytest.mark.parametrize("top,leaf,batch", [(5, 32, 64), (3, 2, 8), (1000, 4, 4)])
def test_ranks_equal_brute_force(spark, monkeypatch, top, leaf, batch):
    monkeypatch.setattr(rk, "LEAF", leaf)
    monkeypatch.setattr(rk, "BATCH", batch)
    docs = list(enumerate(phrases(150, 1))) + [(900, None), (901, ""), (902, "--- !"), (3, "w1 W2 w3"), (3, "w1 W2 w3"), (None, "w1 w2"), (903, "w5\0w6")]
    items = list(enumerate(phrases(20, 2))) + [(50, None), (51, "nowhere"), (52, "w1 w1 W1"), (52, "w1 w1 W1"), (None, "w2")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n", F.lit("x")).withColumn("item_id", F.lit(1))
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("y")).withColumn("rank", F.lit(1))
    got = rk.ranked(d.repartition(3), i, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranks(docs, items, top)


def test_blocks_of_items_give_the_same_ranks(spark, monkeypatch):
    monkeypatch.setattr(rk, "BLOCK_BYTES", 300)
    docs, items = list(enumerate(phrases(60, 3))), list(enumerate(phrases(12, 4)))
    got = rk.ranked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id int, text string"), 4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranks(docs, items, 4)


def test_ranks_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert rk.ranked(docs.limit(0), items).count() == rk.ranked(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in rk.ranked(docs, items).collect()] == brute_ranks([(1, "a b")], [(1, "a")], 50)


def test_trees_prune_and_never_what_is_best():
    r = np.random.default_rng(9)
    size, weight = 80, r.integers(1, 900, 80)
    terms = [np.unique(r.integers(k % 4 * 20, k % 4 * 20 + 20, 6)) for k in range(30)]
    order = rk.arranged(terms)
    assert sorted(order) == list(range(30))
    tree = rk.item_tree([terms[i] for i in order], weight)
    assert len(tree.levels[-1][2]) == 2
    peak = np.zeros(size, np.int64)
    peak[:20] = r.integers(0, 1000, 20)
    exact = np.array([(weight[terms[i]] * peak[terms[i]]).sum() for i in order])
    floor = np.full(30, int(np.median(exact[exact > 0])))
    left = rk.survivors(tree, peak, floor, np.arange(30))
    assert left.tolist() == np.flatnonzero(exact >= floor).tolist() and 0 < len(left) < 8
