"""Links against all pairs, recall at the threshold, and balanced bits."""

import math

import numpy as np

from tillstream.llm import embedding_dedup as ed

FOLDER = "/root/testdata/sf0.01"


def brute(rows):
    ok = [(i, np.array(v, float), l) for i, v, l in rows if i is not None and v and l is not None
          and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = [[y for y, (j, b, m) in enumerate(ok) if y != x and l == m and len(a) == len(b)
             and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93] for x, (i, a, l) in enumerate(ok)]
    root = list(range(len(ok)))
    for _ in ok:
        root = [min([root[x], *[root[y] for y in near[x]]]) for x in range(len(ok))]
    low = {}
    for x, r in enumerate(root):
        low[r] = min(ok[x][0], low.get(r, ok[x][0]))
    return {i: (len(near[x]), low[root[x]]) for x, (i, _, _) in enumerate(ok)}


def planted(seed, groups, dims=64):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(rng.integers(1, 9)):
            spread = rng.choice([0.05, 0.15, 0.27])
            v = centre + spread * rng.normal(size=dims)
            rows.append((k, [float(x) for x in v.astype(np.float32)], int(g % 3)))
            k += 1
    return rows


def test_links_and_recall(spark):
    rows = planted(1, 150)
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.link_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    assert set(got) == set(want)
    true, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert true > 500 and found <= true and all(got[i][0] <= want[i][0] for i in want)
    assert found / true > 0.97, found / true
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.97


def test_recall_by_band_and_few_candidates(spark):
    """Pairs planted at cosines from 0.93 on are found in each band, and unlike vectors are hardly ever compared."""
    rng = np.random.default_rng(4)
    rows, planted_at = [], {}
    for k in range(0, 3000, 2):
        x, noise = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        noise -= (noise @ x) * x
        cosine = rng.uniform(0.931, 0.999)
        y = cosine * x + (1 - cosine**2) ** 0.5 * noise / np.linalg.norm(noise)
        rows += [(k, x.tolist(), 0), (k + 1, y.tolist(), 0)]
        planted_at[k] = cosine
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in ed.link_vectors(df).collect()}
    for low, high in ((0.931, 0.94), (0.94, 0.96), (0.96, 1.0)):
        band = [k for k, c in planted_at.items() if low <= c < high]
        recall = np.mean([got[k] >= 1 and got[k + 1] >= 1 for k in band])
        assert len(band) > 100 and recall > (0.95 if low < 0.94 else 0.99), (low, recall)
    coded = ed._coded(ed._classed(df, "vec_id", "embedding", "label").select("c", "label", "v"), ed.FITTED)
    assert ed.candidates(coded, ed.APART).count() < len(planted_at) + 0.0003 * len(rows) ** 2 / 2


def test_bits_are_balanced():
    x = np.array([v for _, v, _ in planted(2, 300)]) + 0.5
    mean, rotation = ed.fit_rotation(x, 64)
    share = ((x - mean) @ rotation >= 0).mean(0)
    assert rotation.shape == (64, 64) and np.allclose(rotation.T @ rotation, np.eye(64)) and np.abs(share - 0.5).max() < 0.15


def test_pairs_once(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    codes = [base] + [base ^ sum(1 << int(b) for b in rng.choice(63, n, replace=False)) for n in range(0, 14) for _ in range(8)]
    df = spark.createDataFrame([(i, 1, c) for i, c in enumerate(codes)], "c bigint, label int, code bigint").withColumn("unit", F.array(F.lit(1.0)))
    got = sorted(map(tuple, ed.candidates(df).collect()))
    key = lambda x, t: x >> 16 * t & 0xFFFF
    want = [(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes))
            if any((key(codes[i], t) ^ key(codes[j], t)).bit_count() <= 2 for t in range(4))]
    assert got == want
    assert all((i, j) in set(want) for i in range(len(codes)) for j in range(i + 1, len(codes)) if (codes[i] ^ codes[j]).bit_count() <= 11)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, -0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1),
            (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1e300, 1e290], 1), (13, [1.0], 1), (14, [3.0], 1),
            (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<double>, label int, code int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.link_vectors(df).collect()}
    assert len(got) == 15 and all(got[i] == (0, i, True) for i in range(4, 12)) and got[None] == (0, None, True)
    assert [got[i] for i in (1, 2, 3, 12)] == [(3, 1, True), (3, 1, False), (3, 1, False), (3, 1, False)] and got[14] == (1, 13, False)
    assert ed.link_vectors(df.limit(0)).count() == 0
