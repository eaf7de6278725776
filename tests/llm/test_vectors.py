import numpy as np

from skein.llm import neighbours as N
from skein.llm.components import components


def brute(rows):
    comp, links = list(range(len(rows))), [0] * len(rows)
    unit = [None if v is None or lab is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v) else np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v, lab in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= 0.93:
                links[i] += 1
                links[j] += 1
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    return {rows[k][0]: (links[k], rows[comp[k]][0]) for k in range(len(rows))}


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(16)
    rows = [(k, rng.standard_normal(16).astype(np.float32).tolist(), k % 3) for k in range(300)]
    rows += [(300 + k, (centre + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for k in range(60)]  # saturated lists
    rows += [(400 + k, (np.array(rows[k][1]) + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), k % 3) for k in range(40)]
    rows += [(500 + k, rows[k][1], rows[k][2]) for k in range(5)] + [(510 + k, rows[0][1], rows[0][2]) for k in range(9)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, rows[5][1], None), (603, [float("nan")] * 16, 1), (604, [None, *rows[5][1][1:]], 2), (605, [], 1), (606, rows[5][1][:8], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in N.near_vectors(df).collect()}
    want = brute(rows)
    assert {k: v[:2] for k, v in got.items()} == want
    assert all(kept == (k == c) for k, (_, c, kept) in got.items())
    assert N.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 200)] + [(500, 300), (300, 400), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and got[500] == got[400] == got[300] == 300
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near(rng, centre, cosine):
    """A unit vector at the given cosine to a unit vector."""
    v = rng.standard_normal(len(centre))
    v -= (v @ centre) * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * v / np.linalg.norm(v)


def test_links_between_clumps(spark):
    """Groups whose members are nearer to one another than to another group, which is within the threshold too."""
    rng = np.random.default_rng(2)
    rows = []
    for label in range(3):
        first = near(rng, np.eye(32)[0], 0.0)
        for centre in (first, near(rng, first, 0.96)):
            rows += [(len(rows) + k, near(rng, centre, 0.995).astype(np.float32).tolist(), label) for k in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(df).collect()}
    assert got == brute(rows)
    assert {c for _, c in got.values()} == {0, 24, 48}


def test_all_links_of_a_large_label(spark):
    """Pairs without other neighbours, in a label of several blocks: lists of candidates have nothing to lead to them."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(2000):
        v = near(rng, np.eye(64)[0], 0.0)
        rows += [(2 * k, v.astype(np.float32).tolist(), 1), (2 * k + 1, near(rng, v, 0.932).astype(np.float32).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(df).collect()}
    assert got == {k: (1, k // 2 * 2) for k in range(4000)}
