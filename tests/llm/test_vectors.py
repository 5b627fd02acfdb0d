"""Vector operators against brute force, with edge cases."""

import math

import numpy as np
import pytest

from oracle_harness import compare, duck
from starloom.llm import grid, op10_topk, op11_negatives, op13_vector_dedup
from starloom.llm import queries as Q
from starloom.plans.registry import ORACLE

SF = "/root/testdata/sf0.001"


def clean_rows(rows, scale):
    return [(i, lab, [math.floor(float(x) * scale) for x in v]) for i, lab, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]


def brute_negatives(rows, every=20):
    own = [r for r in clean_rows(rows, 256) if r[1] is not None]
    out, seen = [], set()
    for i, lab, v in own:
        if i % every or (i, lab, tuple(v)) in seen:
            continue
        seen.add((i, lab, tuple(v)))
        scores = [(sum(a * b for a, b in zip(v, u)), j, m) for j, m, u in own if j != i and len(u) == len(v)]
        others = sorted((-s, j) for s, j, m in scores if m != lab)
        for ps, pj in sorted((-s, j) for s, j, m in scores if m == lab)[:5]:
            got = [(j, -s) for s, j in others if 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out += [(i, pj, r, j, -ps, s) for r, (j, s) in enumerate(got, 1)]
    return sorted(out)


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(3)), [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(260)]
    rows += [(300 + i, 1, [0.5] * 6) for i in range(30)]  # ties
    rows += [(400, None, [1.0] * 6), (401, 1, None), (402, 1, [float("nan")] * 6), (403, 2, [1.0, None] + [0.0] * 4), (404, 2, []),
             (None, 1, [1.0] * 6), (420, 2, [0.25] * 3), (421, 2, [0.5] * 3), (422, 1, [0.45] * 3), (409, 1, [float("inf")] * 6), (440, 1, [9.0] * 6), (447, 1, [9.0] * 6), (441, 2, [9.0] * 6)]
    # one id with several vectors or labels, and repeated rows
    return rows + [(40, 0, rows[40][2]), (40, 2, [0.1] * 6), rows[60], rows[60], rows[61]]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 f"vec_id long, label int, embedding array<{kind}>, score string, `WINDOWS` int").repartition(4)


ANCHOR = "vec_id % 20 = 0"


@pytest.mark.parametrize("size", [8192, 16])
def test_hard_negatives_match_brute_force(spark, size):
    rows = odd_vectors()
    got = op11_negatives.hard_negatives(frame(spark, rows), ANCHOR, rows_per_block=size).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)
    assert any(r.positive_score == r.negative_score for r in got)


def test_hard_negatives_of_large_components(spark):
    big = [(500, 1, [4e6, 2.0]), (501, 1, [4e5, 9.0]), (502, 2, [3.9e5, 5e9]), (503, 2, [3.5e5, -7e9]), (504, 1, [-4e300, 0.0])]
    got = op11_negatives.hard_negatives(frame(spark, big), ANCHOR).collect()
    assert sorted(map(tuple, got)) == brute_negatives(big) and len(got) == 2
    with pytest.raises(Exception, match="beyond a long"):
        op11_negatives.hard_negatives(frame(spark, big + [(505, 1, [4e18, 0.0])]), ANCHOR).collect()


def test_hard_negatives_of_empty_tables(spark):
    df = frame(spark, odd_vectors())
    none = op11_negatives.hard_negatives(df.limit(0), ANCHOR)
    assert none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert none.count() == 0 and op11_negatives.hard_negatives(df, "false").count() == 0
    assert op11_negatives.hard_negatives(df.where("label = 1"), ANCHOR).count() == 0


def test_bounds_shrink_the_candidates():
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(size=(500, 16)) * 256 * np.geomspace(1, 0.01, 16))
    block = op11_negatives.ColumnBlock(np.arange(500), np.zeros(500, int), vectors)
    seen = []
    wanted = op11_negatives.best_wanted([], 5)
    alive, scores = block.scan(vectors[0], np.arange(1, 500), lambda lo, up: (seen.append(len(lo)), wanted(lo, up))[1])
    assert seen[0] == 499 and seen[-1] < 100
    assert op11_negatives.best_of(alive, scores, 5) == op11_negatives.best_of(np.arange(1, 500), vectors[1:] @ vectors[0], 5)


def test_cells_hold_bounded_queries():
    assert grid.shape(10**6, 10**4, 100) == (1, 100)
    a, b = grid.shape(10**9, 10**7, 1000)
    assert 10**7 / a <= grid.QUERIES_PER_CELL and b >= 1
    assert grid.shape(0, 0, 8) == (1, 8)


def test_top_k_of_large_components(spark):
    rows = [(0, 1, [4e6, 2.0]), (1, 1, [4e5, 4e5]), (2, 2, [3e12, 1.0]), (3, 2, [-1e300, 0.0]), (4, 2, [1.0, 1.0]), (100, 1, [1.0, 1e-3])]
    df = frame(spark, rows)
    own = [(i, v) for i, _, v in clean_rows(rows, 1024)]

    def brute(k):
        return sorted((i, r, j, -s) for i, v in own if i == 100 for r, (s, j) in enumerate(sorted(
            (-sum(a * b for a, b in zip(v, u)), j) for j, u in own if j != i)[:k], 1))

    ask = df.where("vec_id = 100")
    assert sorted(map(tuple, op10_topk.top_inner_products(df, ask, k=4).collect())) == brute(4)
    with pytest.raises(Exception, match="below the range"):
        op10_topk.top_inner_products(df, ask, k=5).collect()
    with pytest.raises(Exception, match="beyond a long"):
        op10_topk.top_inner_products(df, df.where("vec_id = 0"), k=1).collect()


def test_queries_of_one_id_are_answered_each(spark):
    rows = [(5, 1, [1.0, 0.0]), (5, 1, [0.0, 1.0]), (5, 1, [0.0, 1.0]), (6, 1, [2.0, 0.0]), (7, 1, [0.0, 3.0])]
    df = frame(spark, rows)
    got = op10_topk.top_inner_products(df, df.where("vec_id = 5"), k=1).collect()
    assert sorted((r.vec_id, r.score) for r in got) == [(6, 2 << 20), (7, 3 << 20)]


@pytest.mark.parametrize("key", ["op11_hard_negatives"])
def test_queries_equal_their_sql(spark, key):
    got = compare(spark, duck(SF), key, getattr(Q, key), ORACLE[key], SF)
    assert got["status"] == "OK" and not got["type_mismatch"] and got["rows"] > 0, got


def brute_links(rows, least=0.98):
    """(n_links, component_id) for each row, by every pair."""
    own = []
    for i, lab, v in rows:
        ok = lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        own.append(np.array(v, float) / max(map(abs, v)) if ok else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if own[a] is not None and own[b] is not None and rows[a][1] == rows[b][1] and len(own[a]) == len(own[b]):
                x, y = own[a], own[b]
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    ids = {}
    for n, (i, _, _) in enumerate(rows):
        if i is not None:
            ids[find(n)] = min(i, ids.get(find(n), i))
    return [(r[0], links[n], ids.get(find(n)), r[0] == ids.get(find(n))) for n, r in enumerate(rows)]


def as_sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def near_copies(rng, n, dim, spread):
    centre = rng.normal(size=dim)
    return [(centre / np.linalg.norm(centre) + rng.normal(size=dim) * spread).astype(np.float32).tolist() for _ in range(n)]


@pytest.mark.parametrize("size", [1024, 8])
def test_vector_links_match_brute_force(spark, size):
    rng = np.random.default_rng(9)
    rows = [(int(i), int(rng.integers(2)), rng.normal(size=16).astype(np.float32).tolist()) for i in range(150)]
    for k, spread in enumerate((0.004, 0.01, 0.03, 0.035)):  # tight groups, and some whose links break up
        rows += [(1000 + 100 * k + i, k % 2, v) for i, v in enumerate(near_copies(rng, 25, 16, spread))]
    same = rows[3][2]
    rows += [(2000 + i, rows[3][1], same) for i in range(20)] + [(2100, rows[3][1], [2 * x for x in same]), (2101, 1 - rows[3][1], same)]
    rows += [(2200, None, same), (2201, 1, None), (2202, 1, [0.0] * 16), (2203, 1, [float("nan")] * 16), (2204, 1, [1.0, None] + [0.0] * 14),
             (2205, 1, []), (2206, 1, [1.0, 2.0, 2.0]), (2207, 1, [1.0, 2.0, 2.01]), (2208, 1, [3.0]), (2209, 1, [-3.0]), (None, 1, [1.0, 2.0, 2.0]),
             (None, 1, [5.0, 0.0, 0.0]), (2210, 1, [1e-200] * 16), (2211, 1, [1e200] * 16), rows[5], rows[5], rows[160]]
    got = op13_vector_dedup.near_duplicate_vectors(frame(spark, rows), rows_per_block=size)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = brute_links(rows)
    if size == 1024:
        assert as_sorted(got.collect()) == as_sorted((i, n, c, False if i is None and c is not None else i == c) for i, n, c, _ in want)
    else:
        assert sorted(r.n_links for r in got.collect()) == sorted(n for _, n, _, _ in want)
    assert max(n for _, n, _, _ in want) > 20 and op13_vector_dedup.near_duplicate_vectors(frame(spark, rows).limit(0)).count() == 0


def test_vector_index_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.98 are hardest; nearly all are candidates."""
    rng = np.random.default_rng(2)
    x = op13_vector_dedup.unit(rng.normal(size=(4000, 64)))
    z = rng.normal(size=x.shape)
    z = op13_vector_dedup.unit(z - np.einsum("ij,ij->i", z, x)[:, None] * x)
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * z
    pivots = op13_vector_dedup.choose_pivots(x[:2000])
    a, b = (op13_vector_dedup.ordered_pivots(v, pivots) for v in (x, y))
    found = 0
    for p, q in zip(a, b):
        lists = np.stack([p, q])
        shared = len(np.intersect1d(p, q))
        keys = set(op13_vector_dedup.list_keys(lists)[0]) & set(op13_vector_dedup.list_keys(lists)[1])
        hits = [k for k in keys if any(len(i) for i, _ in op13_vector_dedup.candidate_pairs(
            np.zeros(2, int), np.zeros(2, int), np.array([k, k]), op13_vector_dedup.bitmaps(lists)))]
        assert len(hits) == (shared >= op13_vector_dedup.SHARED)  # one list counts the pair
        found += len(hits)
    assert found / len(x) >= 0.985


def test_vector_dedup_of_a_real_table(spark):
    df = spark.read.parquet("/root/testdata/check_s/embeddings.parquet")
    rows = df.toPandas()
    got = Q.op13_vector_dedup(spark, "/root/testdata/check_s").toPandas().set_index("vec_id").n_links
    want = {}
    for _, own in rows.groupby("label"):
        v = np.stack(own.embedding).astype(float)
        v /= np.linalg.norm(v, axis=1)[:, None]
        want |= dict(zip(own.vec_id, (v @ v.T >= 0.98).sum(axis=1) - 1))
    assert got.sum() >= 0.995 * sum(want.values()) and all(got[i] <= n for i, n in want.items()) and len(got) == len(rows)
