import math
import random

import numpy as np
import pytest
from helpers import SF, rows

from ledgerloom.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data):
    """n_links and component of every row, in double precision."""
    ok = [lab is not None and e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e)
          and any(e) for _, e, lab in data]
    unit = [np.array(e, np.float32).astype(float) if k else None for k, (_, e, _) in zip(ok, data, strict=True)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    n = len(data)
    linked = [[j for j in range(n) if j != i and ok[i] and ok[j] and data[i][2] == data[j][2]
               and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.98] for i in range(n)]
    seen, out = {}, []
    for i in range(n):
        if i not in seen:
            stack, group = [i], {i}
            while stack:
                for j in linked[stack.pop()]:
                    if j not in group:
                        group.add(j)
                        stack.append(j)
            least = min((data[k][0] for k in group if data[k][0] is not None), default=None)
            seen.update(dict.fromkeys(group, least))
        out.append((data[i][0], len(linked[i]), seen[i], data[i][0] is not None and data[i][0] == seen[i]))
    return sorted(out, key=repr)


def clustered(seed, n=260, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    data = []
    for i in range(n):
        x = (centres[i % 9] + rng.normal(scale=0.06, size=dim)) * rng.uniform(0.1, 9)
        data.append((i, [float(np.float32(v)) for v in x], int(i % 9 % 2)))
    return data


ODD = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 6, 1), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
       (1004, [math.nan] * 6, 1), (1005, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (1006, [1.0] * 6, None),
       (1007, [1.0] * 4, 1), (1008, [1.0] * 6, 1), (1008, [1.0] * 6, 1), (None, [1.0] * 6, 1),
       (None, [-1.0] * 6, 1), (1009, [1e-30] * 6, 0), (1010, [1e30] * 6, 0)]


@pytest.mark.parametrize(("cell", "tile"), [(embedding_dedup.CELL, embedding_dedup.TILE), (20, 7), (3, 50)])
def test_matches_brute_force(spark, cell, tile):
    data = clustered(cell) + ODD + [(2000 + i, [3.0, 1.0, 0.0, 0.0, 0.0, 2.0], 1) for i in range(120)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA + ", node string, cell string")
    got = embedding_dedup.near_duplicates(df, cell=cell, tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(data)


def test_whole_table_with_small_cells(spark):
    data = [(r["vec_id"], r["embedding"], r["label"]) for r in rows("embeddings", SF)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(data, SCHEMA), cell=15, tile=10).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(data)


def test_cells_hold_every_partner():
    rng = np.random.default_rng(4)
    x = embedding_dedup.units(rng.normal(size=400 * 5), 400)
    near = embedding_dedup.units((x + rng.normal(scale=0.05, size=x.shape)).ravel(), 400)
    p = embedding_dedup.units(rng.normal(size=40 * 5), 40)
    r = math.sqrt(0.04)
    home, _ = embedding_dedup.cells_of(x, p, r)
    _, member = embedding_dedup.cells_of(near, p, r)
    close = (x * near).sum(axis=1) >= 0.98
    assert close.sum() > 50 and member[np.arange(400), home][close].all()


def test_empty(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dealing_holds_a_bounded_matrix():
    """Peak memory of dealing is that of its pairs, whatever the number of pivots."""
    import tracemalloc

    rng = np.random.default_rng(1)
    peaks = []
    for n in (1024, 16_384):
        pivots = rng.normal(size=(n, 16))
        pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
        x = pivots[: embedding_dedup.CELLS // n]
        tracemalloc.start()
        home, member = embedding_dedup.cells_of(x, pivots, 0.2)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert (home == np.arange(len(x))).all() and member[np.arange(len(x)), home].all()
    assert peaks[1] < 2 * peaks[0] and peaks[1] < 200 << 20
