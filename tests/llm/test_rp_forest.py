from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlens.llm import rp_forest


def _brute(rows, threshold=0.9):
    packed = [rp_forest.usable(v) for _, v in rows]
    n = len(rows)
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if packed[i] and packed[j] and len(packed[i]) == len(packed[j]):
                a, b = np.frombuffer(packed[i]), np.frombuffer(packed[j])
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    root = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return [(row[0], len(links[i]), root[i]) for i, row in enumerate(rows)]


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(150, 24))
    rows = []
    for i in range(1500):
        noise = rng.choice([0.05, 0.2, 0.3])
        rows.append((i, (centres[i % 150] + noise * rng.normal(size=24)).astype(np.float32).tolist()))
    return rows


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


@pytest.mark.parametrize("block_rows", [rp_forest.BLOCK_ROWS, 40])
def test_recall_against_brute_force(spark, clusters, block_rows):
    want = _brute(clusters)
    got = {r["vec_id"]: r for r in rp_forest.near_duplicates(_vectors(spark, clusters), leaf_rows=64, block_rows=block_rows).collect()}
    links = sum(w[1] for w in want)
    assert all(got[i]["n_links"] <= n for i, n, _ in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * links
    assert sum(got[i]["component_id"] == c for i, _, c in want) >= 0.97 * len(want)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, -0.0]),
        (None, [5.0, 0.1]), (None, [0.0, 3.0]), (12, [1e-30, 0.0]), (13, [3e38, 1e30]), (14, [1.0]), (15, [-2.0]),
    ]
    from pyspark.sql import functions as F

    table = _vectors(spark, rows).withColumn("node", F.lit("x")).withColumn("links", F.lit(None).cast("int"))
    got = sorted(repr((r["vec_id"], r["n_links"], r["component_id"])) for r in rp_forest.near_duplicates(table).collect())
    assert got == sorted(map(repr, _brute(rows)))
    kept = [r for r in rp_forest.near_duplicates(table).collect() if r["kept"]]
    assert all(r["vec_id"] == r["component_id"] for r in kept)


def test_large_group_of_copies(spark):
    from pyspark.sql import functions as F

    table = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    got = rp_forest.near_duplicates(table).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(2999, 0, 3000)]


def test_empty(spark):
    assert rp_forest.near_duplicates(_vectors(spark, [])).collect() == []


def test_recall_in_a_large_dense_group(spark):
    n, near, width = 100_000, 33_000, 64
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, width))
    centre = rng.normal(size=width)
    x[:near] = centre / np.linalg.norm(centre) + np.sqrt((1 / 0.94 - 1) / width) * x[:near]
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True))[:near]
    want = sum(np.count_nonzero(unit[a:a + 2000] @ unit.T >= 0.9) for a in range(0, near, 2000)) - near
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)})).repartition(8)
    got = rp_forest.near_duplicates(frame).where(f"vec_id < {near}")
    links, components = got.agg(F.sum("n_links"), F.count_distinct("component_id")).first()
    assert 0.98 * want <= links <= want
    assert components <= 0.001 * near


def test_leaves_of_a_dense_group_count_a_pair_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (np.ones(24) + 0.25 * rng.normal(size=24)).tolist()) for i in range(400)]
    rows += [(i, rng.normal(size=24).tolist()) for i in range(400, 600)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    want = _brute(rows)
    got = {r["vec_id"]: r for r in rp_forest.near_duplicates(_vectors(spark, rows), leaf_rows=32, block_rows=50).collect()}
    assert all(got[i]["n_links"] <= n for i, n, _ in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(n for _, n, _ in want)
