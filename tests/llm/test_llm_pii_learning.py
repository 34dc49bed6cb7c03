"""Trees and threshold of op9 come from all labelled candidates."""

import numpy as np
from pyspark.sql import functions as F

from ballotlens.llm import boosting, pii

PROPOSED = "array<struct<kind long, start long, end long, features array<double>, label long>>"


def proposals(spark, rows):
    """One document for each (features, label, rewritten)."""
    table = [(i, [(0, -1 if rewritten else 5, 9, list(map(float, x)), label)]) for i, (x, label, rewritten) in enumerate(rows)]
    return spark.createDataFrame(table, f"doc_id long, proposed {PROPOSED}")


def test_every_candidate_is_learnt_from(spark):
    rng = np.random.default_rng(3)
    # more than the 8000 of the former sample, natural non-data (not rewritten) far beyond its 2000
    rows = [((rng.integers(6, 12), rng.integers(0, 5)), 1, True) for _ in range(3000)]
    rows += [((rng.integers(0, 5), rng.integers(0, 5)), 0, False) for _ in range(9000)]
    rows += [((11, 4), 0, True)] * 300           # as good as the best by their features
    found = proposals(spark, rows).repartition(7)
    model, limit = pii._learn_from(found)
    assert model["base"] == boosting.base_of(3000 / 12300)
    counted = found.select(F.explode("proposed").alias("c")).groupBy("c.features").agg(F.sum("c.label").alias("y"), F.count("*").alias("n"))
    cells = counted.collect()
    scores = boosting.predict(model, np.array([r.features for r in cells]))
    best = max(cells, key=lambda r: r.features == [11.0, 4.0])
    assert abs(scores[cells.index(best)] - best.y / best.n) < 0.05          # the share over all its rows
    assert scores[cells.index(best)] < limit
    again = pii._learn_from(found.repartition(3))
    assert again[1] == limit and all((a == b).all() for a, b in zip(again[0]["trees"], model["trees"]))


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TREES", 4)
    rng = np.random.default_rng(5)
    x, copies = rng.integers(0, 40, (400, 3)).astype(float), rng.integers(1, 4, 400)
    y = ((x[:, 0] > 20) ^ (x[:, 1] > 10)).astype(float)
    folds = np.eye(pii.FOLDS, dtype=np.int64)[rng.integers(0, pii.FOLDS, 400)] * copies[:, None]
    counts = pii._model_counts(folds)
    edges, base = boosting.quantile_edges(np.repeat(x, copies, axis=0)), pii._bases(counts[y == 1].sum(axis=0), counts.sum(axis=0))

    def block(rows):
        made = boosting.block_of(boosting.bin_codes(x[rows], edges), y[rows], counts[rows], np.array(base))
        return {**made, "calibrated": np.ones(len(rows), bool)}

    near = boosting.Near(block(np.arange(400)))
    parts = [block(rows) for rows in np.array_split(rng.permutation(400), 9)]
    spread = boosting.Spread(spark.sparkContext.parallelize(parts, 3))
    ours, theirs = pii._learned(near, edges, base), pii._learned(spread, edges, base)
    spread.done()
    assert ours[1] == theirs[1] and all((a == b).all() for a, b in zip(ours[0]["trees"], theirs[0]["trees"]))
    # a row counted n times is n rows: the last model is that of the repeated rows
    alone = boosting.fit(np.repeat(x, copies, axis=0), np.repeat(y, copies))
    assert all(np.allclose(a, b) for a, b in zip(alone["trees"], ours[0]["trees"]))
