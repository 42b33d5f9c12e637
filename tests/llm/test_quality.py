"""The factorisation machine against its definition, a numeric gradient and held-out labels."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import FOLDER

from almanac.llm import quality
from almanac.sources import table

SCHEMA = "doc_id long, text string, n_chars long, score string, _text string, _meta string, key long, quality string"


def small(seed, rows=6):
    random = np.random.default_rng(seed)
    sizes = random.integers(1, 9, rows)
    ids = np.concatenate([np.sort(random.choice(quality.SIZE, n, replace=False)) for n in sizes])
    x = quality.Sparse(ids, random.normal(size=len(ids)), np.cumsum(sizes) - sizes)
    model = quality.FactorModel(
        0.3, random.normal(size=quality.SIZE), random.normal(size=(quality.SIZE, 3)), np.zeros((len(quality.STATISTICS), 15))
    )
    return x, model, (random.random(rows) < 0.5).astype(float)


def test_margin_equals_the_sum_over_all_pairs():
    x, model, _ = small(1)
    ends = [*x.starts[1:], len(x.ids)]
    for i, (start, end) in enumerate(zip(x.starts, ends)):
        ids, values = x.ids[start:end], x.values[start:end]
        pairs = sum(
            model.factors[ids[a]] @ model.factors[ids[b]] * values[a] * values[b]
            for a in range(len(ids)) for b in range(a + 1, len(ids))
        )
        assert model.margin(x)[i] == pytest.approx(model.bias + model.weights[ids] @ values + pairs)


def test_gradient_equals_differences():
    x, model, y = small(2)
    loss, bias, weights, factors = model.gradient(x, y)
    assert loss == pytest.approx(np.mean(np.log1p(np.exp(-np.where(y > 0, 1, -1) * model.margin(x)))))
    step = 1e-6

    def slope(change):
        found = []
        for sign in (1, -1):
            moved = quality.FactorModel(model.bias, model.weights.copy(), model.factors.copy(), model.edges)
            change(moved, sign * step)
            found.append(moved.gradient(x, y)[0])
        return (found[0] - found[1]) / (2 * step)

    def move_bias(m, s):
        m.bias += s

    assert bias == pytest.approx(slope(move_bias), abs=1e-7)
    for feature in x.ids[::3]:
        def move_weight(m, s, feature=feature):
            m.weights[feature] += s

        def move_factor(m, s, feature=feature):
            m.factors[feature, 1] += s

        assert weights[feature] == pytest.approx(slope(move_weight), abs=1e-7)
        assert factors[feature, 1] == pytest.approx(slope(move_factor), abs=1e-7)


def test_held_out_labels_are_found(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in quality.op11_quality(spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert sorted(found) == sorted(d.doc_id for d in docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    judged = [(found[r.doc_id], r.quality) for r in table(spark, folder, "labels").collect() if found[r.doc_id].held_out]
    good, bad = ([r.score for r, q in judged if q == label] for label in (1, 0))
    assert len(good) > 50 and len(bad) > 8
    assert np.mean([r.predicted == q for r, q in judged]) > 0.97
    assert np.mean([a > b for a in good for b in bad]) > 0.99


def test_held_out_labels_and_names_do_not_matter(spark):
    """Turning the labels of held-out rows round, or the language and source of all, changes no score."""
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    turned = labels.withColumn(
        "quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality"))
    )
    first = quality.scored(docs, quality.train(docs, labels))
    second = quality.scored(docs.withColumn("lang", quality.F.lit("x")).withColumn("source", quality.F.lit("y")), quality.train(docs, turned))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_odd_rows(spark):
    rows = [
        (1, None, None, "", "", "", 1, ""), (2, "", 0, None, None, None, None, None), (None, "No id.", 6, "", "", "", 1, ""),
        (3, "Same text.", 10, "", "", "", 1, ""), (3, "Same text.", 10, "", "", "", 1, ""), (4, "long word " * 60_000, 600_000, "", "", "", 1, ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (2, 1), (3, 1), (4, 0), (None, 1), (9, None)], "doc_id long, quality int"
    )
    model = quality.train(frame, labels, ("n_chars",))
    found = sorted(
        (tuple(r) for r in quality.scored(frame, model, metadata=("n_chars",)).collect()),
        key=lambda r: (r[0] is None, r[0] or 0),
    )
    assert [r[0] for r in found] == [1, 2, 3, 3, 4, None] and all(0 <= r[1] <= 1 for r in found)
    assert found[2] == found[3]
    empty = spark.createDataFrame([], SCHEMA)
    assert not quality.scored(empty, model).collect()
    for docs, known in ((empty, labels), (frame, labels.limit(0)), (frame, labels.filter("quality = 1"))):
        flat = {r.score for r in quality.scored(frame, quality.train(docs, known)).collect()}
        assert len(flat) == 1 and 0.5 <= flat.pop() < 1


def test_the_sample_is_bounded_where_an_id_repeats(spark):
    frame = spark.createDataFrame([(3, f"Text {i}.") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    assert quality.train(frame, labels, max_rows=10).weights.shape == (quality.SIZE,)
