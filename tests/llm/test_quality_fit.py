"""Operator 2's query against a plain NumPy fit of the same pairs."""

import numpy as np
from pyspark.sql import functions as F

from portolan.llm import quality
from portolan.llm.common import table
from portolan.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def newton(d, ridge, steps=60):
    """Minimum of the logistic loss on the differences ``d`` with a ridge, to machine precision."""
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(d @ w))
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, (p[:, None] * d).mean(axis=0) - ridge * w)
    return w


def test_op2_equals_a_numpy_fit(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), quality.training_labels(table(spark, SF_SMALL, "labels"))
    sample = quality.labelled_sample(docs, labels, 20_000)
    size = len(quality.FEATURES)
    rows = sample.toPandas()
    x = rows[[f"x{k}" for k in range(size)]].to_numpy(np.float64)
    means, scales = x.mean(axis=0), x.std(axis=0)
    scales[scales == 0] = 1
    scaled = [(F.col(f"x{k}") - F.lit(float(means[k]))) / F.lit(float(scales[k])) for k in range(size)]
    pairs = quality.preference_pairs(sample, scaled, 4).toPandas().to_numpy(np.float64)
    # Each pair is a good document less a bad one.
    z, label = (x - means) / scales, rows["label"].to_numpy()
    good, bad = {tuple(np.round(r, 6)) for r in z[label == 1]}, z[label == 0]
    assert all(any(tuple(np.round(p + b, 6)) in good for b in bad) for p in pairs[::97])
    assert len(pairs) == 4 * max((label == 1).sum(), (label == 0).sum())
    w = newton(pairs, 1e-3)
    strength = z @ w
    threshold = np.quantile(strength, ((label == 0).sum() - 0.5) / (len(label) - 1))
    model = quality.fit(docs, labels)
    assert np.allclose(model.weights, w, atol=1e-5) and np.isclose(model.threshold, threshold, atol=1e-4)
    scored = {r.doc_id: r for r in QUERIES["op2_quality_scores"](spark, SF_SMALL).collect()}
    want = 1 / (1 + np.exp(threshold - strength))
    for i, score in zip(rows["doc_id"], want, strict=True):
        assert abs(scored[i].score - score) < 1e-4 and scored[i].predicted == int(scored[i].score >= 0.5)
