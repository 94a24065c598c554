import random

import numpy as np
import pyarrow as pa
import pytest

from siftlake.llm import textblocks as tb, toxicity as tx
from conftest_helpers import prose


def labelled(n, seed=1):
    """Marked texts hold a few words of a family the others never use; some of its members occur once only."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = prose(seed * 10_000 + i, r.choice([5, 40, 150])).split(" ")
        toxic = i % 3 == 0
        for _ in range(2 if toxic else 0):
            w.insert(r.randrange(len(w) + 1), r.choice(["vilgrok", "vilgrat"]) + r.choice(["", "us", "em", str(i)]))
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_gradients():
    net = tx.train(["vile a b c", "all fine here now", "you vile", "good x"], np.array([1, 0, 1, 0]), epochs=1)
    block, found = next(tb.terms(pa.array(["some vile words here", "x", "all good " * 20])))
    place, v = tx._distinct(block, found)
    begins, lengths, _ = tx._windows(found.bounds)
    places = tx._places(place, begins, lengths, len(v.words))
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    x = net.inputs(v).astype(np.float64)
    logit, kept = net.forward(x, places, keep=True)
    d = np.linspace(0.5, 1, len(logit))
    grad, d_x = net.backward(x, places, kept, d)

    def numeric(array, at, step=1e-4):
        out = []
        for sign in (1, -1):
            array[at] += sign * step
            out.append((net.forward(x, places) * d).sum())
            array[at] -= sign * step
        return (out[0] - out[1]) / (2 * step)

    for name, g in grad.items():
        w = net.weights[name]
        at = tuple(n // 2 for n in w.shape)
        assert g[at] == pytest.approx(numeric(w, at), rel=2e-2, abs=1e-6), name
    assert d_x[1, 1] == pytest.approx(numeric(x, (1, 1)), rel=2e-2, abs=1e-6)


def test_held_out_accuracy_and_windows(spark, table):
    rows = labelled(420)
    docs = table([(i, t, "en", "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in tx.toxicity_table(docs, labels).collect()}
    own = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(got) == len(rows) and sum(p == y for p, y in own) >= 0.9 * len(own)
    # The marked words count wherever they stand in a long text.
    net = tx.fit(docs, labels)
    far = prose(77, 3000).split(" ")
    far[2500:2500] = ["vilgrokus", "vilgratem"]
    clean = prose(77, 3000)
    a, b = (r.score for r in tx.scored(table([(0, " ".join(far), None, None), (1, clean, None, None)]), net).orderBy("doc_id").collect())
    assert a > tx.THRESHOLD and a > b


def test_a_window_is_scored_alike_in_any_batch():
    net = tx.train([t for _, t, _ in labelled(30)], np.array([y for *_, y in labelled(30)]), epochs=1)

    def scores(texts):
        out = []
        for block, found in tb.terms(pa.array(texts)):
            place, v = tx._distinct(block, found)
            begins, lengths, owner = tx._windows(found.bounds)
            logit = net.forward(net.inputs(v), tx._places(place, begins, lengths, len(v.words)))
            out += [logit[owner == i].max() for i in range(len(block))]
        return out

    texts = ["", "a", "é", "one two", prose(1, 31), prose(1, 32), prose(1, 33), prose(2, 500)]
    assert np.allclose(scores(texts), [scores([t])[0] for t in texts], atol=1e-4)


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (4, None), (None, 1), (5, 0), (99, 1)], "doc_id long, toxic int")
    got = tx.toxicity_table(awkward, labels).collect()
    assert len(got) == awkward.count() and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got)
    assert len({g.score for g in got if g.doc_id == 3}) == 1
    assert tx.toxicity_table(empty, labels).collect() == []
    assert {g.score for g in tx.toxicity_table(awkward, labels.where("toxic = 2")).collect()} == {0.0}
