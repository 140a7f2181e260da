import numpy as np
import pytest

from topicloom.llm import quality_classifier as quality
from topicloom.llm import toxicity


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(module, edge_docs, no_docs, some_labels):
    rows = module.classify(edge_docs, some_labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert module.classify(no_docs, some_labels).count() == 0
    unlabelled = module.classify(edge_docs, some_labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in unlabelled} == {0.5}


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 8))
    y = (x[:, 0] + x[:, 1] ** 2 - 1 + 0.3 * rng.normal(size=3000) > 0).astype(float)
    net = quality.Network().fit(x[:2000], y[:2000])
    p = net.predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.85
    assert net.temperature >= 1 and abs(p.mean() - y[2000:].mean()) < 0.05
    one = quality.Network().fit(x[:50], np.ones(50)).predict(x[:3])
    assert (one > 0.9).all()


def test_shapes():
    assert quality.shape(b"WORLD!!!") == b"A!!" and quality.shape(b"anoi***") == b"a**" and quality.shape(b"a1B") == b"a0A"


def test_isotonic_is_monotone_and_pools():
    fitted = toxicity.Isotonic().fit(np.array([0.0, 1, 2, 3, 4, 5]), np.array([0.0, 0, 1, 0, 1, 1]))
    p = fitted(np.linspace(-1, 6, 50))
    assert (np.diff(p) >= 0).all() and fitted(np.array([2.0])) == fitted(np.array([3.0]))


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    raw = toxicity.Trees().fit(x, y).raw(x)
    assert ((raw > 0) == y).mean() > 0.95


def test_features_see_obfuscation_and_nearness():
    of = toxicity.Features({"idiot": 4.0})
    at = dict(zip(toxicity.Features.NAMES, of("you are an 1d10t friend")))
    assert at["learned_count"] == 1 and at["obfuscated"] > 0 and at["near_person"] > 0
    assert not of("").any() and not of(None).any()
