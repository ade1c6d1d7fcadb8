import random

import numpy as np

from loomline.llm import language
from tests.llm.data import frame, odd_rows, row, words

STEMS = {"aa": "aeiou", "bb": "äöüye", "cc": "óáíéa"}


def corpus(n=240):
    rng = random.Random(1)
    return [
        row(i, " ".join(words(rng.randint(3, 80), i, STEMS[lang])), lang)
        for i, lang in ((i, rng.choice(sorted(STEMS))) for i in range(n))
    ]


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    unlabelled = [row(900, "text without a language", None), row(901, None, "aa"), row(None, "x y", "aa")]
    net = language.train(frame(spark, rows[:160] + unlabelled), steps=300)
    assert net.languages == sorted(STEMS)
    got = language.identify(frame(spark, rows[160:] + odd_rows(5000)), net, ["doc_id", "key"]).collect()
    assert len(got) == 80 + len(odd_rows(0))
    pred = {r.doc_id: (r.lang_pred, r.lang_score) for r in got}
    assert np.mean([pred[r[0]][0] == r[2] for r in rows[160:]]) > 0.95
    for und in (5000, 5001, 5002, 5007):
        assert pred[und] == ("und", 0.0)
    assert all(p in net.languages and 0 < s <= 1 for d, (p, s) in pred.items() if d not in (5000, 5001, 5002, 5007))


def test_gradients_match_differences():
    net = language.Network.fresh(["x", "y"], 3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    codes, label = rng.integers(97, 105, (5, 4)), np.array([0, 1, 1, 0, 1])
    _, grads = net.gradients(codes, label)
    for name, w in net.weights.items():
        flat, g = w.reshape(-1), grads[name].reshape(-1)
        for i in rng.integers(0, len(flat), 6):
            i = int(i) if name != "embed" else int(codes[0, 0]) * language.EMBED + int(i) % language.EMBED
            keep = flat[i]
            flat[i] = keep + 1e-3
            up = net.gradients(codes, label)[0]
            flat[i] = keep - 1e-3
            down = net.gradients(codes, label)[0]
            flat[i] = keep
            assert abs((up - down) / 2e-3 - g[i]) < 2e-3 * max(1, abs(g[i])) + 1e-4


def test_labels_do_not_depend_on_the_cache(monkeypatch):
    net = language.Network.fresh(["x", "y", "z"], 3)
    import pyarrow as pa
    texts = pa.array([" ".join(words(200, i)) for i in range(10)] * 2)
    one = language._pooled(language._Labeller(net), texts)[0]
    monkeypatch.setattr(language, "CACHE_WORDS", 50)
    two = language._pooled(language._Labeller(net), texts)[0]
    assert np.allclose(one, two, atol=1e-5)


def test_nothing_to_learn_from(spark):
    assert language.train(frame(spark, [row(1, "a b", None), row(2, None, "aa"), row(3, "12", "aa")])) is None
    got = language.identify(frame(spark, [row(1, "a b")]), None, ["doc_id"]).collect()
    assert (got[0].lang_pred, got[0].lang_score) == ("und", 0.0)
    assert language.identify(frame(spark, []), None, ["doc_id"]).collect() == []
