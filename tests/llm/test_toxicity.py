import random

import pytest

from loomline.llm import toxicity
from tests.llm.data import frame, odd_rows, row, words

BAD = ["zorgut", "zorgish", "plenkwad", "plenkoso"]


def corpus(n=400):
    rng, rows, marks = random.Random(1), [], []
    for i in range(n):
        text, toxic = words(rng.randint(5, 150), i % 150), int(i % 5 == 0)
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text) + 1), rng.choice(BAD[:2] if i % 2 else BAD[2:]) + rng.choice(["", "s", "ed"]))
        rows.append(row(i, " ".join(text)))
        marks.append((i, 1, toxic, "x"))
    return rows, marks


LABELS = "doc_id bigint, quality int, toxic int, text string"


def test_unseen_toxic_texts_score_high(spark):
    rows, marks = corpus()
    marks += [(7, 1, None, "x"), (8, 1, 5, "x"), (None, 1, 1, "x"), (99999, 0, 1, "x")]
    scorer = toxicity.train(frame(spark, rows[:300]), spark.createDataFrame(marks, LABELS))
    test = frame(spark, rows[300:] + odd_rows(5000))
    got = toxicity.score(test, scorer, ["doc_id", "n_chars"]).collect()
    assert len(got) == 100 + len(odd_rows(0))
    score = {r.doc_id: r._score for r in got}
    assert all(0 <= s <= 1 for s in score.values())
    bad = [score[m[0]] for m in marks[300:400] if m[2]]
    good = [score[m[0]] for m in marks[300:400] if not m[2]]
    assert sum(b > g for b in bad for g in good) / (len(bad) * len(good)) > 0.98
    assert max(score[5000], score[5001], score[5002]) < toxicity.LIMIT


def test_a_long_text_with_one_bad_passage(spark):
    rows, marks = corpus()
    scorer = toxicity.train(frame(spark, rows), spark.createDataFrame(marks, LABELS))
    clean = words(5000, 77)
    dirty = clean[:2500] + ["zorgish", "zorguts", "plenkwads"] + clean[2500:]
    got = toxicity.score(frame(spark, [row(1, " ".join(clean)), row(2, " ".join(dirty))]), scorer, ["doc_id"]).collect()
    score = {r.doc_id: r._score for r in got}
    assert score[2] > score[1] and score[2] > 0.5


def test_filter_keeps_columns(spark):
    rows, marks = corpus()
    rows = rows + odd_rows(5000)
    kept = toxicity.drop_toxic(frame(spark, rows), spark.createDataFrame(marks, LABELS))
    assert kept.columns == frame(spark, rows).columns
    left = {r.doc_id for r in kept.collect()}
    toxic = {m[0] for m in marks if m[2]}
    assert len(left & toxic) <= 0.05 * len(toxic) and {r[0] for r in rows} - toxic <= left


@pytest.mark.parametrize("marks", [[], [(1, 1, 0, "x")], [(1, 1, 1, "x")]])
def test_no_or_one_sided_labels(spark, marks):
    scorer = toxicity.train(frame(spark, [row(1, "a b"), row(2, None)]), spark.createDataFrame(marks, LABELS))
    assert {r._score for r in toxicity.score(frame(spark, [row(1, "a b"), row(2, None)]), scorer, ["doc_id"]).collect()} == {0.5}
    assert toxicity.score(frame(spark, []), scorer, ["doc_id"]).collect() == []


def test_shared_backoff_is_a_distribution():
    """Continuation probabilities of one context sum to at most one over the bytes seen."""
    data = b"banana band bandana cabana "
    import numpy as np
    buf = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(buf == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    gram, context, _ = toxicity._grams(buf, starts, ends)
    gram = np.unique(gram)
    p = toxicity._shared(gram)
    ctx = toxicity._context(gram)
    for c in np.unique(ctx):
        assert 0 < p[ctx == c].sum() <= 1 + 1e-9
    assert set(np.unique(context)) == set(np.unique(ctx))


def test_model_is_bounded(spark):
    rows, marks = corpus(100)
    labelled = frame(spark, rows).selectExpr("text", "cast(doc_id % 5 = 0 as int) toxic", "cast(doc_id % 3 as int) fold")
    counts = toxicity.checkpointed(toxicity.gram_counts(labelled))
    gram, n = toxicity.collected(counts, 200)
    assert 0 < len(gram) <= 200 and len(n) == len(gram)
    assert n.sum(1).min() >= max(r for (r,) in counts.selectExpr("o0+t0+o1+t1+o2+t2 n").collect()) / 1000


def test_any_number_of_grams_scores_alike(spark):
    """A model too large to be collected drops no n-gram: scores are those of the collected one."""
    rows, marks = corpus(300)
    rows += odd_rows(5000) + [row(9000, "zorgish " * 4000), row(9001, "x" * 500 + " \u00e9t\u00e9 \u4f60\u597d")]
    labels = spark.createDataFrame(marks + [(9001, 1, 1, "x")], LABELS)
    docs = frame(spark, rows)
    got = []
    for most in (toxicity.MAX_GRAMS, 200):
        scorer = toxicity.train(docs, labels, max_grams=most)
        assert (scorer.tables is None) == (most > 200)
        got.append({r.doc_id: r._score for r in toxicity.score(docs, scorer, docs.columns).collect()})
    assert got[0].keys() == got[1].keys() == {r[0] for r in rows}
    assert max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-5
