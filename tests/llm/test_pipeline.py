"""The pipeline against brute force on the smallest tables, and on odd rows."""

import os
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from loomline.llm import decontaminate, toxicity
from tests.llm.data import frame, odd_rows, row, words
from tests.llm.test_mixing import targets
from tests.llm.test_simhash import near_groups

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def leaked(texts, items):
    """Documents with an item aligned to the limit, by alignment with every item of a common trigram."""
    fold = lambda t: next(iter(decontaminate.folded(pa.array([t or ""]))))[1].view(np.int64)
    grams = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    folded_items = [(w, grams(w)) for w in map(fold, items)]
    out = set()
    for doc_id, text in texts.items():
        w = fold(text)
        mine = grams(w)
        if any(g & mine and decontaminate.align(i, w)[0] >= decontaminate.LIMIT for i, g in folded_items):
            out.add(doc_id)
    return out


@needs_tables
def test_stages_match_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    docs = read("documents")
    toxic, dedup, leaks, secrets, mix = (f for _, f in corpus_pipeline.STAGES)
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    one = toxicity.checkpointed(toxic(spark, docs, SF_DIR))
    scorer = toxicity.train(docs, read("labels"))
    low = {r.doc_id for r in toxicity.score(docs, scorer, ["doc_id"]).where("_score < 0.7").collect()}
    assert set(texts(one)) == low and one.columns == docs.columns

    two = toxicity.checkpointed(dedup(spark, one, SF_DIR))
    rows = sorted(texts(one).items())
    group, kept = near_groups(rows), set(texts(two))
    assert set(group) == {g for g, (i, _) in zip(group, rows) if i in kept}  # nothing unique is lost
    assert len(rows) - len(kept) >= 0.9 * (len(rows) - len(set(group))) and two.columns == docs.columns

    three = toxicity.checkpointed(leaks(spark, two, SF_DIR))
    gone = leaked(texts(two), [r.text for r in read("benchmark").collect()])
    assert set(texts(three)) == set(texts(two)) - gone and three.columns == docs.columns

    four = toxicity.checkpointed(secrets(spark, three, SF_DIR))
    assert four.columns == docs.columns
    plain = re.compile(r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}")
    assert texts(four) == {i: plain.sub("[SECRET]", t) for i, t in texts(three).items()}
    assert all(r.n_chars == len(r.text) for r in four.collect())

    five = mix(spark, four, SF_DIR).collect()
    assert {r.doc_id for r in five} == set(texts(four))
    size = {}
    for r in five:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts_of(four)[r.doc_id] or ""))
        size[r.source] = size.get(r.source, 0) + r.size
    goal = targets(size, {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size))})
    for s in size:
        assert sum(r.taken for r in five if r.source == s) == pytest.approx(goal[s], abs=1)

    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, five))


_CACHE = {}


def texts_of(df):
    if id(df) not in _CACHE:
        _CACHE[id(df)] = {r.doc_id: r.text for r in df.collect()}
    return _CACHE[id(df)]


@needs_tables
def test_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "mixing"]


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(words(30, 3)))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in ([], odd_rows(0) + [row(None, "no id"), row(50, " ".join(words(40, 4)))]):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = toxicity.checkpointed(stage(spark, docs, folder))
            if name != "mixing":
                assert out.columns == docs.columns
                docs = out
        assert out.count() == docs.count()
        assert bool(rows) == bool(docs.count())


@pytest.mark.parametrize("stage", [0, 1])
def test_long_texts_go_to_python_in_small_batches(spark, tmp_path, stage):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), "id", F.lit(" ")), 5000).alias("text")).coalesce(1)
    kept = corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    got = docs.select("text").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 400 and max(r["size"] for r in got) < 8 << 20
