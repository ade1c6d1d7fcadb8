import re

import pytest
from pyspark.sql import functions as F

from loomline.llm import mixing
from tests.llm.data import frame, odd_rows, row, words


def targets(source_size, weight, cap=3.0):
    """Shares by weight; what exceeds the cap is shared again until none is above."""
    total, capped = sum(source_size.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = {s: w for s, w in weight.items() if s not in capped}
        share = {s: w * rest / sum(free.values()) for s, w in free.items()}
        over = {s for s in free if share[s] > cap * source_size[s]}
        if not over:
            return capped | share
        capped |= {s: cap * source_size[s] for s in over}


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_is_exact(spark, n):
    out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), "k").alias("p")).collect()
    assert sorted(r.p for r in out) == list(range(n))


def test_mix_meets_targets(spark):
    rows = [row(i, " ".join(words(i % 90, i)), source=f"s{i % 7}") for i in range(300)]
    rows += [row(1000 + i, "w " * 8000, source="hot") for i in range(20)] + [row(2000, "a b c", source="tiny")]
    rows += [row(3000, None, source="void")] + odd_rows(5000)
    got = mixing.taken(frame(spark, rows)).collect()
    again = mixing.taken(frame(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert len(got) == len(rows)
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    expected = targets(size, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    for s in order:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {size[s]}
        assert all(r.target == pytest.approx(expected[s]) for r in mine)
        assert sum(r.taken for r in mine) == pytest.approx(expected[s], abs=1)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
    assert expected["tiny"] == 9 and expected["void"] == 0


def test_slots_fill_shards_once(spark):
    rows = [row(i, "w " * 500, source=f"s{i % 3}") for i in range(30)]
    mix = mixing.plan(mixing.sizes(frame(spark, rows)), block=16, shard=100)
    slots = mix["slots"].collect()
    places = sorted((r.shard, r.slot) for r in slots)
    assert places == [(i // 100, i % 100) for i in range(len(slots))]
    assert {r.key for r in slots if r.shard == 0} == {"=s0", "=s1", "=s2"}


def test_given_weights_and_empty_table(spark):
    rows = [row(i, "w " * 100, source=f"s{i % 2}") for i in range(10)]
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 3.0)], "source string, weight double")
    got = {r.source: r.target for r in mixing.taken(frame(spark, rows), weights).collect()}
    assert got == {"s0": 250.0, "s1": 750.0}
    assert mixing.taken(frame(spark, [])).collect() == []
