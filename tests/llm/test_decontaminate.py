import random

from loomline.llm import decontaminate
from tests.llm.data import frame, odd_rows, row, words

ITEMS = "item_id bigint, text string, doc_id int, seed string"


def cases():
    rng = random.Random(2)
    items = [(i, " ".join(words(rng.randint(12, 60), 700 + i)), 1, "x") for i in range(12)]
    items += [(50, None, 1, "x"), (51, "", 1, "x"), (52, "a b", 1, "x"), (0, items[0][1], 1, "x")]
    rows, expected = [], set()
    for i in range(60):
        text = words(rng.randint(5, 300), i)
        if i % 3 == 0:
            item = rng.randrange(12)
            copy = items[item][1].split()
            for _ in range(len(copy) // 8 if i % 2 else 0):  # edited copies
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in copy] if i % 4 == 0 else copy
            expected.add((i, item))
        rows.append(row(i, " ".join(text)))
    half = items[3][1].split()
    rows.append(row(200, " ".join(words(20, 1) + half[: len(half) // 4] + words(20, 2))))  # a quarter is no leak
    return rows + odd_rows(5000), items, expected


def test_planted_leaks(spark):
    rows, items, expected = cases()
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected
    assert len(got) == len(expected)
    assert all(0.5 <= r.score <= 1.0 and r.start < r.end for r in got)
    kept = decontaminate.drop_leaks(frame(spark, rows), spark.createDataFrame(items, ITEMS))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if r[0] not in {d for d, _ in expected})


def test_a_passage_in_most_documents_is_still_found(spark):
    passage = " ".join(words(30, 900))
    rows = [row(i, " ".join(words(20, i)) + " " + passage) for i in range(300)]
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame([(1, passage, 0, "")], ITEMS))
    assert got.count() == 300


def test_alignment_matches_a_plain_one():
    rng = random.Random(4)
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(4) for _ in range(rng.randint(1, 15))]
        best = 0
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
                best = max(best, h[i][j])
        score, start, end = decontaminate.align(decontaminate.np.array(a), decontaminate.np.array(b))
        assert score == best / (2 * len(a)) and 0 <= start <= end <= len(b)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.leaks(frame(spark, odd_rows(0)), none).collect() == []
    assert decontaminate.leaks(frame(spark, []), spark.createDataFrame([(1, "a b c d e f", 0, "")], ITEMS)).collect() == []
