import random
import re

import pytest

from loomline.llm import substrings
from tests.llm.data import frame, odd_rows, row, words


def brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows}, key=lambda x: x[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        out[doc_id] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def sample():
    rng, rows = random.Random(11), []
    passages = [words(n, 500 + n) for n in (19, 20, 21, 33, 60)]
    for i in range(60):
        text = words(rng.randint(0, 120), i)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(passages)
        rows.append(row(i, rng.choice([" ", "\n", " \t "]).join(text)))
    rows.append(row(70, "the " * 300))
    rows.append(row(71, "\n".join(["a b c d e"] * 40)))
    return rows + odd_rows(5000)


def test_cover_meets_every_distance():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


@pytest.mark.parametrize("bits", [substrings.TABLE_BITS, 1 << 15, 0], ids=["table", "small_table", "semi_join"])
def test_matches_brute_force(spark, bits):
    rows = sample()
    got = substrings.without_repeats(frame(spark, rows).repartition(5), bits).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected
    assert sum(v[1] for v in expected.values()) > 1000


def test_wide_ids_and_nulls(spark):
    text = " ".join(words(40, 1))
    rows = [row(-5, text), row(1 << 40, text), row(None, text), row(None, None)]
    got = {(r.doc_id, r.n_words): r.n_removed for r in substrings.without_repeats(frame(spark, rows)).collect()}
    assert got == {(-5, 40): 0, (1 << 40, 40): 40, (None, 40): 0, (None, 0): 0}


def test_empty_table(spark):
    assert substrings.without_repeats(frame(spark, [])).collect() == []
