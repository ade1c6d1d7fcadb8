import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomline.llm import packing
from tests.llm.data import frame, odd_rows, row, words

PATH = str(public_tokenizers.path(packing.TOKENIZER))


def check(rows, capacity):
    """Sequences are gapless from 0 and no longer than the capacity; returns how many."""
    places = {}
    for length, sequence, offset in rows:
        places.setdefault(sequence, []).append((offset, length))
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_match_the_tokenizer(spark):
    rng = random.Random(1)
    rows = odd_rows(0) + [
        row(50 + i, rng.choice([" ", "  ", "\n", " \n ", "\t", "  "]).join(words(rng.randint(1, 400), i))) for i in range(40)
    ] + [row(None, "a  b\n c"), row(99, "it's   1234 <|endoftext|> x<|endoftext|> \x1c é  中文字 中文 " * 30), row(100, " lead"), row(101, "trail "), row(102, "  ")]
    tokenizer, want = Tokenizer.from_file(PATH), []
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        pieces = -(-len(ids) // 256)
        first = len(ids) - 256 * (pieces - 1)
        for p in range(pieces):
            start = 0 if p == 0 else first + 256 * (p - 1)
            own = ids[start : first + 256 * p]
            want.append((r[0], p, start, len(own), np.array(own, "<u4").tobytes()))
    found = packing.packed(frame(spark, rows), PATH, capacity=256).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    check([(r.length, r.sequence_id, r.offset) for r in found], 256)


KINDS = {
    "log": lambda r: min(2047, max(1, int(r.lognormvariate(6.4, 0.9)))), "flat": lambda r: r.randint(1, 2047), "large": lambda r: r.randint(1025, 2047),
    "thirds": lambda r: r.randint(650, 720), "tiny": lambda r: r.randint(1, 30), "one": lambda r: 700,
}


@pytest.mark.parametrize("kind", KINDS)
def test_search_never_needs_more_bins_than_best_fit(kind):
    rng = random.Random(2)
    lengths = [KINDS[kind](rng) for _ in range(1500)]
    number = packing.packed_group(np.array(lengths), 2048)
    fills = np.bincount(number, weights=lengths)
    assert fills.max() <= 2048 and fills.sum() == sum(lengths)
    bins = len(set(number.tolist()))
    assert packing.fewest(lengths, 2048) <= bins <= len(packing.best_fit(lengths, 2048))
    if kind in ("log", "tiny", "large"):
        assert bins <= packing.fewest(lengths, 2048) + 1


def test_small_cases_are_optimal():
    """Against all partitions: the search is at most one bin from the best, and the bound never above it."""

    def best(lengths, capacity):
        least = len(lengths)

        def put(i, bins):
            nonlocal least
            if len(bins) >= least:
                return
            if i == len(lengths):
                least = len(bins)
                return
            for b in range(len(bins)):
                if bins[b] + lengths[i] <= capacity:
                    bins[b] += lengths[i]
                    put(i + 1, bins)
                    bins[b] -= lengths[i]
            put(i + 1, [*bins, lengths[i]])

        put(0, [])
        return least

    rng, exact = random.Random(3), 0
    for _ in range(150):
        lengths = [rng.randint(1, 19) for _ in range(rng.randint(1, 9))]
        true = best(lengths, 20)
        found = len(set(packing.packed_group(np.array(lengths), 20).tolist()))
        assert packing.fewest(lengths, 20) <= true <= found <= true + 1
        exact += found == true
    assert exact >= 148


def test_trades_raise_squared_fill():
    rng = random.Random(4)
    bins = [[s for s in (rng.randint(1, 40), rng.randint(1, 30), rng.randint(1, 20)) if s] for _ in range(80)]
    after = packing.improved(bins, 100)
    assert sorted(s for b in bins for s in b) == sorted(s for b in after for s in b)
    assert sum(sum(b) ** 2 for b in after) > sum(sum(b) ** 2 for b in bins) and len(after) < len(bins)


def test_groups_meet_in_later_rounds(spark):
    """Many small groups still end near the fewest sequences that the tokens allow."""
    rng = random.Random(5)
    lengths = [KINDS["log"](rng) for _ in range(4000)] + [2048] * 50
    rows = packing.checkpointed(spark.createDataFrame(list(enumerate(lengths)), "row bigint, length bigint"))
    found = packing.placed(rows, group=200).collect()
    assert sorted(r.row for r in found) == list(range(len(lengths)))
    bins = check([(lengths[r.row], r.sequence_id, r.offset) for r in found], 2048)
    assert bins <= 1.01 * sum(lengths) / 2048
    whole = check([(lengths[r.row], r.sequence_id, r.offset) for r in packing.placed(rows).collect()], 2048)
    assert whole <= -(-sum(lengths) // 2048) + 2


def test_hot_copies_and_empty_table(spark):
    rows = [row(1, "same text") for _ in range(500)] + [row(2, None), row(3, "")]
    found = packing.packed(frame(spark, rows), PATH, capacity=16, group=64).collect()
    assert len(found) == 502
    check([(r.length, r.sequence_id, r.offset) for r in found], 16)
    assert packing.packed(frame(spark, []), PATH).collect() == []
