import random
import re
import zlib
from collections import Counter

import pytest

from loomline.llm import spelling
from tests.llm.data import frame, odd_rows, row

LETTERS = "abéß"


def brute_words(rows, min_length=5, min_count=3, noise=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, times=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        last = w
        while form[last] is not None:
            last = form[last]
        out.append((w, counts[w], len(near[w]), form[w], counts.get(form[w]), last))
    return sorted(out)


def result(found):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found.collect())


@pytest.mark.parametrize("full", [1, 4, 64])
def test_variants_match_brute_force(spark, full, grouping):
    rng = random.Random(3)
    pool = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 8))) for _ in range(250)]
    texts = [" ".join(rng.choices(pool, range(1, len(pool) + 1), k=300)) + "1X2_Été" for _ in range(20)]
    rows = [row(i, t.title() if i % 3 else t) for i, t in enumerate(texts)] + odd_rows(900)
    rows += [row(None, "nullid nullid nullid"), row(7, texts[7]), row(-4, "minus " * 5)]
    want = brute_variants(brute_words([(r[0], r[1]) for r in rows], 2, 2, 5))
    got = result(spelling.variants(frame(spark, rows), 2, 2, 5, full=full))
    assert got == want
    assert any(w[3] and w[5] != w[3] for w in want) and any(w[2] > 3 for w in want)


def test_every_single_edit_is_found(spark):
    """Insertions, deletions and replacements at every place of short and long words."""
    rng, pairs = random.Random(1), set()
    base = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (5, 6, 7, 8, 9, 12, 17, 33)]
    words = set(base)
    for w in base:
        for i in range(len(w) + 1):
            words |= {w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1 :]}
    words = sorted(w for w in words if len(w) >= 5)
    pairs = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
    table = spelling.checkpointed(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"))
    for full in (1, 8, 64):
        assert {(r.a, r.b) for r in spelling.near(table, full).collect()} == pairs


def test_a_common_half_is_split_until_narrow(spark):
    """Two thousand words with one beginning: no key is joined while it holds more than 64."""
    rng = random.Random(2)
    words = sorted({"commonbeginning" + "".join(rng.choice("abc") for _ in range(9)) for _ in range(2000)})
    known, pairs = set(words), set()
    for w in words:
        for i in range(len(w)):
            pairs |= {(min(w, v), max(w, v)) for c in "abc" if (v := w[:i] + c + w[i + 1 :]) in known and v != w}
    table = spelling.checkpointed(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"))
    assert {(r.a, r.b) for r in spelling.near(table).collect()} == pairs


def test_long_texts_are_read_in_pieces():
    text = "ab1" * 50 + "x" * 40 + " " + "Été" * 30
    for size in (1, 7, 64, 10_000):
        parts = list(spelling.pieces(text, size))
        assert "".join(parts) == text
        assert [r for p in parts for r in re.findall(spelling.RUN, p)] == re.findall(spelling.RUN, text)


def test_empty_table(spark):
    assert spelling.variants(frame(spark, [])).collect() == []
