import random
import re

import numpy as np
import xxhash

from loomline.llm import simhash
from tests.llm.data import frame, odd_rows, row, words


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(prints))]


def test_golay_home_is_unchanged_by_three_errors():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 500)
    word = x ^ simhash._PATTERNS[simhash._remainder(x)]
    assert (simhash._remainder(word) == 0).all()
    for weight in range(4):
        error = np.array([sum(1 << int(b) for b in rng.choice(23, weight, replace=False)) for _ in x])
        assert (simhash.home(word ^ error) == word >> 11).all()


def test_documents_match_brute_force(spark):
    rng, rows = random.Random(3), []
    for i in range(60):
        text = words(rng.randint(4, 200), i)
        rows.append(row(i, " ".join(text)))
        for k in range(rng.randint(0, 2)):
            copy = list(text)
            copy[rng.randrange(len(copy))] = "changed"
            rows.append(row(1000 + 10 * i + k, " ".join(copy).title()))
    rows += odd_rows(5000)
    expected = [(r[0], brute_fingerprint(r[1])) for r in rows]
    component = brute_components(expected)
    got = simhash.near_copies(frame(spark, rows)).select("doc_id", simhash.hex_digits(simhash.F.col("fp")).alias("f"), "component_id")
    found = sorted((r.doc_id, int(r.f, 16), r.component_id) for r in got.collect())
    assert found == sorted((d, f, c) for (d, f), c in zip(expected, component))
    assert len(set(component)) < len({d for d, _ in expected})


def test_full_keys_connect_the_same(spark):
    """A ball of fingerprints around one center overfills its keys; chains replace the pairs."""
    rng, center = random.Random(5), 0x9A5C3F0112E4D377
    prints = {center}
    while len(prints) < 300:
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame_ = spark.createDataFrame(signed, "fp bigint")
    expected = len(set(brute_components([(i, p[0] % (1 << 64)) for i, p in enumerate(signed)])))
    for bucket in (1, 16, 64, 1000):
        edges = [(r.a, r.b) for r in simhash.links(simhash.checkpointed(frame_), bucket).collect()]
        assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in edges)
        parent = {p[0]: p[0] for p in signed}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[find(a)] = find(b)
        assert len({find(x) for x in parent}) == expected


def shingles(text, width=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b) > 0


def near_groups(rows):
    """Rows ``(id, text)`` -> index of the first row of each row's group, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def test_dropping_keeps_one_of_each_group(spark):
    text = " ".join(words(50, 1))
    rows = [row(3, text), row(1, text.title()), row(2, "other words here"), row(None, text), row(None, None), row(8, " \n")]
    kept = simhash.drop_near_copies(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [1, 2, 8]


def test_repeated_ids_are_judged_by_their_rows(spark):
    """No unique text is lost and no copy stays, whatever the ids; the order of columns is kept."""
    a, b, c = (" ".join(words(40, i)) for i in (1, 2, 3))
    rows = [(a, 1), (a, 1), (a, 2), (b, 2), (c, None), (c, None), (None, 5), ("", 4)]
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "text string, doc_id bigint"))
    assert got.columns == ["text", "doc_id"]
    assert sorted((r.text or "", r.doc_id) for r in got.collect()) == sorted([(a, 1), (b, 2), (c, None), ("", 4)], key=lambda r: (r[0], r[1] or 0))


def test_near_copies_are_found_and_others_left_alone(spark):
    """Copies with one to four of 150 words edited; what is dropped is near to something kept."""
    rng, rows = random.Random(8), []
    for i in range(120):
        text = words(150, 100 + i)
        rows.append(row(i, " ".join(text)))
        copy = list(text)
        for at in rng.sample(range(150), 1 + i % 4):
            copy[at] = f"edit{rng.randrange(999)}"
        rows.append(row(1000 + i, " ".join(copy)))
    rows += [row(5000 + i, " ".join(words(60, 900 + i))) for i in range(60)]
    group = near_groups([(r[0], r[1]) for r in rows])
    kept = {r.doc_id for r in simhash.drop_near_copies(frame(spark, rows)).collect()}
    assert {g for g in group} == {g for g, r in zip(group, rows) if r[0] in kept}  # every group keeps a row
    near = len(rows) - len(set(group))
    assert len(rows) - len(kept) >= 0.9 * near


def test_empty_table(spark):
    assert simhash.near_copies(frame(spark, [])).collect() == []


def test_copies_of_many_texts_with_one_fingerprint(spark):
    """Texts of the same words in other orders share every fingerprint; each has one near copy, which is found."""
    rng, base, rows = random.Random(5), [f"w{i}x{i * i}" for i in range(120)], []
    for i in range(100):
        text = rng.sample(base, len(base))
        rows.append(row(i, " ".join(text)))
        text[60], text[61] = text[61], text[60]
        rows.append(row(1000 + i, " ".join(text)))
    kept = {r.doc_id for r in simhash.drop_near_copies(frame(spark, rows)).collect()}
    assert kept == set(range(100))


def test_sketches_rule_out_no_similar_pair(spark):
    rng, sets = random.Random(6), []
    for i in range(300):
        text = words(rng.choice([7, 30, 400]), i % 60)
        text[rng.randrange(len(text))] = f"edit{i}"
        sets.append((i, " ".join(text)))
    df = spark.createDataFrame(sets, "row long, text string")
    facts = df.mapInArrow(lambda b: simhash.word_fingerprints(b, 1, 5), "row bigint, h bigint, fps array<bigint>, size bigint, sketch array<bigint>")
    a, b = (facts.select(*[simhash.F.col(c).alias(f"{c}_{s}") for c in ("row", "size", "sketch")]) for s in "ab")
    may = {(r.row_a, r.row_b) for r in a.crossJoin(b).where(simhash.may_be_similar("a", "b", 0.8)).collect()}
    parts = [shingles(t) for _, t in sets]
    for i in range(len(sets)):
        for j in range(len(sets)):
            assert (i, j) in may or not similar(parts[i], parts[j])
    assert len(may) < 0.7 * len(sets) ** 2
