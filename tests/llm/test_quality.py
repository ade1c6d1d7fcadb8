import random
import re
from collections import Counter

import numpy as np

from loomline.llm import quality
from tests.llm.data import frame, odd_rows, row, words


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    twice = [False] * len(w)
    for k in range(len(w) - 4):
        if found[tuple(w[k : k + 5])] > 1:
            twice[k : k + 5] = [True] * 5
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(twice)


def corpus():
    rng, rows = random.Random(1), []
    for i in range(300):
        text = words(rng.randint(8, 200), i)
        kind = i % 20
        if kind == 0:
            text = [w + "***" for w in text]
        elif kind == 1:
            text = text[:12] * 6
        elif kind == 2:
            text = [x for w in text for x in (w, "|")]
        lines = [" ".join(text[k : k + 9]) for k in range(0, len(text), 9)]
        rows.append(row(i, "\n".join(lines + lines[:1] * (kind == 3)), lang="en" if i % 3 else "fr", source=f"s{i % 4}"))
    return rows


def test_counts_and_verdicts(spark):
    rows = corpus() + odd_rows(5000)
    got = quality.judged(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text, *_ in rows:
        r = by_id[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), doc_id
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)
    plain = [by_id[i] for i in range(300) if i % 20 > 3 and not by_id[i].base_failed]
    junk = [by_id[i] for i in range(300) if i % 20 in (0, 2) and by_id[i].n_words >= 30]
    assert all(r.kept for r in plain) and not any(r.kept for r in junk)


def test_estimate_resists_a_quarter_of_outliers(spark):
    """Location stays at the bulk where the plain mean does not."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (300, 5)), rng.normal(12, 1, (80, 5))
    rows = [("g", *map(float, x)) for x in np.vstack([good, bad])]
    points = spark.createDataFrame(rows, "peers string, " + ", ".join(f"{n} double" for n in quality.FLOORS))
    est = quality.estimates(quality.checkpointed(points)).collect()[0]
    assert np.abs(np.array(est["mean"])).max() < 0.4
    inverse = np.array(est["inverse"]).reshape(5, 5)
    d = lambda x: np.einsum("ni,ij,nj->n", x - est["mean"], inverse, x - est["mean"])
    assert (d(bad) > quality.CUTOFF).all() and (d(good) < quality.CUTOFF).mean() > 0.99


def test_small_and_empty(spark):
    one = quality.judged(frame(spark, [row(1, " ".join(words(40, 1)))])).collect()
    assert one[0].kept and quality.judged(frame(spark, [row(1, None)])).collect()[0].base_failed
    assert quality.judged(frame(spark, [])).collect() == []


def test_fallback_groups_hold_all_their_documents(spark):
    """Outliers of a small source, and of a rare language, are judged by the language and by all."""
    def text(i, sign=""):
        return " ".join(w + sign for w in words(60, i))

    rows = [row(i, text(i), lang="en", source="hot") for i in range(200)]
    rows += [row(1000, text(1000, "***"), lang="en", source="tiny"), row(1001, text(1001), lang="en", source="tiny")]
    rows += [row(2000 + i, text(2000 + i, "***"), lang="xx", source=f"s{i}") for i in range(3)]
    rows += [row(2010, text(2010), lang="xx", source="s9")]
    got = {r.doc_id: r for r in quality.judged(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert (got[0].peers, got[1000].peers, got[2000].peers) == (got[0].peers, "=en", "all") and "hot" in got[0].peers
    assert all(got[i].kept for i in [*range(200), 1001, 2010])
    assert not any(got[i].kept for i in (1000, 2000, 2001, 2002))


def test_groups_are_counted_without_failed_documents(spark):
    rows = [row(i, " ".join(words(60, i)), source="hot") for i in range(100)]
    rows += [row(500 + i, "too short", source="small") for i in range(80)]
    rows += [row(600, " ".join(w + "***" for w in words(60, 600)), source="small")]
    got = {r.doc_id: r for r in quality.judged(frame(spark, rows)).collect()}
    assert not got[600].kept and got[0].kept
