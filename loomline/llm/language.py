"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of each word (lower-cased, up to ``PIECE`` bytes at a time) from
both ends, its state starting anew at every word, and labels every position with a
probability for each language. A document's probability pools the logarithms over the
positions of all its words with a letter. Equal words have equal labels, so each is computed
once per slice of text and kept in a bounded cache.

Training is backpropagation through time in numpy with Adam, on a bounded sample of labelled
words (``TRAIN_DOCS`` documents and ``TRAIN_WORDS`` words per language). The weights, a few
thousand numbers, go to the workers; whole texts are labelled there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, find_words, hash_ranges, slices, small_partitions

EMBED, HIDDEN = 16, 16
STEPS, BATCH, RATE = 1200, 256, 0.01
TRAIN_DOCS, TRAIN_WORDS = 400, 20_000
PIECE = 32
UNKNOWN = "und"
SLICE = 2 << 20
CACHE_WORDS = 300_000
# Pooled positions that count as independent evidence in a score.
EVIDENCE = 30


# -- network ------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights: byte embedding, a cell (input, state, bias) per direction, and the output layer."""

    weights: dict[str, np.ndarray]
    languages: list[str]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.3, (256, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, len(languages))),
             "out_bias": np.zeros(len(languages))}
        for d in ("fwd", "bwd"):
            w[f"{d}_in"] = rng.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN))
            w[f"{d}_state"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            w[f"{d}_bias"] = np.zeros(3 * HIDDEN)
        return cls({k: v.astype(np.float32) for k, v in w.items()}, languages)

    def _run(self, codes: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after each byte of ``codes`` (words x length) in direction ``d``."""
        w = self.weights
        table = w["embed"] @ w[f"{d}_in"] + w[f"{d}_bias"]
        u = w[f"{d}_state"]
        n, length = codes.shape
        h = np.zeros((n, HIDDEN), np.float32)
        states, tape = np.empty((length, n, HIDDEN), np.float32), []
        order = range(length) if d == "fwd" else range(length - 1, -1, -1)
        for t in order:
            x, s = table[codes[:, t]], h @ u
            gates = _sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            new = h + z * (c - h)
            if keep:
                tape.append((t, h, z, r, c, s[:, 2 * HIDDEN :]))
            h = states[t] = new
        return states, tape

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Per position (length x words x languages) the log-probability of each language."""
        both = np.concatenate([self._run(codes, d, False)[0] for d in ("fwd", "bwd")], 2)
        logits = both @ self.weights["out"] + self.weights["out_bias"]
        logits -= logits.max(2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(2, keepdims=True))

    def gradients(self, codes: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions and its gradients, by backpropagation through time."""
        w, (n, length) = self.weights, codes.shape
        runs = {d: self._run(codes, d, True) for d in ("fwd", "bwd")}
        both = np.concatenate([runs["fwd"][0], runs["bwd"][0]], 2)
        logits = both @ w["out"] + w["out_bias"]
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        loss = float(-np.log(np.maximum(p[:, np.arange(n), label], 1e-12)).mean())
        p[:, np.arange(n), label] -= 1
        p /= n * length
        g = {"out": np.einsum("tnh,tnk->hk", both, p), "out_bias": p.sum((0, 1)), "embed": np.zeros_like(w["embed"])}
        up = p @ w["out"].T
        for k, d in enumerate(("fwd", "bwd")):
            u, own = w[f"{d}_state"], up[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_state, d_table = np.zeros_like(u), np.zeros((256, 3 * HIDDEN), np.float32)
            carry = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, c, s in reversed(runs[d][1]):
                dh = carry + own[t]
                dc = dh * z * (1 - c * c)
                dz = dh * (c - h) * z * (1 - z)
                dr = dc * s * r * (1 - r)
                dx = np.concatenate([dz, dr, dc], 1)
                ds = np.concatenate([dz, dr, dc * r], 1)
                np.add.at(d_table, codes[:, t], dx)
                d_state += h.T @ ds
                carry = dh * (1 - z) + ds @ u.T
            g[f"{d}_state"], g[f"{d}_bias"] = d_state, d_table.sum(0)
            g[f"{d}_in"] = w["embed"].T @ d_table
            g["embed"] += d_table @ w[f"{d}_in"].T
        return loss, g


def fit(words: list[bytes], label: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Train on words (1 to ``PIECE`` bytes) and their language numbers; languages weigh alike."""
    net, rng = Network.fresh(languages, seed), np.random.default_rng(seed)
    length = np.array([len(x) for x in words])
    share = 1 / np.bincount(label, minlength=len(languages))[label]
    groups = []
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        groups.append((np.array([list(words[i]) for i in rows]), label[rows], share[rows] / share[rows].sum(), n * share[rows].sum()))
    chance = np.array([g[3] for g in groups])
    chance /= chance.sum()
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(x) for k, x in net.weights.items()}
    for step in range(1, steps + 1):
        codes, y, p, _ = groups[rng.choice(len(groups), p=chance)]
        rows = rng.choice(len(y), BATCH, p=p)
        _, g = net.gradients(codes[rows], y[rows])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for k, x in g.items():
            x = x * min(1.0, 1.0 / max(norm, 1e-12))
            m[k] += 0.1 * (x - m[k])
            v[k] += 0.001 * (x * x - v[k])
            net.weights[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
    return net


# -- Spark --------------------------------------------------------------------


def _first_per_language(df: DataFrame, n: int, *order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(*order), *order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def train(docs: DataFrame, seed: int = 7, steps: int = STEPS) -> Network | None:
    """Network from ``(doc_id, text, lang)``; ``None`` if no labelled text has a word.

    Rows with a null language, id or text teach nothing.
    """
    ids = docs.where("lang is not null and doc_id is not null and text is not null").select("doc_id", "lang")
    chosen = checkpointed(_first_per_language(ids, TRAIN_DOCS, "doc_id")).select("doc_id").distinct()
    texts = docs.where("lang is not null").select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")
    words = texts.select("doc_id", "lang", F.posexplode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("at", "word"))
    words = words.where(F.col("word").rlike(r"\p{L}"))
    rows = _first_per_language(words, TRAIN_WORDS, "doc_id", "at").select("lang", "word").toArrow()
    if not rows.num_rows:
        return None
    names = rows.column("lang").to_pylist()
    languages = sorted(set(names))
    raw = [w.encode() for w in rows.column("word").to_pylist()]
    number = {x: i for i, x in enumerate(languages)}
    pieces = [(w[k : k + PIECE], number[x]) for w, x in zip(raw, names) for k in range(0, len(w), PIECE)]
    return fit([p for p, _ in pieces], np.array([y for _, y in pieces]), languages, steps, seed)


class _Labeller:
    """Sums of position log-probabilities of words, with a bounded cache by word hash."""

    def __init__(self, net: Network):
        self.net = net
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros((0, len(net.languages)), np.float32)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = hash_ranges(data, starts, ends)
        found, first, which = np.unique(h, return_index=True, return_inverse=True)
        out = np.empty((len(found), len(self.net.languages)), np.float32)
        at = np.searchsorted(self.keys, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == found[inside]
        out[known] = self.sums[at[known]]
        new = np.flatnonzero(~known)
        size = (ends - starts)[first]
        for n in np.unique(size[new]):
            rows = new[size[new] == n]
            for lo in range(0, len(rows), 8192):
                part = rows[lo : lo + 8192]
                codes = data[starts[first[part]][:, None] + np.arange(n)]
                out[part] = self.net.log_probabilities(codes).sum(0)
        if len(self.keys) + len(new) > CACHE_WORDS:
            self.keys, self.sums = found[-CACHE_WORDS:], out[-CACHE_WORDS:]
        else:
            keys = np.concatenate([self.keys, found[new]])
            order = keys.argsort()
            self.keys, self.sums = keys[order], np.concatenate([self.sums, out[new]])[order]
        return out[which]


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _pooled(labeller: _Labeller, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: pooled log-probabilities per position, positions pooled, and whether it has a letter."""
    k = len(labeller.net.languages)
    sums, size, has = np.zeros((len(column), k)), np.zeros(len(column)), np.zeros(len(column), bool)
    for s in slices(pc.utf8_lower(column.cast(pa.large_string())), SLICE):
        w = find_words(s)
        letters = np.concatenate([[0], np.cumsum(_LETTER[s.data])])
        some = letters[w.ends] > letters[w.starts]
        starts, ends, row = w.starts[some], w.ends[some], w.row[some]
        parts = np.maximum(1, -(-(ends - starts) // PIECE))
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + at * PIECE
        ends, row = np.minimum(starts + PIECE, np.repeat(ends, parts)), np.repeat(row, parts)
        if not len(starts):
            continue
        per_word = labeller(s.data, starts, ends)
        for j in range(k):
            sums[s.first : s.first + s.n, j] = np.bincount(row, per_word[:, j], s.n)
        size[s.first : s.first + s.n] = np.bincount(row, ends - starts, s.n)
    ascii_letter = pc.match_substring_regex(pc.fill_null(column, ""), "[A-Za-z]").to_numpy(zero_copy_only=False)
    has |= ascii_letter
    for i in np.flatnonzero(~ascii_letter & (size > 0)):
        has[i] = any(ch.isalpha() for ch in column[int(i)].as_py())
    return sums / np.maximum(size, 1)[:, None], size, has


def identify(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``lang_score`` of every whole text.

    A null text and a text without a letter give ``und`` and score 0; so does everything
    without a network. Of equal languages the first by name is taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = None if shared.value is None else _Labeller(shared.value)
        for batch in batches:
            names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if labeller is not None and batch.num_rows:
                mean, size, has = _pooled(labeller, batch.column(batch.num_columns - 1))
                z = mean * np.minimum(size, EVIDENCE)[:, None]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                names = [labeller.net.languages[b] if y else UNKNOWN for b, y in zip(best, has)]
                score = np.where(has, p[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "lang_score"],
            )

    kinds = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["lang_pred string", "lang_score double"])
    texts = docs.select(*keep, F.col("text").cast("string").alias("_read_text"))
    return small_partitions(texts).mapInArrow(run, kinds)
