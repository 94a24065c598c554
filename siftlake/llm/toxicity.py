"""Toxicity with a bidirectional gated recurrent network and attention over words.

*Inputs.* A word (letters and digits, case-folded) enters as word and as characters: the log-odds of its
hash bucket and a learned vector of it, and the highest and mean log-odds of its framed 4-byte
sequences and the mean of their learned vectors.

*Network.* Windows of ``WINDOW`` words, each beginning half a window after the last, run through one
gated recurrent unit from each side; attention weighs the positions, and a logistic unit scores the
pooled state. The text's score is its highest window's: all windows of the whole text are scored.

*Training*, in numpy on the driver, on a bounded sample: at most ``MAX_TOXIC`` and ``MAX_CLEAN``
labelled documents of at most ``MAX_CHARS`` characters, the first by a hash of doc_id, and of each the
``TRAIN_WINDOWS`` windows with the highest log-odds. The gradient goes through each document's highest
window. Nothing but text and the toxic label of the given rows is learned from.

Defined results: NULL and empty text have no word and get the score of one empty window. Without a
labelled document of both classes every score is 0. A document labelled twice counts as toxic if one
label says so; NULL labels are ignored. Repeated rows are scored alike.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .frames import append_columns, prepare, remainder

WINDOW = 32
HIDDEN = 8
VECTOR = 4
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 15
LEARNED_BUCKETS = 1 << 12
MAX_TOXIC, MAX_CLEAN = 2000, 4000
MAX_CHARS = 100_000
TRAIN_WINDOWS = 24
EPOCHS = 5
BATCH = 64
THRESHOLD = 0.3
_INPUT = 3 + 2 * VECTOR


@dataclass
class Vocabulary:
    """The distinct words of a block: word bucket, and buckets of the character sequences of each."""

    words: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def _distinct(block: tb.Block, found: tb.Words) -> tuple[np.ndarray, Vocabulary]:
    """Place of each word among the block's distinct words, and those."""
    hashes = tb.span_hashes(block.data, found.starts, found.ends)
    words, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    starts, sizes = found.starts[first], (found.ends - found.starts)[first]
    framed = sizes + 2
    bounds = np.concatenate(([0], np.cumsum(framed)))
    letters = np.zeros(bounds[-1], dtype=np.uint32)
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters[np.repeat(bounds[:-1] + 1, sizes) + inner] = block.data[np.repeat(starts, sizes) + inner]
    letters[bounds[:-1]], letters[bounds[1:] - 1] = 2, 3
    letters = np.concatenate((letters, np.zeros(3, np.uint32)))
    n = np.maximum(framed - 3, 1)  # a one-letter word is a single short sequence
    gram_bounds = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(bounds[:-1] - gram_bounds[:-1], n) + np.arange(gram_bounds[-1])
    grams = letters[at] | letters[at + 1] << 8 | letters[at + 2] << 16 | letters[at + 3] << 24
    short = np.flatnonzero(framed < 4)
    grams[gram_bounds[short]] &= 0xFFFFFF
    return place, Vocabulary(words, tb.mix(grams.astype(np.uint64)), gram_bounds)


def _windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and text of the windows of a block; a text without words has one empty window."""
    step = WINDOW // 2
    counts = np.maximum(-(-(np.diff(bounds) - WINDOW) // step), 0) + 1
    text = np.repeat(np.arange(len(counts)), counts)
    begins = bounds[text] + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    return begins, np.minimum(bounds[text + 1] - begins, WINDOW), text


def _places(place: np.ndarray, begins: np.ndarray, lengths: np.ndarray, blank: int) -> np.ndarray:
    """Words of each window (windows x WINDOW); ``blank`` after its end."""
    at = begins[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < lengths[:, None]
    padded = np.append(place, blank)
    return np.where(inside, padded[np.minimum(at, len(place))], blank)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name, and the log-odds of word and character buckets."""

    weights: dict
    word_odds: np.ndarray
    char_odds: np.ndarray

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Input vector of each distinct word, and a row of zeros for the blank."""
        w = self.weights
        n = np.maximum(np.diff(v.bounds), 1)[:, None]
        odds = self.char_odds[(v.grams % np.uint64(CHAR_BUCKETS)).astype(np.int64)]
        x = np.zeros((len(v.words) + 1, _INPUT), dtype=np.float32)
        if len(v.words):
            x[:-1, 0] = self.word_odds[(v.words % np.uint64(WORD_BUCKETS)).astype(np.int64)]
            x[:-1, 1] = np.maximum.reduceat(odds, v.bounds[:-1])
            x[:-1, 2] = np.add.reduceat(odds, v.bounds[:-1]) / n[:, 0]
            x[:-1, 3 : 3 + VECTOR] = w["words"][learned(v.words)]
            x[:-1, 3 + VECTOR :] = np.add.reduceat(w["chars"][learned(v.grams)], v.bounds[:-1], axis=0) / n
        return x

    def forward(self, x: np.ndarray, places: np.ndarray, keep: bool = False):
        """Logit of each window, and what the backward pass needs if asked for."""
        w = self.weights
        count = len(places)
        inside = places < len(x) - 1
        states = np.zeros((WINDOW, count, 2 * HIDDEN), dtype=x.dtype)
        memory = []
        for side, steps in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            gates = x @ w["in_" + side] + w["bias_" + side]
            h = np.zeros((count, HIDDEN), dtype=x.dtype)
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in steps:
                g = gates[places[:, t]]
                u = h @ w["state_" + side]
                rz = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                n = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                new = np.where(inside[:, t, None], n + z * (h - n), h)
                if keep:
                    memory.append((side, t, h, r, z, n, u[:, 2 * HIDDEN :]))
                h = new
                states[t, :, half] = h
        hidden = np.tanh(states @ w["attention"])
        energy = np.where(inside.T, hidden @ w["query"], -1e9)
        share = np.exp(energy - energy.max(axis=0))
        share = share * inside.T
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", share, states)
        logit = pooled @ w["out"] + w["out_bias"]
        return (logit, (states, hidden, share, pooled, memory, inside)) if keep else logit

    def backward(self, x: np.ndarray, places: np.ndarray, kept, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of the input vectors."""
        w = self.weights
        states, hidden, share, pooled, memory, inside = kept
        grad = {k: np.zeros_like(v) for k, v in w.items() if k not in ("words", "chars")}
        grad["out"], grad["out_bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * w["out"]
        d_states = share[:, :, None] * d_pooled
        d_share = np.einsum("bh,tbh->tb", d_pooled, states)
        d_energy = share * (d_share - (share * d_share).sum(axis=0))
        grad["query"] = np.einsum("tb,tba->a", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * w["query"] * (1 - hidden**2)
        grad["attention"] = np.einsum("tbh,tba->ha", states, d_hidden)
        d_states = d_states + d_hidden @ w["attention"].T
        d_x = np.zeros_like(x)
        for side in "fb":
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
            carried = np.zeros((len(places), HIDDEN), dtype=x.dtype)
            d_gates = np.zeros((len(x), 3 * HIDDEN), dtype=x.dtype)
            for _, t, h, r, z, n, un in reversed([m for m in memory if m[0] == side]):
                d = carried + d_states[t, :, half]
                live = inside[:, t, None]
                dn = np.where(live, d * (1 - z), 0) * (1 - n**2)
                dz = np.where(live, d * (h - n), 0) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                d_in = np.concatenate((dr, dz, dn), axis=1)
                d_u = np.concatenate((dr, dz, dn * r), axis=1)
                np.add.at(d_gates, places[:, t], d_in)
                grad["state_" + side] += h.T @ d_u
                carried = np.where(live, d * z, d) + d_u @ w["state_" + side].T
            grad["bias_" + side] = d_gates.sum(axis=0)
            grad["in_" + side] = x.T @ d_gates
            d_x += d_gates @ w["in_" + side].T
        return grad, d_x


def learned(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(LEARNED_BUCKETS)).astype(np.int64)


def _odds(texts: list[Vocabulary], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled log-odds of each word and character bucket, by documents that have it."""
    out = []
    for buckets, of in ((WORD_BUCKETS, lambda v: v.words), (CHAR_BUCKETS, lambda v: v.grams)):
        seen = np.zeros((2, buckets))
        for v, label in zip(texts, labels):
            seen[int(label), np.unique((of(v) % np.uint64(buckets)).astype(np.int64))] += 1
        total = np.bincount(labels.astype(int), minlength=2)
        rate = (seen + 0.5) / (total[:, None] + 1)
        odds = np.log(rate[1] / rate[0])
        # A bucket few documents have says little.
        out.append((odds * seen.sum(axis=0) / (seen.sum(axis=0) + 5) / 4).astype(np.float32))
    return out[0], out[1]


def train(texts: list, labels: np.ndarray, seed: int = 3, epochs: int = EPOCHS) -> Network:
    """Fit the network on whole texts and their 0/1 labels."""
    parts = []
    for block, found in tb.terms(pa.array(texts, pa.string())):
        for i in range(len(block)):
            a, b = found.bounds[i], found.bounds[i + 1]
            own = tb.Words(found.starts[a:b], found.ends[a:b], np.array([0, b - a]))
            parts.append(_distinct(block, own))
    labels = np.asarray(labels, dtype=np.float32)
    word_odds, char_odds = _odds([v for _, v in parts], labels)
    random = np.random.default_rng(seed)

    def normal(*shape, scale=0.3):
        return (random.standard_normal(shape) * scale).astype(np.float32)

    weights = {"words": normal(LEARNED_BUCKETS, VECTOR, scale=0.05), "chars": normal(LEARNED_BUCKETS, VECTOR, scale=0.05)}
    for side in "fb":
        weights["in_" + side] = normal(_INPUT, 3 * HIDDEN)
        weights["state_" + side] = normal(HIDDEN, 3 * HIDDEN)
        weights["bias_" + side] = np.zeros(3 * HIDDEN, np.float32)
    weights |= {
        "attention": normal(2 * HIDDEN, HIDDEN), "query": normal(HIDDEN), "out": normal(2 * HIDDEN),
        "out_bias": np.array([-1.0], np.float32),
    }
    net = Network(weights, word_odds, char_odds)
    documents = []
    for place, v in parts:
        begins, lengths, _ = _windows(np.array([0, len(place)]))
        places = _places(place, begins, lengths, len(v.words))
        prior = np.append(net.inputs(v)[:-1, :2].max(axis=1) if len(v.words) else [], 0)
        best = np.argsort(-np.sort(prior[places], axis=1)[:, -4:].sum(axis=1), kind="stable")[:TRAIN_WINDOWS]
        documents.append((v, places[best]))
    mean = {k: np.zeros_like(x) for k, x in weights.items()}
    square = {k: np.zeros_like(x) for k, x in weights.items()}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(documents))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            sizes = [len(documents[i][0].words) for i in chosen]
            shift = np.concatenate(([0], np.cumsum(sizes)))
            gram_shift = np.concatenate(([0], np.cumsum([len(documents[i][0].grams) for i in chosen])))
            v = Vocabulary(
                np.concatenate([documents[i][0].words for i in chosen]),
                np.concatenate([documents[i][0].grams for i in chosen]),
                np.concatenate([documents[i][0].bounds[:-1] + g for i, g in zip(chosen, gram_shift)] + [gram_shift[-1:]]),
            )
            blank = len(v.words)
            places = [np.where(documents[i][1] == n, blank, documents[i][1] + s) for i, n, s in zip(chosen, sizes, shift)]
            owner = np.repeat(np.arange(len(chosen)), [len(p) for p in places])
            places = np.concatenate(places)
            x = net.inputs(v)
            logit = net.forward(x, places)
            by = np.lexsort((logit, owner))
            top = by[np.append(owner[by][1:] != owner[by][:-1], True)]
            logit, kept = net.forward(x, places[top], keep=True)
            d_logit = (_sigmoid(logit) - labels[chosen]).astype(np.float32) / len(chosen)
            grad, d_x = net.backward(x, places[top], kept, d_logit)
            grad["words"], grad["chars"] = np.zeros_like(weights["words"]), np.zeros_like(weights["chars"])
            if len(v.words):
                np.add.at(grad["words"], learned(v.words), d_x[:-1, 3 : 3 + VECTOR])
                n = np.diff(v.bounds)
                np.add.at(grad["chars"], learned(v.grams), np.repeat(d_x[:-1, 3 + VECTOR :] / n[:, None], n, axis=0))
            step += 1
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] -= rate * mean[k] / (np.sqrt(square[k]) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Train on the bounded sample of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks; None without both classes."""
    order = F.xxhash64("doc_id")
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_doc_id"))
    marked = marked.agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    chosen = [
        marked.where(F.col("_toxic") == label).orderBy(F.xxhash64("_doc_id"), "_doc_id").limit(most).collect()
        for label, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))
    ]
    if not all(chosen):
        return None
    marked = docs.sparkSession.createDataFrame(chosen[0] + chosen[1], "_doc_id long, _toxic int")
    sample = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= MAX_CHARS)
    sample = sample.join(F.broadcast(marked), F.col("doc_id").cast("long") == F.col("_doc_id"))
    rows = sample.orderBy(order, "doc_id", "text").limit(MAX_TOXIC + MAX_CLEAN).select("text", "_toxic").collect()
    labels = np.array([r["_toxic"] for r in rows])
    if len(set(labels.tolist())) < 2:
        return None
    return train([r["text"] for r in rows], labels)


def scored(docs: DataFrame, network: Network | None, text: str = "text", score: str = "score") -> DataFrame:
    """Every row with its score, 0 to 1."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        net = sent.value

        def compute(batch):
            out = np.zeros(batch.num_rows)
            if net is not None:
                for block, found in tb.terms(batch.column(text)):
                    place, v = _distinct(block, found)
                    begins, lengths, owner = _windows(found.bounds)
                    x = net.inputs(v)
                    logit = np.concatenate([
                        net.forward(x, _places(place, begins[i : i + 4096], lengths[i : i + 4096], len(v.words)))
                        for i in range(0, len(begins), 4096)
                    ])
                    first = np.searchsorted(owner, np.arange(len(block)))
                    out[block.first : block.first + len(block)] = _sigmoid(np.maximum.reduceat(logit, first))
            return (pa.array(out),)

        return compute

    return append_columns(docs, f"{score} double", make)


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from those not held out."""
    held_out = remainder("doc_id", 4) == 2
    network = fit(docs.where(~held_out).select("doc_id", "text"), labels.where(~held_out))
    found = scored(docs.select("doc_id", held_out.alias("held_out"), "text"), network)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
