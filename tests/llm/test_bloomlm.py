import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from siftlake.llm import bloomlm


def tokens(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w] + ["</s>"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check(rows, got):
    """Counts and base score against plain Python."""
    c = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    total, distinct = sum(c.values()), len(c)
    want = sorted(
        (r.doc_id is None, r.doc_id or 0, held(r.doc_id), len(tokens(r.text)), sum(w in c for w in tokens(r.text)), total,
         round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in tokens(r.text)), 4))
        for r in rows
    )
    assert want == sorted(
        (g.doc_id is None, g.doc_id or 0, g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 4)) for g in got
    )
    assert all(g.score <= 0 and math.isfinite(g.score) for g in got)


def sentences(n, seed=1):
    """Texts in which most words tell the next."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = [r.randrange(300)]
        for _ in range(60):
            w.append((w[-1] * 7 + 3) % 300 if r.random() < 0.8 else r.randrange(300))
        out.append(" ".join(f"W{x}" for x in w))
    return out


def test_base_and_model(table):
    df = table([(i, t, "en", "a") for i, t in enumerate(sentences(300))])
    got = bloomlm.score_table(df).collect()
    check(df.collect(), got)
    own = [g for g in got if g.held_out]
    assert sum(g.score for g in own) > 0.8 * sum(g.base_score for g in own)


def test_join_gives_the_same_as_the_broadcast(awkward):
    training = awkward.where("doc_id is null or doc_id % 2 = 1")
    a, b = (bloomlm.scores(awkward, training, max_words=n).drop("score") for n in (bloomlm.MAX_WORDS, 0))
    assert a.columns == [c for c in b.columns]
    rounded = [sorted(map(str, x.withColumn("base_score", F.round("base_score", 6)).drop("text").collect())) for x in (a, b)]
    assert rounded[0] == rounded[1]


def test_counts_come_back_from_the_filter():
    """Levels are found again; a pair never counted is seldom found."""
    r = np.random.default_rng(2)
    shape = bloomlm.Shape(1 << 18, 1)
    words = np.unique(r.integers(0, 2**63, 500).astype(np.uint64))
    pairs = r.integers(0, 2**63, 8000).astype(np.uint64)
    rest = np.unique(shape.split(pairs)[1])
    word_counts, pair_counts = r.geometric(0.02, len(words)), r.geometric(0.6, len(rest))
    bits = bloomlm.segment_bits(shape, words, word_counts, rest, pair_counts)
    model = bloomlm.Model(shape, bits, int(word_counts.sum()), len(words))
    exact = bloomlm.LEVEL_COUNTS[bloomlm.levels(word_counts)]
    found = model.counts(bloomlm._word_key(words))
    assert (found >= exact).all() and (found == exact).mean() > 0.9
    assert (model.counts(r.integers(0, 2**63, 5000).astype(np.uint64)) > 0).mean() < 0.05


def test_a_full_segment_leaves_out_rare_pairs_only():
    r = np.random.default_rng(3)
    shape = bloomlm.Shape(1 << 12, 1)
    rest = np.unique(r.integers(0, 2**40, 3000).astype(np.uint64))
    counts = np.where(np.arange(len(rest)) < 50, 100, 1)
    words = np.arange(1, 20, dtype=np.uint64)
    bits = bloomlm.segment_bits(shape, words, np.full(len(words), 3), rest, counts)
    assert np.unpackbits(bits).mean() < 0.6
    model = bloomlm.Model(shape, bits, 1, 1)
    assert (model.counts(rest[:50] << np.uint64(24)) >= 80).all() and (model.counts(bloomlm._word_key(words)) >= 3).all()


def test_awkward_rows(awkward, empty):
    got = bloomlm.score_table(awkward).collect()
    check(awkward.collect(), got)
    assert bloomlm.score_table(empty).collect() == []
    nothing = bloomlm.scores(awkward, empty).collect()
    assert len(nothing) == awkward.count() and all(g.n_known == 0 and g.base_score == 0 for g in nothing)


def test_no_pair_is_left_out():
    """The filter grows with what it must hold: every counted pair is found, and chance hits stay rare."""
    r = np.random.default_rng(4)
    shape = bloomlm.Shape(1 << 12, 1)
    rest = np.unique(r.integers(0, 2**40, 3000).astype(np.uint64))
    bits = bloomlm.segment_bits(shape, np.arange(1, 20, dtype=np.uint64), np.full(19, 3), rest, np.ones(len(rest), np.int64))
    model = bloomlm.Model(shape, bits, 1, 1)
    assert (model.counts(rest << np.uint64(24)) > 0).all()
    assert (model.counts(r.integers(0, 2**63, 5000).astype(np.uint64)) > 0).mean() < 0.2
    assert bloomlm.Shape.of(30 << 30).bits >= 30 << 30


def test_many_chunks_and_segments_give_the_same(awkward, monkeypatch):
    def rounded():
        found = bloomlm.scores(awkward, awkward.where("doc_id is null or doc_id % 2 = 1"))
        return sorted(str((g.doc_id, g.text, g.n_tokens, g.n_known, round(g.base_score, 6))) for g in found.collect())

    whole = rounded()
    monkeypatch.setattr(bloomlm, "CHUNK_TOKENS", 1)
    monkeypatch.setattr(bloomlm, "SEGMENT_BYTES", 1 << 14)
    assert rounded() == whole
