import math
import random
import re

import numpy as np

from siftlake.llm import nearcopies, textblocks as tb
from conftest_helpers import prose


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> component by comparing every pair."""
    ids = sorted({d for d, *_ in rows if d is not None})
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in ids}


def check(df, rows):
    got = nearcopies.near_copies(df).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    sizes = sorted((r[0] is None, r[0] or 0, len(shingles(r[1]))) for r in rows)
    assert sorted((g.doc_id is None, g.doc_id or 0, g.n_shingles) for g in got) == sizes
    for g in got:
        assert g.component_id == want.get(g.doc_id)
        assert g.kept == (g.doc_id is None or g.doc_id == g.component_id)


def edited(text, r, share):
    w = text.split(" ")
    for i in r.sample(range(len(w)), int(share * len(w))):
        w[i] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def test_against_all_pairs(table):
    r = random.Random(4)
    rows = []
    for group in range(25):
        base = prose(group, r.choice([3, 4, 5, 6, 30, 120, 400]))
        for _ in range(r.choice([1, 2, 6])):
            rows.append((len(rows), r.choice([base, base.upper(), edited(base, r, r.choice([0.01, 0.03, 0.05, 0.06]))]), "en", "a"))
    r.shuffle(rows)
    check(table(rows), rows)


def test_large_groups_and_shared_passages(table, monkeypatch):
    """A bucket larger than a block, chains of near-copies, and a passage that many documents share."""
    monkeypatch.setattr(nearcopies, "BLOCK_MEMBERS", 8)
    r = random.Random(5)
    base, passage = prose(100, 150), prose(101, 60)
    rows = [(i, base, "en", "a") for i in range(40)]
    rows += [(100 + i, edited(base, r, 0.02 * (i % 4)), "en", "a") for i in range(60)]
    rows += [(200 + i, prose(300 + i, 60) + " " + passage, "en", "a") for i in range(40)]
    chain = prose(500, 200).split(" ")
    rows += [(400 - i, " ".join(chain[4 * i : 100 + 4 * i]), "en", "a") for i in range(20)]
    check(table(rows), rows)


def test_awkward_rows(awkward):
    check(awkward, [tuple(r) for r in awkward.collect()])


def test_empty_table(empty):
    assert nearcopies.near_copies(empty).collect() == []
    assert nearcopies.deduplicated(empty).collect() == []


def test_one_of_each_group_stays(awkward):
    kept = nearcopies.deduplicated(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 4, 6, 7, 7, 9, 10]
    assert sum(r.doc_id is None for r in rows) == 2 and all(r.score == "own" for r in rows)


def test_signature_estimates_similarity():
    """Agreement of registers is an unbiased estimate, closer than independent minima would be."""
    random_ = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        a = tb.mix(random_.integers(0, 1 << 60, 150).astype(np.uint64))
        b = np.concatenate((a[:120], tb.mix(random_.integers(0, 1 << 60, 30).astype(np.uint64))))
        sa, sb = (nearcopies.superminhash(np.unique(x), np.array([0, len(x)]))[0] for x in (a, b))
        errors.append((sa == sb).mean() - 120 / 180)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < np.sqrt(2 / 3 * 1 / 3 / nearcopies.REGISTERS)


def test_components_of_long_chains(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000 + i, 2000 + i % 3) for i in range(50)]
    random.Random(2).shuffle(edges)
    got = dict(nearcopies.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(n + 1))
    assert all(got[1000 + i] == 1000 + i % 3 for i in range(50))


def test_signature_cut_loses_less_than_the_banding():
    """Independent registers at exactly 0.75: below the cut far more rarely than without a shared band."""
    below = math.ceil(nearcopies.PRUNE * nearcopies.REGISTERS)
    cut = sum(math.comb(nearcopies.REGISTERS, i) * 0.75**i * 0.25 ** (nearcopies.REGISTERS - i) for i in range(below))
    assert cut < (1 - 0.75 ** (nearcopies.REGISTERS // nearcopies.BANDS)) ** nearcopies.BANDS / 5
