import re
from collections import Counter, defaultdict

import pytest
from conftest_helpers import prose

from siftlake.llm import divergence

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    groups, counts, docs = defaultdict(set), defaultdict(Counter), defaultdict(set)
    for i, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""):
            t = t.translate(A_Z)
            counts[lang, source][t] += 1
            docs[lang, t].add(i)
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), d in docs.items() if g == lang and len(d) >= min_docs]

        def p(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = p(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, own[s][t] - q[t]) for t in kept if counts[lang, s][t] and own[s][t] > q[t]]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def audited(df, min_docs, top, **options):
    out = divergence.divergences(divergence.collect_stripes(df, min_docs, **options), top)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


ROWS = [(i, prose(i % 37, 60, words=6) + " Éa éa ÉA B b", ("en", "de", None)[i % 3], "s%d" % (i % 7 if i % 2 else 0)) for i in range(240)]


@pytest.mark.parametrize("spill", [1, 300, divergence.SPILL_ROWS])
def test_equals_brute_force(spark, table, spill):
    got = audited(table(ROWS).repartition(5), 3, 4, spill_rows=spill)
    assert got == brute(ROWS, 3, 4) and {r[2] for r in got} == {"pair", "term"}


def test_tiles_blocks_and_chunks(table):
    audit = divergence.collect_stripes(table(ROWS).repartition(3), 3, spill_rows=50, merge_rows=5)
    out = divergence.divergences(audit, 4, width=2, block_terms=3)
    assert sorted(tuple(r) for r in out.collect()) == brute(ROWS, 3, 4)


def test_awkward_rows(awkward, empty):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in awkward.collect()]
    assert audited(awkward, 2, 50) == brute(rows, 2, 50)
    assert {r[2] for r in audited(awkward, 1000, 50)} == {"pair"}
    assert audited(empty, 1, 50) == []


def test_shares_are_exact():
    import numpy as np

    for count, total, terms in [(0, 0, 1), (7, 7, 1), (10**13 + 3, 10**15 + 1, 10**6), (9 * 10**14, 10**15, 3), (1, 3, 7)]:
        want = 1 + 10**9 * (count + 5) // (total + 5 * terms)
        assert divergence.shares(np.array([count]), np.array(total), terms).tolist() == [want]
