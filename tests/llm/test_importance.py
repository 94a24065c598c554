import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from conftest_helpers import prose

from siftlake.llm import importance

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
    runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % importance.BUCKETS for r in runs]


def brute(rows, targets, max_n, percent=10):
    found = [features(r[1], max_n) for r in rows]
    s, t = Counter(), Counter()
    for _, buckets in found:
        s.update(buckets)
    for text in targets:
        t.update(features(text, max_n)[1])
    total, goal, size = sum(s.values()), sum(t.values()), importance.BUCKETS
    out = []
    for row, (n, buckets) in zip(rows, found):
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total + size) / ((s[b] + 1) * (goal + size)))) for b in buckets]
        weight = sum(gains) // len(gains) if gains else 0
        key = "2024:" + ("" if row[0] is None else str(row[0]))
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([row[0], n, len(buckets), weight, score, None])
    enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[: percent * len(enough) // 100], 1):
        r[5] = place
    return Counter(map(tuple, out))


TARGETS = [prose(5, 200), None, "", "Wa w1 w2 éÉ"]
ROWS = [(i, prose(i % 50, 15 + i % 40) + (" ÉéÀ W1,w2!" if i % 3 else ""), "en", "a") for i in range(300)]


def drawn(spark, df, max_n, percent=10, **options):
    target = spark.createDataFrame([(t,) for t in TARGETS], "text string")
    out = importance.resample(df, target, ["doc_id"], max_n=max_n, percent=percent, **options)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("max_n", [1, 2, 3])
@pytest.mark.parametrize("head", [3, importance.HEAD])
def test_equals_brute_force(spark, table, max_n, head):
    assert drawn(spark, table(ROWS).repartition(6), max_n, head=head, percent=40) == brute(ROWS, TARGETS, max_n, 40)


def test_head_holds_every_frequent_word(spark, table):
    rows = [(i, f"the of u{i}a u{i}b u{i}c " + "z" * 100, "en", "a") for i in range(200)]
    head = importance.find_head(table(rows).repartition(4), max_n=2, head=20, fold_rows=10)
    assert {b"the", b"of"} <= set(head.states) and len(head.states) <= 20 and len(head.pairs) <= 20
    assert (b"the", b"of") in head.pairs and max(map(len, head.states)) <= importance.HEAD_BYTES
    assert all(head.pairs[p] == zlib.crc32(b" ".join(p)) % importance.BUCKETS for p in head.pairs)


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in awkward.collect()]
    assert drawn(spark, awkward, 1, 60) == brute(rows, TARGETS, 1, 60)
    assert drawn(spark, empty, 1) == Counter()
    # All columns stay, clashing names are kept apart.
    target = spark.createDataFrame([], "text string")
    out = importance.resample(awkward, target)
    assert out.columns[: len(awkward.columns)] == awkward.columns and {"_score", "rank", "weight"} <= set(out.columns)
    assert out.count() == awkward.count()
    assert Counter((r.doc_id, r.text, r.size) for r in out.collect()) == Counter((r.doc_id, r.text, r.size) for r in awkward.collect())


def test_ties_spread_over_partitions(spark, table):
    rows = [(1, prose(1, 30), "en", "a")] * 50
    ranks = [r.rank for r in importance.resample(table(rows), spark.createDataFrame([("a",)], "text string"), percent=50).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 26)) and ranks.count(None) == 25
