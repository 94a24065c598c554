import math
import re
from collections import Counter

import pytest

from siftlake.llm import decontaminate as dc
from conftest_helpers import prose


def terms(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def brute(items, passage):
    """BM25 of a passage's distinct words for every item, divided by the item's own best."""
    lists = {i: terms(t) for i, t in items}
    n, mean = len(lists), sum(map(len, lists.values())) / len(lists)
    df = Counter(w for x in lists.values() for w in set(x))
    out = {}
    for i, x in lists.items():
        def weight(w):
            tf = x.count(w)
            return math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
        out[i] = sum(weight(w) for w in set(x) & set(passage)) / sum(weight(w) for w in set(x))
    return out


@pytest.fixture(scope="module")
def items():
    return [(i, f"{prose(i, 12, 4)}. {prose(1000 + i, 9, 4)}. {prose(2000 + i, 6, 4)}.") for i in range(30)]


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_scores_equal_exhaustive_scoring(spark, items):
    index, = dc.indexes_of(frame(spark, items))
    texts = [items[3][1] + " " + prose(7, 40, 4), prose(8, 90, 4), items[4][1][:60] + items[5][1][40:], ""]
    for t in texts:
        own = dc._term_lists([t])[0]
        begins, ends = (__import__("numpy").array([x]) for x in (0, len(own)))
        got = {index.item_ids[i]: s for _, i, s in dc.search(index, own, begins, ends, 0.3)}
        want = {i: s for i, s in brute(items, terms(t)).items() if s >= 0.3 - 1e-9}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_planted_items(spark, table, items):
    filler = [prose(100 + i, 300, 4) for i in range(12)]
    rows = [(i, f, "en", "a") for i, f in enumerate(filler)]
    for at in range(8):  # at every place in a text, also across passages
        cut = filler[at].split(" ")
        rows.append((100 + at, " ".join(cut[: 37 * at] + [items[at][1]] + cut[37 * at :]), "en", "a"))
    rows.append((200, items[20][1].upper().replace(" ", "!! "), "en", "a"))
    rows.append((201, items[21][1].split(". ")[0], "en", "a"))  # the question without its answer
    got = {(r.doc_id, r.item_id) for r in dc.leak_table(table(rows), frame(spark, items)).collect()}
    assert got == {(100 + at, at) for at in range(8)} | {(200, 20)}


def test_slices_find_the_same(spark, table, items, monkeypatch):
    rows = [(i, prose(i + 50, 100, 4) + " " + items[i][1], "en", "a") for i in range(10)]
    whole = sorted(map(tuple, dc.leak_table(table(rows), frame(spark, items)).collect()))
    monkeypatch.setattr(dc, "SLICE_ITEMS", 20)
    assert len(dc.indexes_of(frame(spark, items))) > 1
    sliced = sorted(map(tuple, dc.leak_table(table(rows), frame(spark, items)).collect()))
    assert [r[:2] for r in whole] == [r[:2] for r in sliced]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(whole, sliced))


def test_awkward_rows(spark, awkward, empty, items):
    index = dc.indexes_of(frame(spark, [*items, (None, items[0][1]), (90, ""), (91, None), (92, "one two"), (92, "one two")]))
    out = dc.leaks(awkward, index)
    assert out.columns == awkward.columns + ["leaks"] and out.count() == awkward.count()
    assert dc.leaks(empty, index).collect() == []
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in out.collect() if r.leaks}
    assert got == {4: [92], 5: [92]}
    every = [(None, items[0][1]), (92, "one two"), (92, "one two"), (93, "one two"), (None, "one two")]
    rows = [(r.doc_id, r.item_id) for r in dc.leak_table(awkward, frame(spark, every)).collect()]
    assert sorted(rows, key=str) == sorted([(d, i) for d in (4, 5) for i in (92, 92, 93, None)], key=str)
    assert dc.indexes_of(frame(spark, [(1, None)]).where("item_id < 0")) == []
    assert dc.leaks(awkward, []).where("size(leaks) > 0").count() == 0


def test_results_do_not_depend_on_other_items(spark, table, items):
    """Alone, beside a very long item, and repeated more often than a slice has room for."""
    rows = [(i, prose(60 + i, 150, 4) + " " + items[i][1] + " " + prose(90 + i, 150, 4), "en", "a") for i in range(3)]
    rows.append((9, "start " + prose(500, 1000, 4) + " end", "en", "a"))
    own = items[:2]

    def found(more):
        out = dc.leak_table(table(rows), frame(spark, own + more)).where("item_id < 100").collect()
        return sorted((r.doc_id, r.item_id, r.question_overlap, r.answer_overlap) for r in out)

    alone = found([])
    assert [r[:2] for r in alone] == [(0, 0), (1, 1)]
    long = [(500, prose(500, 1000, 4))]
    assert found(long) == alone
    assert [dc.passage_length(n) for n in (0, 1, 64, 65, 128, 129)] == [128, 128, 128, 256, 256, 512]
    assert {r.item_id for r in dc.leak_table(table(rows), frame(spark, own + long)).collect()} == {0, 1, 500}
    repeated = frame(spark, own).union(spark.range(25_000).selectExpr("id + 1000", "'Same thing? Same answer'"))
    built = dc.items_of(repeated)
    assert sum(len(i.item_ids) for i in built.indexes) == 3 and built.ids.count() == 25_002
    out = dc.leak_table(table([*rows, (10, "same thing same answer", "en", "a")]), repeated)
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {0: 1, 1: 1, 10: 25_000}


def test_slices_are_bounded_by_bytes(spark, table, items, monkeypatch):
    rows = [(i, items[i][1], "en", "a") for i in range(10)]
    whole = sorted((r.doc_id, r.item_id) for r in dc.leak_table(table(rows), frame(spark, items)).collect())
    monkeypatch.setattr(dc, "SLICE_BYTES", 300)
    assert len(dc.indexes_of(frame(spark, items))) >= 10
    assert sorted((r.doc_id, r.item_id) for r in dc.leak_table(table(rows), frame(spark, items[:12])).collect()) == whole
