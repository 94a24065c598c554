"""The pipeline against a version that treats one document after the other."""

import random

import pytest

import corpus_pipeline as cp
from siftlake.llm import mixing, queries
from conftest_helpers import prose
from test_nearcopies import brute
from test_tokenstore import expected


@pytest.fixture(scope="module")
def folder(spark, table, tmp_path_factory):
    r = random.Random(8)
    items = [(i, f"{prose(900 + i, 14, 4)}. {prose(950 + i, 8, 4)}.") for i in range(6)]
    rows = [(i, prose(i, r.choice([8, 40, 90])), "en" if i % 4 else "de", f"s{i % 5}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "s1") for i in range(0, 60, 6) if len(rows[i][1].split()) > 30]
    rows += [(200 + i, rows[i][1], "en", "s2") for i in range(5)] + [(300 + i, prose(700 + i, 50) + " " + items[i][1], "en", "s3") for i in range(4)]
    rows += [(400, "!!! 123", "en", "s0"), (401, None, "en", "s0"), (402, "", None, None)]
    root = tmp_path_factory.mktemp("tables")
    table(r.sample(rows, len(rows))).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows, items


def test_stages_and_run(spark, folder):
    root, rows, items = folder
    docs = queries.read(spark, root, "documents")
    left = {r[0]: r for r in rows}
    for (name, stage), gone in zip(cp.STAGES[:3], (
        lambda: {d for d, r in left.items() if not any(c.isalpha() for c in r[1] or "")},
        lambda: {d for d, root_ in brute(list(left.values())).items() if d != root_},
        lambda: {d for d, r in left.items() if any(t in r[1] for _, t in items)},
    )):
        expect = gone()
        assert expect, name
        columns = docs.columns
        docs = stage(spark, docs, root)
        assert docs.columns == columns
        for d in expect:
            del left[d]
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(left), name
    taken = {r.doc_id: r.copies for r in mixing.copies(docs).collect()}
    repeated = [(d, left[d][1]) for d in sorted(left) for _ in range(taken[d])]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in cp.run(spark, root).collect())
    assert got == sorted(expected(repeated, queries.tokenizer_path()))


def test_empty_tables(spark, table, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_awkward_rows(spark, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, None), (None, "one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = awkward
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == awkward.columns
    ids = [r.doc_id for r in docs.collect()]
    assert set(ids) <= {3, 7, 8, 9, None} and 3 in ids
    assert cp.run(spark, str(tmp_path)).count() == len(ids)


def test_letters_of_no_language_go(spark, table):
    """Random letters are rejected from a few dozen letters on; texts of the learned languages stay."""
    from test_langid import SYLLABLES, text

    r = random.Random(4)
    learned = [(i, text(lang, i, 60), lang, "a") for i, lang in enumerate(list(SYLLABLES) * 100)]
    scripts = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "".join(chr(0x4E00 + i) for i in range(2000)))
    noise = [(1000 + i, "".join(r.choice(scripts[i % 3] + "   ") for _ in range(400)), None, "b") for i in range(150)]
    short = [(2000 + i, text("aa", i, 2), "aa", "a") for i in range(20)]
    kept = {x.doc_id for x in cp.language_id(spark, table(learned + noise + short), "").collect()}
    assert {d for d, *_ in learned + short} <= kept
    assert len(kept & {d for d, *_ in noise}) <= 5
