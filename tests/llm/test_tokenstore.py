import random
import zlib

import numpy as np
import pytest

from siftlake.llm import perfecthash, queries, tokenstore as ts
from siftlake.llm.frames import new_folder

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    for own in (keys, keys[:1], keys[:0], np.arange(3000)):
        table = perfecthash.PerfectHash.build(own)
        assert sorted(table.find(own).tolist()) == list(range(len(own)))
    with pytest.raises(ValueError):
        perfecthash.PerfectHash.build(np.array([1, 1]))


def test_pieces_give_the_ids_of_whole_texts(path):
    r = random.Random(5)
    pool = list("abzABZéÀß'' \n\t  .,!?-_123#|<> \x85\x1c²½ªπ世 ") + ["'s", "'re", " the", "<|endoftext|>", "\n\n", "  ", "n't"]
    texts = ["".join(r.choice(p) for _ in range(r.randint(0, 40))) for p in (pool, pool[:24] + ["'s"]) for _ in range(4000)]
    whole = tokenizers.Tokenizer.from_file(path)
    for text, ids in zip(texts, ts.Encoder(path).encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows, path):
    """Digests by encoding one text after the other, in id order."""
    whole = tokenizers.Tokenizer.from_file(path)
    out, start = [], 0
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_over_shards(spark, table, path):
    r = random.Random(2)
    rows = [(i * 7 - 300, " ".join(r.choice(["the", "cat", "é", "x1", "\n"]) for _ in range(r.randint(0, 60))), "en", "a") for i in range(200)]
    shuffled = r.sample(rows, len(rows))
    store = ts.write_store(table(shuffled), new_folder(spark, "test-store"), path, shard_bytes=2000)
    assert store.manifest().count() > 3
    got = sorted(map(tuple, ts.read_digests(store).collect()), key=lambda x: x[0])
    assert got == expected([(d, t) for d, t, *_ in rows], path)
    keys = spark.createDataFrame([(rows[5][0],), (rows[150][0],), (2,), (None,)], "doc_id long")
    found = {x.doc_id: x.ids for x in ts.lookup(store, keys).collect()}
    whole = tokenizers.Tokenizer.from_file(path)
    assert found == {rows[i][0]: whole.encode(rows[i][1], add_special_tokens=False).ids + [0] for i in (5, 150)}


def test_awkward_rows(spark, awkward, empty, path):
    store = ts.write_store(awkward, new_folder(spark, "test-store"), path, shard_bytes=100_000)
    got = ts.read_digests(store).collect()
    rows = awkward.collect()
    assert sorted((g.doc_id is None, g.doc_id or 0) for g in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    want = {}
    for r in rows:
        want.setdefault(r.doc_id, []).append(expected([(r.doc_id, r.text)], path)[0][2:])
    for doc_id, digests in want.items():
        assert sorted(digests) == sorted((g.n_tokens, g.ids_crc32) for g in got if g.doc_id == doc_id)
    spans = sorted((g.start, g.n_tokens, g.doc_id) for g in got)
    assert all(a[0] + a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0
    assert [s[2] for s in spans] == sorted([s[2] for s in spans], key=lambda d: (d is not None, d))
    assert len(ts.lookup(store, spark.createDataFrame([(3,)], "doc_id long")).collect()) == 2
    none = ts.write_store(empty, new_folder(spark, "test-store"), path)
    assert ts.read_digests(none).collect() == []


def test_a_small_memo_gives_the_same(path, monkeypatch):
    """Generations of remembered pieces change no id and stay small."""
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(3000)}" if r.random() < 0.5 else "the" for _ in range(30)) for _ in range(300)]
    want = ts.Encoder(path).encode(texts)
    monkeypatch.setattr(ts, "MEMO_PIECES", 100)
    encoder, got = ts.Encoder(path), []
    for i in range(0, len(texts), 5):
        got += encoder.encode(texts[i : i + 5])
        assert len(encoder.memo) + len(encoder.older) < 1000
    assert got == want


def test_a_foreign_key_is_not_found(monkeypatch):
    """Even if all fingerprints agree."""
    monkeypatch.setattr(ts, "fingerprint", lambda keys: np.zeros(len(keys), np.uint32))
    keys = np.repeat(np.arange(0, 2000, 2), 2)
    index = ts.Index(ts.pack_index(keys, 3, np.ones(len(keys) + 3, np.int64), 2))
    first, repeats = index.find(np.arange(2000))
    assert (repeats == np.where(np.arange(2000) % 2, 0, 2)).all() and (first[::2] == 3 + np.arange(0, 2000, 2)).all()
