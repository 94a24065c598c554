import random

import numpy as np
import pyarrow as pa

from siftlake.llm import langid, textblocks as tb

SYLLABLES = {"aa": ["ba", "lo", "mi", "tu"], "bb": ["schr", "ung", "pf", "ei"], "cc": ["ция", "ого", "сто", "пре"]}


def text(language, seed, n=30):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[language], k=r.randint(1, 3))) for _ in range(n))


def test_held_out_texts(table):
    rows = [(i, text(lang, i), lang, "a") for i, lang in enumerate(list(SYLLABLES) * 40)]
    out = langid.language_table(table(rows)).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(rows) and 0 < len(held) < len(rows)
    assert all(r.lang_pred == rows[r.doc_id][2] and 0 <= r.score <= 1 for r in held)


def test_the_language_column_is_no_input(table):
    rows = [(i, text(lang, i), lang, "a") for i, lang in enumerate(list(SYLLABLES) * 10)]
    model = langid.fit(table(rows))
    plain = {r.doc_id: r.lang_pred for r in langid.predict(table(rows), model).collect()}
    other = table([(d, t, "zz", "b") for d, t, _, _ in rows])
    assert {r.doc_id: r.lang_pred for r in langid.predict(other, model).collect()} == plain


def test_awkward_rows(awkward):
    model = langid.fit(awkward)
    out = langid.predict(awkward, model)
    assert out.columns == [c for c in awkward.columns if c != "score"] + ["lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter) and 0 <= r.score <= 1
        assert has_letter or r.score == 0


def test_nothing_to_learn_from(awkward, empty):
    model = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(awkward, model).collect()} == {"und"}
    assert langid.language_table(empty).collect() == []


def test_vectors_by_definition(monkeypatch):
    """A text's vector is the sum over its letter triples of rotated and multiplied letter vectors."""
    d, seed = 64, 5
    r = random.Random(1)
    texts = ["ab cé", "", "zz!", "语言 语 \U00020000a", "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(300))]
    texts += [text(lang, i, 5) for i, lang in enumerate(list(SYLLABLES) * 20)]
    block = next(tb.blocks(pa.array(texts)))

    def vector(words):
        out = np.zeros(d)
        for w in words:
            own = langid.letter_vectors(np.array([32, *map(ord, w), 32]), d, seed)
            for a, b, c in zip(own, own[1:], own[2:]):
                out += np.roll(a, 2) * np.roll(b, 1) * c
        return out

    for chunk, rare in ((langid.CHUNK, langid.RARE), (7, 3), (5, 10**9), (5, 0)):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        monkeypatch.setattr(langid, "RARE", rare)
        got, letters = langid.text_vectors(block, d, seed)
        for t, found, n in zip(texts, got, letters):
            words = "".join(c if c.isalpha() else " " for c in t).split()
            assert np.array_equal(found, vector(words)) and n == sum(map(len, words))


def test_every_letter_has_a_vector_of_its_own():
    points = np.concatenate((np.arange(97, 123), np.arange(0x430, 0x450), np.arange(0x4E00, 0x9FA6)))
    vectors = langid.letter_vectors(points, langid.DIMENSIONS, 17)
    assert set(np.unique(vectors)) == {-1.0, 1.0} and len({v.tobytes() for v in vectors}) == len(points)
    some = vectors[:1000]
    unequal = (some @ some.T)[~np.eye(len(some), dtype=bool)] / langid.DIMENSIONS
    assert abs(unequal).max() < 0.35 and abs(unequal.std() * langid.DIMENSIONS**0.5 - 1) < 0.02


def test_languages_of_one_script_with_many_letters(table):
    """Two languages whose words hold other letters of one script."""
    r = random.Random(3)
    letters = [chr(p) for p in r.sample(range(0x4E00, 0x9FA6), 800)]
    own = {"xx": letters[:400], "yy": letters[400:]}
    words = {lang: ["".join(r.choices(some, k=r.randint(2, 4))) for _ in range(300)] for lang, some in own.items()}
    rows = [(i, "，".join(r.choices(words[lang], k=15)), lang, "a") for i, lang in enumerate(["xx", "yy"] * 200)]
    held = [o for o in langid.language_table(table(rows)).collect() if o.held_out]
    assert len(held) > 50 and all(o.lang_pred == rows[o.doc_id][2] for o in held)
