import pytest

from siftlake.llm import surrogates as sg

KEY = b"test key"
TEXT = (
    'Mr. John Smith and Mrs. Anna Smith wrote to Bob.Lee@Mail3.example.com, +1 (644) 555-7859 or 10.1.2.3 and 45.196.222.209. '
    'Smith paid 4111 1111 1111 1111; token = "769b0074ad8f3a10fee0689c8d788a140298285a". JOHN left. Господин Иванов, Κυρία Παππά.'
)


def test_types_formats_and_coreference(table):
    row = sg.replaced(table([(1, TEXT, "en", "a")]), KEY).first()
    before, after = sg.find(TEXT), sg.find(row.text)
    assert [b[2] for b in before] == [a[2] for a in after]
    names = {}
    for b, a in zip(before, after):
        assert b[3] != a[3]
        old, new = TEXT[b[0] : b[1]], row.text[a[0] : a[1]]
        assert names.setdefault(b[3], a[3]) == a[3]
        assert old.isupper() == new.isupper()
        if b[2] in ("phone", "card"):
            assert [c for c in old if not c.isdigit()] == [c for c in new if not c.isdigit()] and len(old) == len(new)
        if b[2] == "card":
            digits = [int(c) for c in a[3]]
            assert sg._luhn(digits[:-1]) == digits[-1]
        if b[2] in ("surname", "given_m", "given_f"):
            assert sg._script(a[3]) == sg._script(b[3])
    assert row.entity_counts.surname == 5 and row.entity_counts.given_m == 2
    assert [a[3] for a in after if a[2] == "ip"][0].startswith("10.")


def test_permutations_are_one_to_one():
    for kind, values in {
        "phone": [f"+1{n}5550{i:03d}" for i in range(1000) for n in (2,)],
        "card": [f"4{i:014d}" + str(sg._luhn([4] + [int(c) for c in f"{i:014d}"])) for i in range(1000)],
        "ip": [f"{a}.{b}.7.9" for a in range(1, 100) for b in range(10)],
        "email": [f"ab{i}@x.example.com" for i in range(1000)],
        "secret": [f"{i:016x}" for i in range(1000)],
    }.items():
        assert len({sg.surrogate(KEY, kind, v) for v in values}) == len(values)
    assert sg.surrogate(KEY, "email", "a1@b.org") != sg.surrogate(b"other", "email", "a1@b.org")


def test_conflicts_are_resolved(table, monkeypatch):
    """With short names many surrogates collide at first; afterwards none does, and none is a real name."""
    names = ["Bawick", "Lowick"] + [f"S{chr(97 + i)}x" for i in range(10)]
    assigned, syllables = sg.assignment(table([(i, f"Mr. {n} spoke", "en", "a") for i, n in enumerate(names)]), KEY, syllables=1)
    rows = assigned.collect()
    assert len({r.surrogate for r in rows}) == len(names) == len({r.entity for r in rows})
    assert not {r.surrogate for r in rows} & {r.entity for r in rows} and {r.attempt for r in rows} != {0}
    monkeypatch.setattr(sg, "MAX_EXCEPTIONS", 0)
    rows, longer = sg.assignment(table([(i, f"Mr. {n} spoke", "en", "a") for i, n in enumerate(names)]), KEY, syllables=1)
    assert longer > syllables and {r.attempt for r in rows.collect()} == {0}


@pytest.mark.parametrize("text", ["", "no data", "1.2.3", "999.1.1.1", "version 1.2.3.4.5", "@ alone", "12 345", "Mr. x", "The secret: everything", "token: see-below", "secret=None"])
def test_nothing_to_replace(text):
    assert sg.find(text) == []


def test_awkward_rows(awkward, empty):
    out = sg.replaced(awkward, KEY)
    assert out.columns == awkward.columns + ["entity_counts"]
    assert sorted(map(str, out.drop("entity_counts").collect())) == sorted(map(str, awkward.collect()))
    assert sg.surrogate_table(empty).collect() == []


def test_same_entity_in_all_rows(table):
    rows = sg.replaced(table([(i, f"{i} write to x.y@z.org today", "en", "a") for i in range(50)]), KEY).collect()
    assert len({r.text.split(" ")[3] for r in rows}) == 1


def test_every_type_ends(table, monkeypatch):
    """Other scripts are permuted; what no attempt can settle gets unused values, and marks where a range is full."""
    assert sg.surrogate(KEY, "email", "почта@пример.com") != "почта@пример.com"
    monkeypatch.setattr(sg, "MAX_ATTEMPTS", 1)
    full = " ".join(f"10.0.{i >> 8}.{i & 255}" for i in range(40_000))
    docs = table([(1, f"почта@пример.com and _@-.com, {full}", "en", "a")])
    assigned = [r for r in sg.assignment(docs, KEY)[0].collect()]
    assert len(assigned) == 40_002 == len({(r.type, r.surrogate) for r in assigned})
    assert not {(r.type, r.surrogate) for r in assigned} & {(r.type, r.entity) for r in assigned}
    marks = [r for r in assigned if r.surrogate[0] == "["]
    assert [r.entity for r in marks if r.type == "email"] == ["_@-.com"] and len(marks) == 1 + 40_000 - (65_536 - 40_000)
    small = table([(1, "почта@пример.com and _@-.com", "en", "a"), (2, "nothing", "en", "a")])
    few = sorted(r.text for r in sg.replaced(small, KEY).collect())
    monkeypatch.setattr(sg, "MAX_EXCEPTIONS", 0)
    assert sorted(r.text for r in sg.replaced(small, KEY).collect()) == few and few[1].endswith(" and [email 1]")


@pytest.mark.parametrize("text, kind, values", [
    (f"token={'aB3' * 100} end", "secret", ["aB3" * 100]),
    ("token: eyJhbGciOi.eyJzdWIi.c2ln-_x end", "secret", ["eyJhbGciOi.eyJzdWIi.c2ln-_x"]),
    ("password=ab+cdEFGHIJKL, next", "secret", ["ab+cdEFGHIJKL"]),
    ('secret = "two words/and+more" end', "secret", ["two words/and+more"]),
    ("Mrs Smith-Jones left", "surname", ["Smith-Jones"]),
    ("Señor Juan Carlos García López vino", "surname", ["López"]),
    ("Señor Juan Carlos García López vino", "given_m", ["Juan", "Carlos", "García"]),
    ("Mr O'Brien said; Mr Smith's car", "surname", ["O'Brien", "Smith"]),
    ("Prof. Dr. Smith spoke", "surname", ["Smith"]),
    ("Dr. Mrs Anna Smith spoke", "given_f", ["Anna"]),
    ("password: hunter2.", "secret", ["hunter2"]),
    ("password=changeme", "secret", ["changeme"]),
    (f"to {'a' * 65}@example.com now", "email", [f"{'a' * 65}@example.com"]),
    ("to почта@пример.рф now", "email", ["почта@пример.рф"]),
    ("call +14155552671 now", "phone", ["+14155552671"]),
    ("call 01 23 45 67 89 now", "phone", ["01 23 45 67 89"]),
    ("call +33 1 23 45 67 89 now", "phone", ["+33 1 23 45 67 89"]),
])
def test_entities_are_whole(text, kind, values):
    assert [text[b:e] for b, e, k, _ in sg.find(text) if k == kind] == values


def test_capitals_follow(table):
    text = sg.replaced(table([(1, "John.Smith@Ex.com or john.smith@ex.com", "en", "a")]), KEY).first().text
    first, _, second = text.split(" ")
    assert [c.isupper() for c in first] == [c.isupper() for c in "John.Smith@Ex.com"] and first.lower() == second
