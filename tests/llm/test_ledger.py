import re

from siftlake.llm import ledger
from conftest_helpers import prose


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_upper": len(re.findall("[A-ZÀ-ÖØ-Þ]", text)), "n_lower": len(re.findall("[a-zß-öø-ÿ]", text)), "n_exclaim": text.count("!"),
    }


TEXTS = [
    None, "", "\n\n", "a", "x\n", "\nx", "x\nx\nx", "é É ÷ × ß ÿ Þ", "one two three four five six " * 4, "a b c d e\na b c d e\n",
    "A!! B!! C!!", "#1 $2 | & < >", prose(3, 300), "same\r\nsame\nsame\r\n", "日本 語 　x", "one two three four one two three four one two three",
]


def test_measures(table):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    for r in ledger.ledger(table(rows)).collect():
        assert {m: r[m] for m in ledger.MEASURES} == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_policies_read_the_bits(table):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    got = ledger.rule_table(table(rows)).collect()
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.failed_bits == 0) and not (r.kept and r.base_failed)
        alone = [name for name, bit in ledger.BITS.items() if r.failed_bits == bit]
        assert r.only_rule == (alone[0] if alone else None)
        assert r.kept_without == (sum(x.kept or x.failed_bits == r.failed_bits for x in got) if alone else None)
    entries = ledger.ledger(table(rows))
    for a in ledger.ablations(entries, ledger.STRICT).collect():
        bit = ledger.BITS[a.rule]
        bits = [r.failed_bits for r in got]
        want = (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))
        assert (a.n_failed, a.n_failed_alone, a.n_kept_without) == want
    any_, all_ = 0, -1
    for r in got:
        any_, all_ = any_ | r.failed_bits, all_ & r.failed_bits
    row = ledger.failures_in_common(entries, "source").first()
    assert (row.any_failed, row.all_failed) == (any_, all_)


def test_awkward_rows(awkward, empty):
    out = ledger.ledger(awkward)
    assert out.count() == awkward.count() and out.columns[: len(awkward.columns)] == awkward.columns
    for r in out.collect():
        if len(r.text or "") < 10_000:
            assert {m: r[m] for m in ledger.MEASURES} == brute(r.text)
    assert ledger.rule_table(empty).collect() == []
    assert all(a.n_failed == 0 for a in ledger.ablations(ledger.ledger(empty), ledger.STRICT).collect())
