from siftlake.llm import preferences as pf

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, pairing int"


def turns(spark, talks):
    rows = [(c, i, role, text, "own", 1) for c, own in talks for i, (role, text) in enumerate(own)]
    return spark.createDataFrame(rows, SCHEMA)


def render(own):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in own)


A = [("user", "hello"), ("assistant", "first answer"), ("user", "more"), ("assistant", "long é answer")]
B = [("user", "hello"), ("assistant", "first answer"), ("user", "other"), ("assistant", "reply")]
C = [("user", "hello"), ("assistant", "first answer")]


def test_prompt_completions_and_ranges(spark):
    out = pf.preference_table(turns(spark, [(1, A), (2, B), (5000, C)])).collect()
    by = {(r.pairing, r.chosen_id): r for r in out}
    r = by["opening", 1]
    assert (r.rejected_id, r.n_shared, r.prompt, r.chosen, r.rejected, r.usable) == (2, 2, render(A[:2]), render(A[2:]), render(B[2:]), True)
    for text, ranges, want in ((r.chosen, r.chosen_ranges, "long é answer"), (r.rejected, r.rejected_ranges, "reply")):
        begin, end = map(int, ranges.split("-"))
        assert text[begin:end] == want + "<|end|>\n"
    r = by["opening", 2]
    assert (r.rejected_id, r.n_shared, r.rejected, r.usable) == (5000, 2, "", False)
    r = by["swapped", 1]
    assert (r.prompt, r.chosen, r.rejected) == (render(A[:3]), render(A[3:]), render([B[3]]))
    assert ("opening", 5000) not in by and ("swapped", 5000) not in by


def test_neighbours_across_blocks(spark):
    """Dense, sparse and negative ids, in several range partitions that cut through a key."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        ids = [*range(40), *(i * 2**40 + 7 for i in range(-20, 0)), *(i * 2**41 for i in range(1, 30))]
        df = spark.createDataFrame([(i, "k" if i % 2 else None if i % 3 else "l") for i in ids], "id long, k string")
        groups = [[i for i in ids if i % 2], [i for i in ids if not i % 2 and i % 3], [i for i in ids if not i % 6]]
        for key, parts in (([], [ids]), (["k"], groups)):
            want = {pair for g in parts for pair in zip(sorted(g), sorted(g)[1:])}
            found = pf.next_ids(df, key).collect()
            assert {tuple(r) for r in found} == want and len(found) == len(want)
    finally:
        spark.conf.set(name, before)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "a <|end|> b"), (1, 0, "user", "a <|end|> b"),
        (2, 0, "user", "a <|end|> b"), (2, 1, "assistant", None), (2, 1, "assistant", ""), (3, 0, "assistant", "z"),
    ]
    out = pf.preference_table(spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA)).collect()
    by = {(r.pairing, r.chosen_id, r.rejected_id): r for r in out}
    assert set(by) == {("opening", 1, 2), ("swapped", 2, 3)}
    r = by["opening", 1, 2]
    assert r.prompt == "<|user|>\na < |end|> b<|end|>\n" and r.chosen == "<|unknown|>\n<|end|>\n"
    assert r.rejected == "<|assistant|>\n<|end|>\n" and not r.usable
    none = turns(spark, [(1, A)]).where("conv_id < 0")
    assert pf.preference_table(none).collect() == []


def test_one_opening_for_all_and_no_python(spark):
    talks = [(i, [("user", "same"), ("assistant", f"answer {i % 3}")]) for i in range(200)]
    out = pf.preference_table(turns(spark, talks))
    assert out.where("pairing = 'opening'").count() == 199
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
