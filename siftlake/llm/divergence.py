"""Audit of how the sources of a language differ in their words: in-mapper stripes.

A term is a run of a-z (after lower-casing A-Z only) and characters beyond ASCII. Every task folds whole
documents into stripes: for each (language, term) the number of documents holding it and its count in
each source. A task's stripes live in one hash table, which is written out when it reaches ``SPILL_ROWS``
entries. Stripes meet by key: a shuffle on (language, term) sorts them, and a streaming merge adds
neighbours of equal key, so a task holds one stripe at a time however many tasks have written it.

A language keeps the V terms found in at least ``min_docs`` of its documents. With ``count`` occurrences
of a kept term in a group (a source of the language, or the whole language) and N the sum of its counts
over kept terms, p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), all in whole numbers. Merged stripes
are dealt into blocks of about ``BLOCK_TERMS`` terms of one language; a block meets the totals of its
language and emits partial sums of |p - q| for pairs of sources and the best terms of each source.
A term that two sources both lack still adds the difference of their smallest p.

Sources are numbered per language; pairs are worked on in tiles of ``TILE`` by ``TILE`` sources, so memory
does not grow with the square of their number. The result itself does, as every ordered pair is a row.

Defined results: NULL text, language and source count as ''. A group without terms is still a group. A
language without kept terms gives 0 for each pair and no ``term`` rows. A language with one source has no
``pair`` rows. Repeated rows are separate documents. An empty table gives no rows. Exact up to 9 * 10^15
occurrences in one language.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import textblocks as tb
from .frames import prepare, stored, tidy

MIN_DOCS = 30
TOP_TERMS = 50
SCALE_STEPS = 3  # p is counted in 1000^3 parts
SMOOTHING = 5

BLOCK_BYTES = 4 << 20
# Entries (language, term, source) in a task's hash table: about 60 MB.
SPILL_ROWS = 1_000_000
BLOCK_TERMS = 2048
TILE = 128
MERGE_ROWS = 20_000

_KEYS = ["lang", "term", "source_no"]


def _letter_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[ord("a") : ord("z") + 1] = True
    table[0x80:] = True
    return table


_LETTERS = _letter_table()


def word_array(data: np.ndarray, words: tb.Words, table: np.ndarray) -> pa.Array:
    """The words of a block as one Arrow array of bytes."""
    ends = np.concatenate(([0], np.cumsum(words.ends - words.starts))).astype(np.int64)
    kept = np.ascontiguousarray(data[table[data]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


def _counted(block: tb.Block, lang: np.ndarray, source: np.ndarray) -> pa.Table:
    """Counts and document numbers of each (language, term, source) of a block."""
    data = tb.lower_ascii(block.data)
    words = tb.words(tb.Block(data, block.offsets, block.first), _LETTERS)
    coded = word_array(data, words, _LETTERS).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = len(block)
    in_document, times = np.unique(code * texts + words.owner(), return_counts=True)
    code, document = in_document // texts, in_document % texts
    pairs, group = np.unique(np.stack([lang, source]), axis=1, return_inverse=True)
    key, place = np.unique(code * pairs.shape[1] + group.reshape(-1)[document], return_inverse=True)
    counts = np.zeros(len(key), dtype=np.int64)
    np.add.at(counts, place, times)
    which = pairs[:, key % pairs.shape[1]]
    return pa.table({
        "lang": pa.array(which[0], pa.int32()),
        "term": coded.dictionary.take(pa.array(key // pairs.shape[1])),
        "source_no": pa.array(which[1], pa.int32()),
        "count": counts,
        "docs": np.bincount(place, minlength=len(key)).astype(np.int64),
    })


def _folded(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(_KEYS).aggregate([("count", "sum"), ("docs", "sum")])
    return out.select([*_KEYS, "count_sum", "docs_sum"]).rename_columns([*_KEYS, "count", "docs"])


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.concatenate((starts, [len(values)])), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


_STRIPE = ["lang", "term", "docs", "sources", "counts"]


def _stripes(folded: pa.Table, languages: list[str]):
    """One row per (language, term) with its sources, in slices that stay small."""
    folded = folded.sort_by([("lang", "ascending"), ("term", "ascending")]).combine_chunks()
    if not len(folded):
        return
    lang = folded["lang"].to_numpy()
    term = folded["term"].combine_chunks().dictionary_encode()
    code = (term.chunk(0) if isinstance(term, pa.ChunkedArray) else term).indices.to_numpy(zero_copy_only=False)
    new = np.ones(len(folded), dtype=bool)
    new[1:] = (lang[1:] != lang[:-1]) | (code[1:] != code[:-1])
    starts = np.flatnonzero(new)
    names = pa.array(languages, pa.string()).take(pa.array(lang[starts]))
    terms = folded["term"].combine_chunks().take(pa.array(starts)).cast(pa.large_string()).cast(pa.string())
    docs = np.add.reduceat(folded["docs"].to_numpy(), starts)
    sources = _lists(folded["source_no"].to_numpy(), starts, pa.int32())
    counts = _lists(folded["count"].to_numpy(), starts, pa.int64())
    batch = pa.RecordBatch.from_arrays([names, terms, pa.array(docs, pa.int64()), sources, counts], names=_STRIPE)
    for at in range(0, batch.num_rows, MERGE_ROWS):
        yield batch.slice(at, MERGE_ROWS)


def _fold(batches, spill_rows: int):
    """Stripes of all documents of a task, written out whenever its hash table is full."""
    languages, numbers = [], {}
    held, waiting, rows = None, [], 0
    for batch in batches:
        own = [numbers.setdefault(name, len(numbers)) for name in batch.column(0).to_pylist()]
        languages = list(numbers)
        lang, source = np.array(own, dtype=np.int64), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for block in tb.blocks(batch.column(2), BLOCK_BYTES):
            rows_of = slice(block.first, block.first + len(block))
            waiting.append(_counted(block, lang[rows_of], source[rows_of]))
            rows += len(waiting[-1])
            if rows >= spill_rows:
                held = _folded(waiting if held is None else [held, *waiting])
                waiting, rows = [], 0
                if len(held) >= spill_rows:
                    yield from _stripes(held, languages)
                    held = None
    if waiting or held is not None:
        yield from _stripes(_folded(waiting if held is None else [held, *waiting]), languages)


def _sum_neighbours(table: pa.Table) -> pa.RecordBatch:
    """Rows of equal key, which stand together, as one."""
    lang, term = (table[c].combine_chunks() for c in ("lang", "term"))
    new = np.ones(len(table), dtype=bool)
    if len(table) > 1:
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    sources, counts = table["sources"].combine_chunks(), table["counts"].combine_chunks()
    owner = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy(zero_copy_only=False))
    source = sources.flatten().to_numpy().astype(np.int64)
    width = int(source.max()) + 1 if len(source) else 1
    key, place = np.unique(owner * width + source, return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, place, counts.flatten().to_numpy())
    first = np.searchsorted(key // width, np.arange(len(starts)))
    take = pa.array(starts)
    return pa.RecordBatch.from_arrays([
        lang.take(take), term.take(take),
        pa.array(np.add.reduceat(table["docs"].to_numpy(), starts), pa.int64()),
        _lists(key % width, first, pa.int32()), _lists(total, first, pa.int64()),
    ], names=_STRIPE)


def _merge(batches, min_docs: int, merge_rows: int):
    """Sorted stripes with equal keys added up; the last key of a chunk waits for the next one."""
    waiting, rows = [], 0

    def kept(batch):
        return batch.filter(pc.greater_equal(batch.column(2), min_docs))

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= merge_rows:
            merged = _sum_neighbours(pa.Table.from_batches(waiting))
            yield kept(merged.slice(0, merged.num_rows - 1))
            waiting = [merged.slice(merged.num_rows - 1)]
            rows = 1
    if rows:
        yield kept(_sum_neighbours(pa.Table.from_batches(waiting)))


def _plain(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """p of each count: 1 + floor(10^9 * (count + 5) / (total + 5 * terms)), by long division."""
    rest, whole = counts + SMOOTHING, total + SMOOTHING * terms
    p = np.zeros(np.broadcast_shapes(rest.shape, np.shape(whole)), dtype=np.int64)
    # The first quotient is a whole part: count + 5 may equal N + 5 * V.
    p += rest // whole
    rest = rest % whole
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        p = p * 1000 + rest // whole
        rest = rest % whole
    return p + 1


def _divergences(stripes: pa.Table, totals: pa.Table, top: int, width: int) -> pa.Table:
    """Partial pair sums and best terms of one block of terms for the sources of one tile.

    ``totals`` holds all sources of the language, tiles are ``width`` sources wide; pairs (a, b) have a < b and a in the tile.
    """
    totals = totals.sort_by("source_no")
    tile, lang = totals["tile"][0].as_py(), totals["lang"][0].as_py()
    names = totals["source"].to_pylist()
    n, v = totals["n"].to_numpy(), totals["v"][0].as_py()
    order = stripes.sort_by("term") if len(stripes) else stripes
    sources = order["sources"].combine_chunks()
    sizes = pc.list_value_length(sources).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(order)), sizes)
    source = sources.flatten().to_numpy()
    count = order["counts"].combine_chunks().flatten().to_numpy()

    def dense(low, high):
        block = np.zeros((len(order), high - low), dtype=np.int64)
        inside = (source >= low) & (source < high)
        block[row[inside], source[inside] - low] = count[inside]
        return block

    low, high = tile * width, min((tile + 1) * width, len(names))
    own_counts = dense(low, high)
    parts, items, values, owners = [], [], [], []
    own = shares(own_counts, n[low:high], v) if v else None
    for other_low in range(low, len(names), width):
        other_high = min(other_low + width, len(names))
        if v:
            other = own if other_low == low else shares(dense(other_low, other_high), n[other_low:other_high], v)
        for a in range(low, high):
            first = max(a + 1, other_low)
            if first >= other_high:
                continue
            if v:
                sums = np.abs(other[:, first - other_low :] - own[:, a - low : a - low + 1]).sum(axis=0)
            else:
                sums = np.zeros(other_high - first, dtype=np.int64)
            parts += ["pair"] * len(sums)
            owners += [names[a]] * len(sums)
            items += names[first:other_high]
            values += sums.tolist()
    if len(order):
        whole = np.zeros(len(order), dtype=np.int64)
        np.add.at(whole, row, count)
        lead = own - shares(whole, n.sum(), v)[:, None]
        terms = order["term"].to_pylist()
        for a in range(high - low):
            found = np.flatnonzero((own_counts[:, a] > 0) & (lead[:, a] > 0))
            best = found[np.argsort(-lead[found, a], kind="stable")][:top]
            parts += ["term"] * len(best)
            owners += [names[low + a]] * len(best)
            items += [terms[i] for i in best]
            values += lead[best, a].tolist()
    return pa.table({
        "lang": pa.array([lang] * len(parts), pa.string()), "source": pa.array(owners, pa.string()),
        "part": pa.array(parts, pa.string()), "item": pa.array(items, pa.string()), "value": pa.array(values, pa.int64()),
    })


@dataclass(frozen=True)
class Audit:
    """``stripes``: kept terms (lang, term, docs, sources, counts). ``groups``: lang, source, source_no, n, v."""

    stripes: DataFrame
    groups: DataFrame


def collect_stripes(
    docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source",
    spill_rows: int = SPILL_ROWS, merge_rows: int = MERGE_ROWS,
) -> Audit:
    """Merged stripes of all documents and the groups' totals over kept terms, as stored tables."""
    prepare(docs.sparkSession)
    rows = docs.select(_plain(lang).alias("lang"), _plain(source).alias("source"), F.col(text).alias("text"))
    found = rows.select("lang", "source").distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(found.withColumn("source_no", number), "divergence-groups")
    # Spark broadcasts the table of groups if its size allows; else skewed sources are split at run time.
    numbered = rows.join(groups, ["lang", "source"]).select("lang", "source_no", "text")
    folded = numbered.mapInArrow(
        tidy(lambda batches: _fold(batches, spill_rows)), "lang string, term string, docs long, sources array<int>, counts array<long>"
    )
    ordered = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    merged = stored(ordered.mapInArrow(tidy(lambda batches: _merge(batches, min_docs, merge_rows)), folded.schema), "divergence-stripes")

    entry = F.explode(F.arrays_zip("sources", "counts")).alias("e")
    n = merged.select("lang", entry).groupBy("lang", F.col("e.sources").alias("source_no")).agg(F.sum("e.counts").alias("n"))
    v = merged.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = groups.join(n, ["lang", "source_no"], "left").join(v, "lang", "left")
    totals = totals.select("lang", "source", "source_no", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v")])
    return Audit(merged, stored(totals, "divergence-totals"))


def divergences(audit: Audit, top: int = TOP_TERMS, width: int = TILE, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances of sources and the terms a source has more of."""
    per_lang = audit.groups.groupBy("lang").agg(F.max("v").alias("_v"), F.max("source_no").alias("_last"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_v") / block_terms)).cast("int")
    tiles = F.sequence(F.lit(0), F.floor(F.col("_last") / width).cast("int"))
    per_lang = per_lang.select("lang", blocks.alias("_blocks"), tiles.alias("_tiles"))
    block = F.pmod(F.xxhash64("term"), F.col("_blocks")).cast("int")
    dealt = audit.stripes.join(per_lang, "lang").select(
        "lang", "term", "sources", "counts", block.alias("block"), F.explode("_tiles").alias("tile")
    )
    numbers = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block")
    totals = audit.groups.join(per_lang, "lang").select("lang", "source", "source_no", "n", "v", "_tiles", numbers)
    totals = totals.select("lang", "source", "source_no", "n", "v", "block", F.explode("_tiles").alias("tile"))

    keys = ["lang", "block", "tile"]
    out = dealt.groupBy(*keys).cogroup(totals.groupBy(*keys)).applyInArrow(
        lambda stripes, groups: _divergences(stripes, groups, top, width), "lang string, source string, part string, item string, value long"
    )
    out = stored(out, "divergence-parts")

    half = out.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    mirrored = F.inline(F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
    ))
    pairs = half.select("lang", "part", "value", mirrored).select("lang", "source", "part", "item", "value")
    terms = out.where("part = 'term'").select("lang", "source", "part", "item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def divergence_table(docs: DataFrame) -> DataFrame:
    """The audit of all documents."""
    return divergences(collect_stripes(docs))


_TERMS = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_LOWERED = "translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Counterpart of ``divergence_table`` in DuckDB's SQL.
SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, text FROM documents
), word AS (
  SELECT doc, lang, source, {_LOWERED} AS term FROM (SELECT doc, lang, source, unnest({_TERMS}) AS term FROM docs)
), kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL
), every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p
  FROM every WINDOW w AS (PARTITION BY lang, source)
), whole AS (
  SELECT lang, term, sum(n) AS n FROM every GROUP BY lang, term
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q
  FROM whole WINDOW w AS (PARTITION BY lang)
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS i, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y
    ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND d.s = a.source AND d.i = b.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
) WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
