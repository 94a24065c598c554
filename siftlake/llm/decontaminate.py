"""Benchmark decontamination: a BM25 index of test items, searched by every passage of every document.

*Index.* The words of an item (letters and digits, case-folded) get BM25 weights, divided by the sum of
the item's weights: a passage that holds all its words scores 1. Postings are kept per term, in item
order, with the highest weight of each block of ``BLOCK_ITEMS`` items.

*Search*, block-max WAND with a fixed threshold, for many passages at once. Documents are read in
passages of ``PASSAGE`` words, each beginning half a passage after the last, so that every run of up to
half a passage lies whole in one of them. Longer items are searched in passages of twice that length, four
times, and so on, whatever other items there are. A passage is dropped when the highest weights of its
distinct terms add up to less than the threshold: then no item can be a pivot. For the others the block maxima are added up; a block whose sum
stays below the threshold is skipped, and only the postings of the remaining blocks are scored. As the
threshold never rises, every pivot that a cursor would stop at lies in one of those blocks. All items at
or above the threshold are found, not just the best ones.

*Verification.* A found item counts when the passage also holds at least ``OVERLAP`` of the word
trigrams of its question, and of its answer where it has one (of the whole part, if shorter).

The index is broadcast in slices of at most ``SLICE_ITEMS`` items and about ``SLICE_BYTES`` of text (one longer
item is a slice), all of one passage length; every task searches all slices in one pass over its documents. Items with equal question and answer
are indexed once, under the smallest of their ids. Document frequencies always come from all items.

Defined results: NULL text holds nothing; items without a word are never found; ``leak_table`` gives items with
equal texts under each of their ids, once per row of the benchmark; NULL ids are carried through. Repeated documents give repeated rows.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import textblocks as tb
from .frames import append_columns, prepare, stored

THRESHOLD = 0.6
OVERLAP = 0.6
PASSAGE = 128
BLOCK_ITEMS = 4
SLICE_ITEMS = 20_000
SLICE_BYTES = 16 << 20
K1, B = 1.2, 0.75
_GRAM = 3
# Passages scored at once.
_TOGETHER = 64

LEAK = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double,item_no:long>>"


def terms(texts: pa.Array):
    """For each block: row of its first text, term hashes and the range of terms of each text."""
    for block, found in tb.terms(texts):
        yield block.first, tb.span_hashes(block.data, found.starts, found.ends), found.bounds


def _term_lists(texts: list) -> list[np.ndarray]:
    out = []
    for _, hashes, bounds in terms(pa.array(texts, pa.string())):
        out += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _grams(own: np.ndarray) -> tuple[int, np.ndarray]:
    """Distinct word trigrams of a part; a shorter part is one gram of all its words."""
    width = min(_GRAM, len(own))
    return width, np.unique(tb.window_hashes(own, np.array([0, len(own)]), width)[0]) if width else own


@dataclass(frozen=True)
class Index:
    """One slice of items; ``terms`` is sorted, postings of term i stand at pointer[i] to pointer[i + 1]."""

    item_ids: list
    item_nos: list
    terms: np.ndarray
    pointer: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    block_pointer: np.ndarray
    blocks: np.ndarray
    block_weights: np.ndarray
    term_weights: np.ndarray
    questions: list
    answers: list
    passage: int


def passage_length(words: int) -> int:
    """Words of the passages in which an item of that many words is searched."""
    size = PASSAGE
    while size < 2 * words:
        size *= 2
    return size


def _slice_index(rows: list, frequency: dict[int, int], n_items: int, mean_length: float, passage: int) -> Index:
    questions = _term_lists([r.question for r in rows])
    answers = _term_lists([r.answer for r in rows])
    both = [np.concatenate((q, a)) for q, a in zip(questions, answers)]
    lengths = np.array([len(x) for x in both])
    owner = np.repeat(np.arange(len(rows)), lengths)
    vocabulary, place = np.unique(np.concatenate(both) if both else np.zeros(0, np.uint64), return_inverse=True)
    pair, tf = np.unique(place * len(rows) + owner, return_counts=True)
    term, item = np.divmod(pair, max(len(rows), 1))
    df = np.array([frequency[int(t)] for t in vocabulary.view(np.int64)], dtype=np.float64)
    idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * lengths[item] / max(mean_length, 1e-9))
    weight = idf[term] * tf * (K1 + 1) / (tf + norm)
    weight /= np.bincount(item, weight, minlength=len(rows))[item]
    pointer = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    n_blocks = -(-len(rows) // BLOCK_ITEMS)
    key = term * max(n_blocks, 1) + item // BLOCK_ITEMS
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    block_weights = np.maximum.reduceat(weight, starts) if len(key) else weight
    block_pointer = np.searchsorted(term[starts], np.arange(len(vocabulary) + 1))
    return Index(
        [r.item_id for r in rows], [r.item_no for r in rows], vocabulary, pointer, item, weight,
        block_pointer, item[starts] // BLOCK_ITEMS, block_weights,
        np.maximum.reduceat(block_weights, block_pointer[:-1]) if len(vocabulary) else block_weights,
        [_grams(q) for q in questions], [_grams(a) for a in answers],
        passage,
    )


@dataclass(frozen=True)
class Items:
    """Indexes of the distinct items, and a table (item_no, item_id) of all items behind them."""

    indexes: list[Index]
    ids: DataFrame


def _slices(rows):
    """Rows by length of their passages, cut into slices of bounded items and bytes; items without a word are left out."""
    waiting: dict[int, list] = {}
    sizes: dict[int, int] = {}
    for row in rows:
        texts = [row.question or "", row.answer or ""]
        words = sum(map(len, _term_lists(texts)))
        if not words:
            continue
        passage, size = passage_length(words), sum(len(t.encode()) for t in texts)
        if waiting.get(passage) and (len(waiting[passage]) >= SLICE_ITEMS or sizes[passage] + size > SLICE_BYTES):
            yield passage, waiting.pop(passage)
            sizes[passage] = 0
        waiting.setdefault(passage, []).append(row)
        sizes[passage] = sizes.get(passage, 0) + size
    yield from sorted(waiting.items())


def build(items: DataFrame) -> Items:
    """Indexes of all items (item_id long, question, answer)."""
    prepare(items.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "question", "answer")

    def words(batches):
        for batch in batches:
            both = pc.binary_join_element_wise(batch.column(0), batch.column(1), " ", null_handling="skip")
            for _, hashes, bounds in terms(both):
                for a, b in zip(bounds[:-1], bounds[1:]):
                    if b > a:
                        own = np.unique(hashes[a:b]).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own), pa.array(np.where(np.arange(len(own)) == 0, b - a, 0))], names=["term", "length"]
                        )

    found = items.select("question", "answer").mapInArrow(words, "term long, length long")
    counted = found.groupBy("term").agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("length") > 0).alias("items"), F.sum("length").alias("words"))
    frequency = stored(counted, "leak-terms")
    n_items, n_words = frequency.agg(F.sum("items"), F.sum("words")).first()
    # Equal items, however many, collapse before the shuffle; the stored numbers stay the same in all later reads.
    once = items.groupBy("question", "answer").agg(F.min("item_id").alias("item_id"))
    once = stored(once.withColumn("item_no", F.monotonically_increasing_id()), "leak-items")
    same = [items[c].eqNullSafe(once[c]) for c in ("question", "answer")]
    ids = items.join(once, same).select(once["item_no"], items["item_id"])
    indexes = []
    # The driver takes one partition at a time.
    for passage, rows in _slices(once.orderBy("item_no").toLocalIterator()):
        own = {int(t) for r in rows for x in _term_lists([r.question or "", r.answer or ""]) for t in x.view(np.int64)}
        known = items.sparkSession.createDataFrame([(t,) for t in own], "term long")
        counts = {r.term: r["count"] for r in frequency.join(known, "term", "left_semi").collect()}
        indexes.append(_slice_index(rows, counts, n_items, n_words / n_items, passage))
    return Items(indexes, ids)


def build_indexes(items: DataFrame) -> list[Index]:
    """The indexes alone."""
    return build(items).indexes


def _expand(pointer: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the postings of the chosen terms, and which choice each belongs to."""
    sizes = pointer[chosen + 1] - pointer[chosen]
    which = np.repeat(np.arange(len(chosen)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - pointer[chosen], sizes), which


def search(index: Index, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, threshold: float):
    """(passage, item, score) of all items at or above the threshold for passages of a block's terms."""
    at = np.searchsorted(index.terms, hashes)
    at[at == len(index.terms)] = 0
    at = np.where(index.terms[at] == hashes, at, -1)
    n_items = len(index.item_ids)
    n_blocks = -(-n_items // BLOCK_ITEMS)
    n_terms = len(index.terms)
    for low in range(0, len(begins), _TOGETHER):
        first, last = begins[low : low + _TOGETHER], ends[low : low + _TOGETHER]
        n = len(first)
        sizes = last - first
        passage = np.repeat(np.arange(n), sizes)
        own = at[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)]
        distinct = np.unique(passage[own >= 0] * n_terms + own[own >= 0])
        passage, term = np.divmod(distinct, n_terms)
        # No pivot: a passage whose terms' highest weights stay below the threshold holds no item.
        reach = np.bincount(passage, index.term_weights[term], n) >= threshold - 1e-9
        passage, term = passage[reach[passage]], term[reach[passage]]
        posting, which = _expand(index.block_pointer, term)
        bound = np.bincount(passage[which] * n_blocks + index.blocks[posting], index.block_weights[posting], n * n_blocks)
        open_ = bound >= threshold - 1e-9
        if not open_.any():
            continue
        some = open_.reshape(n, n_blocks).any(axis=1)[passage]
        passage, term = passage[some], term[some]
        posting, which = _expand(index.pointer, term)
        item, passage = index.items[posting], passage[which]
        alive = open_[passage * n_blocks + item // BLOCK_ITEMS]
        score = np.bincount(passage[alive] * n_items + item[alive], index.weights[posting[alive]], n * n_items)
        for cell in np.flatnonzero(score >= threshold - 1e-9):
            yield low + cell // n_items, cell % n_items, score[cell]


def _passages(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of each passage of a block; the last passage of a text ends with it."""
    step = size // 2
    counts = np.where(np.diff(bounds) > 0, np.maximum(-(-(np.diff(bounds) - size) // step), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begins = bounds[text] + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    return begins, np.minimum(begins + size, bounds[text + 1]), text


def _share(part: tuple[int, np.ndarray], own: np.ndarray, cache: dict) -> float:
    """Share of a part's grams found among the terms of a passage; 1 for a part without words."""
    width, grams = part
    if not width:
        return 1.0
    if width not in cache:
        cache[width] = tb.window_hashes(own, np.array([0, len(own)]), width)[0]
    return float(np.isin(grams, cache[width]).mean())


def leaks(
    docs: DataFrame, indexes: list[Index], text: str = "text", column: str = "leaks",
    threshold: float = THRESHOLD, overlap: float = OVERLAP,
) -> DataFrame:
    """Every document with the items it holds: item_id, best score and the overlaps of its best passage."""
    if not indexes:
        return docs.withColumn(column, F.expr(f"cast(array() as {LEAK})"))
    sent = [docs.sparkSession.sparkContext.broadcast(index) for index in indexes]
    kind = pa.list_(pa.struct([
        ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
        ("item_no", pa.int64()),
    ]))

    def make():
        def compute(batch):
            # All slices in one pass: the words of a block are hashed once, and one worker serves a task.
            found = [{} for _ in range(batch.num_rows)]
            for first_row, hashes, bounds in terms(batch.column(text)):
                for number, index in enumerate(s.value for s in sent):
                    begins, ends, owner = _passages(bounds, index.passage)
                    for p, item, score in search(index, hashes, begins, ends, threshold):
                        own, cache = hashes[begins[p] : ends[p]], {}
                        shares = [_share(part[item], own, cache) for part in (index.questions, index.answers)]
                        best, key = found[first_row + owner[p]], (number, item)
                        if min(shares) >= overlap and (key not in best or best[key]["score"] < score):
                            best[key] = {
                                "item_id": index.item_ids[item], "score": float(score),
                                "question_overlap": shares[0], "answer_overlap": shares[1], "item_no": index.item_nos[item],
                            }
            return (pa.array([[f[k] for k in sorted(f)] for f in found], kind),)

        return compute

    return append_columns(docs, f"{column} {LEAK}", make)


def item_parts(text: str = "text") -> tuple[Column, Column]:
    """Question and answer of an item given as one text: its last sentence or line is the answer.

    An item of one sentence is all question.
    """
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\s.?!]+\z", "")
    split = r"(?s)\A(.*[.?!\n])(.*)\z"
    question = F.when(trimmed.rlike(split), F.regexp_extract(trimmed, split, 1)).otherwise(trimmed)
    return question, F.regexp_extract(trimmed, split, 2)


def items_of(benchmark: DataFrame) -> Items:
    """Items of a benchmark table (item_id, text)."""
    question, answer = item_parts()
    return build(benchmark.select("item_id", question.alias("question"), answer.alias("answer")))


def indexes_of(benchmark: DataFrame) -> list[Index]:
    """Indexes of a benchmark table (item_id, text)."""
    return items_of(benchmark).indexes


def leak_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score and overlaps of every verified leak."""
    items = items_of(benchmark)
    found = leaks(docs.select("doc_id", "text"), items.indexes).select("doc_id", F.inline("leaks"))
    return found.drop("item_id").join(items.ids, "item_no").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
