"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Words are runs of digits, a-z (after lower-casing A-Z only) and characters beyond ASCII. Features are all
runs of 1 to ``max_n`` consecutive words joined by one space, repeats counted; a feature's bucket is the
crc32 of its bytes modulo ``buckets``. The crc32 of a longer run goes on from the state of the run without
its last word.

The head is broadcast: the states of frequent words and the buckets of frequent pairs of words. A task
names those that make up at least one in ``HEAD`` of its words, so no word of that share in the whole
table is missed; the ``HEAD`` with the highest sums stay. Words of more than ``HEAD_BYTES`` bytes, and
pairs of more than twice that, are left to the tail. So the head holds at most 3 * HEAD * HEAD_BYTES bytes of text, for any
table. The tail is whatever the head does not hold: its crc32 is computed directly. Both give the same
numbers, and both feed exact totals of every bucket over all documents.

The buckets of each document are stored once, so texts are read twice in all: for the head and for the
buckets. A bucket's gain is floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B)))); a document's weight is the floored
mean gain of its features, its score adds Gumbel noise drawn from its id. Documents of at least
``min_words`` words are ranked by score by one distributed sort; the best ``percent`` are drawn.

Defined results: NULL text has no features, weight 0 and no rank. A NULL id counts as empty text for its
noise and stands after all others at equal scores. Rows equal in score and id take consecutive ranks.
An empty target gives gains from t = T = 0; an empty table gives no rows.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from . import textblocks as tb
from .divergence import word_array
from .frames import free_name, prepare, stored, tidy

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

HEAD = 20_000
HEAD_BYTES = 64
BLOCK_BYTES = 4 << 20
# Distinct words and pairs a task holds while it looks for frequent ones: about 50 MB.
FOLD_ROWS = 500_000


@dataclass(frozen=True)
class Head:
    """crc32 states of frequent words, and buckets of frequent pairs by their words."""

    states: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]


def _word_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[ord("0") : ord("9") + 1] = True
    table[ord("a") : ord("z") + 1] = True
    table[0x80:] = True
    return table


_WORD = _word_table()


def _coded(block: tb.Block):
    """Distinct words of a block, the code of each of its words, and the range of words of each text."""
    data = tb.lower_ascii(block.data)
    words = tb.words(tb.Block(data, block.offsets, block.first), _WORD)
    coded = word_array(data, words, _WORD).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.bounds


def _starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Positions at which a run of n words of one text begins, in order."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    before = np.concatenate(([0], np.cumsum(counts)))
    return np.repeat(bounds[:-1] - before[:-1], counts) + np.arange(before[-1])


def _frequent(batches, max_n: int, head: int, fold_rows: int):
    """Words and pairs that make up at least 1 / head of a part of a task's words, with their counts there."""
    held = {1: [], 2: []}
    seen = {1: 0, 2: 0}

    def fold(n):
        table = pa.concat_tables(held[n]).group_by(["feature"]).aggregate([("count", "sum")])
        return table.select(["feature", "count_sum"]).rename_columns(["feature", "count"])

    def emit(n):
        if held[n]:
            table = fold(n)
            table = table.filter(pc.greater_equal(pc.multiply(table["count"], head), seen[n]))
            feature = table["feature"].combine_chunks().cast(pa.large_string()).cast(pa.string())
            count = table["count"].combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(table), pa.int32()), feature, count], names=["n", "feature", "count"])
        held[n], seen[n] = [], 0

    def add(n, features, counts):
        short = pc.less_equal(pc.binary_length(features), n * HEAD_BYTES)
        held[n].append(pa.table({"feature": features, "count": pa.array(counts, pa.int64())}).filter(short))
        seen[n] += int(counts.sum())
        if sum(map(len, held[n])) >= fold_rows:
            held[n] = [fold(n)]
        if sum(map(len, held[n])) >= fold_rows:
            yield from emit(n)

    for batch in batches:
        for block in tb.blocks(batch.column(0), BLOCK_BYTES):
            words, code, bounds = _coded(block)
            yield from add(1, words, np.bincount(code, minlength=len(words)))
            if max_n > 1:
                at = _starts(bounds, 2)
                pair, counts = np.unique(code[at] * len(words) + code[at + 1], return_counts=True)
                first, second = (words.take(pa.array(x)) for x in (pair // max(len(words), 1), pair % max(len(words), 1)))
                space = pa.scalar(b" ", pa.large_binary())
                yield from add(2, pc.binary_join_element_wise(first, second, space), counts)
    for n in held:
        yield from emit(n)


def find_head(
    docs: DataFrame, text: str = "text", max_n: int = 1, buckets: int = BUCKETS, head: int = HEAD, fold_rows: int = FOLD_ROWS
) -> Head:
    """The frequent words, and for ``max_n`` of 2 or more the frequent pairs, of a table."""
    prepare(docs.sparkSession)
    named = docs.select(text).mapInArrow(tidy(lambda b: _frequent(b, max_n, head, fold_rows)), "n int, feature string, count long")
    summed = stored(named.groupBy("n", "feature").agg(F.sum("count").alias("count")), "importance-head")
    states, pairs = {}, {}
    for n in (1, 2) if max_n > 1 else (1,):
        best = summed.where(F.col("n") == n).orderBy(F.desc("count"), "feature").limit(head).select("feature").collect()
        for row in best:
            feature = row.feature.encode()
            if n == 1:
                states[feature] = zlib.crc32(feature)
            else:
                first, second = feature.split(b" ")
                pairs[first, second] = zlib.crc32(feature) % buckets
    return Head(states, pairs)


def _bucket_lists(block: tb.Block, head: Head, max_n: int, buckets: int):
    """Number of words of each text, its features' buckets and where each text's begin."""
    words, code, bounds = _coded(block)
    spelled = words.to_pylist()
    known = head.states
    state = np.array([known[w] if w in known else zlib.crc32(w) for w in spelled], dtype=np.int64)
    owner = np.repeat(np.arange(len(block)), np.diff(bounds))
    # run[i] numbers the run of n words that begins at word i; runs are numbered anew for each n.
    run, states = code, state
    found, owners = [(state % buckets)[code]], [owner]
    for n in range(2, max_n + 1):
        at = _starts(bounds, n)
        pair, place = np.unique(run[at] * max(len(spelled), 1) + code[at + n - 1], return_inverse=True)
        before, last = pair // max(len(spelled), 1), pair % max(len(spelled), 1)
        # The state is needed unless the head has the bucket and no longer run goes on from it.
        frequent = head.pairs if n == 2 and max_n == 2 else {}
        at_head = [frequent.get((spelled[r], spelled[w]), -1) if frequent else -1 for r, w in zip(before, last)]
        next_states = np.array(
            [b if b >= 0 else zlib.crc32(b" " + spelled[w], int(states[r])) for b, r, w in zip(at_head, before, last)], dtype=np.int64
        )
        found.append((next_states % buckets)[place])
        owners.append(owner[at])
        run = np.zeros(len(code), dtype=np.int64)
        run[at] = place
        states = next_states
    all_buckets, all_owners = np.concatenate(found), np.concatenate(owners)
    if max_n > 1:
        order = np.argsort(all_owners, kind="stable")
        all_buckets, all_owners = all_buckets[order], all_owners[order]
    return np.diff(bounds), all_buckets, np.bincount(all_owners, minlength=len(block))


def hashed(
    docs: DataFrame, head: Head, text: str = "text", keep=(), max_n: int = 1, buckets: int = BUCKETS,
    n_words: str = "n_words", n_features: str = "n_features", column: str = "buckets",
) -> DataFrame:
    """The columns ``keep`` of every row with its numbers of words and features and its features' buckets."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(head)
    keep = list(keep)
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    new = StructType.fromDDL(f"{n_words} long, {n_features} long, {column} array<int>")
    schema = StructType([docs.schema[c] for c in keep] + list(new.fields))

    def run(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(len(keep)), BLOCK_BYTES):
                n, found, sizes = _bucket_lists(block, sent.value, max_n, buckets)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32()))
                part = batch.slice(block.first, len(block))
                added = [pa.array(n, pa.int64()), pa.array(sizes, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + added, names=schema.names)

    return rows.mapInArrow(tidy(run), schema)


def bucket_totals(rows: DataFrame, column: str = "buckets", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket; a task adds up its rows first."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    parts = rows.select(column).mapInArrow(tidy(run), "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    # At most one row per bucket.
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of a bucket's shares in the target and in the source, each bucket counted once more."""
    size = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + size) / ((source + 1.0) * (float(target.sum()) + size))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weighed(rows: DataFrame, gains: np.ndarray, column: str = "buckets", weight: str = "weight") -> DataFrame:
    """Rows with the floored mean gain of their features in place of the buckets; 0 without features."""
    kept = [c for c in rows.columns if c != column]
    schema = StructType([rows.schema[c] for c in kept] + list(StructType.fromDDL(f"{weight} long").fields))

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(column))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.concatenate(([0], np.cumsum(gains[lists.flatten().to_numpy()])))
            ends = np.cumsum(sizes)
            mean = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(mean, pa.int64())], names=schema.names)

    return rows.mapInArrow(tidy(run), schema)


def with_score(rows: DataFrame, doc_id: str = "doc_id", weight: str = "weight", score: str = "score", seed: int = SEED) -> DataFrame:
    """Weight plus thousandfold Gumbel noise, drawn from the seed and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long").cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return rows.withColumn(score, F.col(weight) + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))))


def ranked(
    rows: DataFrame, doc_id: str = "doc_id", n_words: str = "n_words", score: str = "score", rank: str = "rank",
    min_words: int = MIN_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """Every row with its rank among the drawn ones, NULL for the others.

    One range sort puts rows of enough words first, by score; a row's place is its place in its partition
    and the number of rows in partitions before. ``rows`` must be a stored table, as its rows are numbered to
    spread ties of score and id over partitions.
    """
    part, at, tie, start = (free_name(rows, c) for c in ("_part", "_at", "_tie", "_start"))
    enough = F.coalesce(F.col(n_words) >= min_words, F.lit(False))
    numbered = rows.withColumn(tie, F.monotonically_increasing_id())
    ordered = numbered.orderBy(enough.desc(), F.desc(score), F.col(doc_id).asc_nulls_last(), tie)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(ordered.withColumn(part, F.spark_partition_id()).withColumn(at, within).drop(tie), "importance-order")
    # One row per partition.
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(start), F.count_if(enough).alias(at))
    drawn = percent * (sizes.agg(F.sum(at)).first()[0] or 0) // 100
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    place = F.col(start) + F.col(at) + 1
    out = placed.join(F.broadcast(starts), part)
    return out.withColumn(rank, F.when(place <= F.lit(drawn), place)).drop(part, at, start)


def resample(
    docs: DataFrame, target: DataFrame, keep=None, text: str = "text", target_text: str = "text", doc_id: str = "doc_id",
    max_n: int = 1, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT, head: int = HEAD,
) -> DataFrame:
    """Rows with their columns ``keep`` (all, if None), n_words, n_features, weight, score and rank.

    Where a kept column has one of the new names, the new column gets an underscore before it.
    """
    keep = list(docs.columns if keep is None else keep)
    names = {n: free_name(docs.select(*keep), n) for n in ("n_words", "n_features", "weight", "score", "rank", "buckets")}
    vocabulary = find_head(docs, text, max_n, buckets, head)
    rows = stored(
        hashed(docs, vocabulary, text, keep, max_n, buckets, names["n_words"], names["n_features"], names["buckets"]),
        "importance-buckets",
    )
    goal = bucket_totals(hashed(target, vocabulary, target_text, (), max_n, buckets), buckets=buckets)
    gains = bucket_gains(bucket_totals(rows, names["buckets"], buckets), goal)
    scored = with_score(weighed(rows, gains, names["buckets"], names["weight"]), doc_id, names["weight"], names["score"], seed)
    scored = stored(scored, "importance-scores")
    return ranked(scored, doc_id, names["n_words"], names["score"], names["rank"], min_words, percent)


def importance_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document, drawn towards the benchmark's texts."""
    return resample(docs, benchmark, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
# One step of the crc for a value of eight bits, eight times.
_BYTE_STATE = "list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(hex(word)) // 2), "
    "lambda k: ('0x' || substr(hex(word), 2 * k + 1, 2))::BIGINT)), "
    "lambda c, b: xor(c >> 8, states[1 + (xor(c, b) & 255)])), 4294967295)"
)

# Counterpart of ``importance_table`` in DuckDB's SQL, the crc32 included.
SQL = rf"""
WITH states AS MATERIALIZED (
  SELECT list(s ORDER BY i) AS states FROM (SELECT i, {_BYTE_STATE} AS s FROM range(256) AS t(i))
), docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents
), word AS MATERIALIZED (SELECT row_id, unnest(words) AS word FROM docs
), wanted AS MATERIALIZED (SELECT unnest({_WORDS}) AS word FROM benchmark
), bucket AS MATERIALIZED (
  SELECT word, {_CRC} % {BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM (SELECT word FROM word UNION ALL SELECT word FROM wanted)), states
), s AS (SELECT bucket, count(*) AS s FROM word JOIN bucket USING (word) GROUP BY 1
), t AS (SELECT bucket, count(*) AS t FROM wanted JOIN bucket USING (word) GROUP BY 1
), gain AS (
  SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM word) + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), mean AS (
  SELECT row_id, CAST((sum(gain) - ((sum(gain) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS weight
  FROM word JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY row_id
), scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN mean USING (row_id)
), noisy AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= {MIN_WORDS} DESC, score DESC, doc_id NULLS LAST) AS place FROM noisy
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= {PERCENT} * (SELECT count(*) FROM noisy WHERE n_features >= {MIN_WORDS}) // 100 THEN place END AS rank
FROM placed
"""
