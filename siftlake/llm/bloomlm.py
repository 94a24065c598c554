"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs of the training texts are quantised: level q holds counts from the q-th
to below the (q+1)-th of the thresholds 1, 2, 3, 4, 6, 9, 13 ... (half more each). An n-gram of level q
is put into the filter once for each level 1 to q, so probing level after level until one is missing
gives its level back; a false positive can only raise it. The probability of word w after word v is

    (c(v, w) + t(v) * P(w)) / (c(v) + t(v)),  P(w) = (c(w) + 1) / (N + V + 1),  t(v) = c(v) ** SPREAD

with c the middle of the level. Texts begin after an end token and end with one.

*Counting and probing.* Texts are cut into chunks of about ``CHUNK_TOKENS`` tokens, stored as word numbers.
A chunk sends each segment of the hash space one row: its distinct n-grams there, with their counts in the
training texts. A segment's group adds the counts up, sets the bits of its own part of the filter, probes
it for every chunk that sent n-grams, and answers with one byte per n-gram and the exact counts of words.
The answers meet the stored chunks. No machine holds the whole filter or all words.

*Bounds.* More text means more segments, so a group stays at about ``SEGMENT_BYTES`` of text or one chunk.
The filter has as many bits as the texts have bytes (a power of two); a segment whose n-grams would fill
it beyond half gets more, so no n-gram is ever left out.

Defined results: NULL text is empty, which is one end token. With no training text N and V are 0.
Repeated rows are counted and scored each.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from . import textblocks as tb
from .frames import free_name, prepare, remainder, stored

END = np.uint64(0x1F83D9ABFB41BD6B)
_PAIR, _WORD = np.uint64(0x510E527FADE682D1), np.uint64(0x9B05688C2B3E6C1F)

# No longer a bound; callers name it.
MAX_WORDS = 5_000_000
SEGMENT_BYTES = 16 << 20
SPREAD = 0.9
PROBES = 3
# Bits of a hash beyond those that name its segment.
_REST = 40
CHUNK_TOKENS = 1_500_000


def thresholds(most: int = 1 << 62) -> np.ndarray:
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, dtype=np.int64)


THRESHOLDS = thresholds()
# Middle of each level; level 0 is a count of 0.
LEVEL_COUNTS = np.concatenate(([0.0], np.sqrt(THRESHOLDS[:-1].astype(float) * (THRESHOLDS[1:] - 1))))


def levels(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, counts, side="right")


def tokens(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each text of a block, its end token last, and their bounds."""
    words = tb.words(block)
    hashes = tb.span_hashes(tb.lower_ascii(block.data), words.starts, words.ends)
    out = np.insert(hashes, words.bounds[1:], END)
    return out, words.bounds + np.arange(len(words.bounds))


def _previous(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each token; the end token before a text's first."""
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[bounds[:-1]] = END
    return before


def _pairs(before: np.ndarray, found: np.ndarray) -> np.ndarray:
    return tb.mix(before * np.uint64(0xD6E8FEB86659FD93) + found + _PAIR)


def _word_key(found: np.ndarray) -> np.ndarray:
    return tb.mix(found ^ _WORD)


@dataclass(frozen=True)
class Shape:
    """Least bits of the filter and number of segments, both powers of two."""

    bits: int
    segments: int

    @classmethod
    def of(cls, text_bytes: int) -> "Shape":
        def power(x):
            return 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))

        bits = max(1 << 16, power(text_bytes))
        return cls(bits, min(power(-(-text_bytes // SEGMENT_BYTES)) * 2, bits >> 10))

    def split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segment of each hash, and the next 40 bits."""
        own = int(self.segments).bit_length() - 1
        if not own:
            return np.zeros(len(hashes), np.int64), hashes >> np.uint64(64 - _REST)
        segment = (hashes >> np.uint64(64 - own)).astype(np.int64)
        return segment, (hashes >> np.uint64(64 - own - _REST)) & np.uint64((1 << _REST) - 1)


def places(rest: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    """Bit within a segment of ``size`` bits for each n-gram at a level."""
    seed = np.uint64((level * 0xC2B2AE3D27D4EB4F + (probe + 1) * 0x165667B19E3779F9) % (1 << 64))
    return (tb.mix(rest + seed) % np.uint64(size)).astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not any(len(values) for values, _ in parts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.add.reduceat(counts, first)


def segment_bits(shape: Shape, words: np.ndarray, word_counts, pairs: np.ndarray, pair_counts) -> np.ndarray:
    """The filter of one segment, packed: all its n-grams, with as many bits as keep it at most half full."""
    rest = np.concatenate((shape.split(_word_key(words))[1], pairs))
    level = np.concatenate((levels(word_counts), levels(pair_counts)))
    size = max(shape.bits // shape.segments, int(np.ceil(level.sum() * PROBES / np.log(2))))
    size = -(-size // 8) * 8
    bits = np.zeros(size, dtype=bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        rest, level = rest[level >= q], level[level >= q]
        for probe in range(PROBES):
            bits[places(rest, q, probe, size)] = True
    return np.packbits(bits)


@dataclass(frozen=True)
class Model:
    """One segment's filter, and numbers of tokens and words."""

    shape: Shape
    bits: np.ndarray
    n_tokens: int
    n_words: int

    def levels(self, rest: np.ndarray) -> np.ndarray:
        """Levels of the segment's n-grams as far as the filter knows them, by probing level after level."""
        level = np.zeros(len(rest), dtype=np.uint8)
        alive = np.arange(len(rest)) if len(self.bits) else np.zeros(0, np.int64)
        q = 0
        while len(alive) and q < len(LEVEL_COUNTS) - 1:
            q += 1
            for probe in range(PROBES):
                at = places(rest[alive], q, probe, len(self.bits) * 8)
                alive = alive[(self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            level[alive] = q
        return level

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return LEVEL_COUNTS[self.levels(self.shape.split(hashes)[1])]


def _by_segment(shape: Shape, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of words by segment, and the segments in that order."""
    segment = shape.split(_word_key(words))[0]
    order = np.argsort(segment, kind="stable")
    return order, segment[order]


def _packed(values: np.ndarray) -> bytes:
    """32-bit values, compressed with equal bytes together."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], n * 4, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _batches(rows, schema: pa.Schema, n: int):
    """Tuples as record batches of at most ``n`` rows."""
    rows = list(rows)
    for i in range(0, len(rows), n):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + n]), schema)], schema=schema)


def _schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in types.items()])


_BIN = pa.binary()
_CHUNKS = _schema(chunk=pa.int64(), asks=pa.bool_(), rows=_BIN, place=_BIN, lengths=_BIN, words=_BIN, learns=_BIN)
_SENT = _schema(
    chunk=pa.int64(), asks=pa.bool_(), segment=pa.int32(), words=_BIN, word_counts=_BIN, low=_BIN, high=_BIN, pair_counts=_BIN
)
_ANSWERS = _schema(
    segment=pa.int32(), chunk=pa.int64(), n_words=pa.int64(), n_tokens=pa.int64(), word_levels=_BIN, known=_BIN, pair_levels=_BIN
)


def _chunks(docs: DataFrame, keep: list[str], learns: str, asks: bool, first: int = 0) -> DataFrame:
    """Rows of ``_CHUNKS``: documents (the columns to keep), their tokens as numbers of the chunk's words, frequent words
    first, and which of them to learn from. Chunks are scored if ``asks``."""
    prepare(docs.sparkSession)

    def chunk_row(chunk, parts):
        rows, learning, found, bounds = zip(*parts)
        sink = pa.BufferOutputStream()
        if asks:
            with pa.ipc.new_stream(sink, rows[0].schema) as out:
                for batch in rows:
                    out.write_batch(batch)
        words, place, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        lengths = np.concatenate([np.diff(b) for b in bounds])
        learning = np.concatenate(learning).astype(np.uint8).tobytes()
        return chunk, asks, sink.getvalue().to_pybytes(), _packed(rank[place]), _packed(lengths), words[order].tobytes(), learning

    def run(batches):
        chunk, parts, held = first + (TaskContext.get().partitionId() << 32), [], 0
        for batch in batches:
            learning = batch.column(learns).to_numpy(zero_copy_only=False)
            for block in tb.blocks(batch.column("text")):
                found, bounds = tokens(block)
                own = slice(block.first, block.first + len(block))
                parts.append((batch.select(keep).slice(block.first, len(block)), learning[own], found, bounds))
                held += len(found)
                if held >= CHUNK_TOKENS:
                    yield from _batches([chunk_row(chunk, parts)], _CHUNKS, 1)
                    chunk, parts, held = chunk + 1, [], 0
        if parts:
            yield from _batches([chunk_row(chunk, parts)], _CHUNKS, 1)

    return docs.mapInArrow(run, from_arrow_schema(_CHUNKS))


@dataclass
class _Chunk:
    """A stored chunk, its distinct words and pairs, and the place of each token's."""

    words: np.ndarray
    place: np.ndarray
    bounds: np.ndarray
    pairs: np.ndarray
    pair_place: np.ndarray

    @classmethod
    def of(cls, row: dict) -> "_Chunk":
        words, place = np.frombuffer(row["words"], np.uint64), _unpacked(row["place"])
        bounds = np.concatenate(([0], np.cumsum(_unpacked(row["lengths"]))))
        found = words[place]
        return cls(words, place, bounds, *np.unique(_pairs(_previous(found, bounds), found), return_inverse=True))


def _sent(chunks: DataFrame, shape: Shape) -> DataFrame:
    """Rows of ``_SENT``: each chunk's distinct words and rests of pairs, by segment, with their counts in training texts."""
    def rows(row):
        chunk = _Chunk.of(row)
        learned = np.repeat(np.frombuffer(row["learns"], np.uint8) == 1, np.diff(chunk.bounds))
        word_counts = np.bincount(chunk.place[learned], minlength=len(chunk.words))
        pair_counts = np.bincount(chunk.pair_place[learned], minlength=len(chunk.pairs))
        order, word_segment = _by_segment(shape, chunk.words)
        words, word_counts = chunk.words[order], word_counts[order]
        segment, rest = shape.split(chunk.pairs)
        edges = [np.searchsorted(x, np.arange(shape.segments + 1)) for x in (word_segment, segment)]
        for s in np.flatnonzero(np.diff(edges[0]) + np.diff(edges[1])):
            w, p = (slice(e[s], e[s + 1]) for e in edges)
            yield (
                row["chunk"], row["asks"], int(s), words[w].tobytes(), word_counts[w].astype("<u4").tobytes(),
                rest[p].astype("<u4").tobytes(), (rest[p] >> np.uint64(32)).astype("<u1").tobytes(), pair_counts[p].astype("<u4").tobytes(),
            )

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _batches(rows(batch.slice(i, 1).to_pylist()[0]), _SENT, 64)

    columns = [n for n in _CHUNKS.names if n != "rows"]
    return chunks.select(*columns).mapInArrow(run, from_arrow_schema(_SENT))


def _answered(sent: DataFrame, shape: Shape) -> DataFrame:
    """Rows of ``_ANSWERS``: for each segment its numbers of words and tokens (no chunk), and what it answers each chunk."""
    def answer(table):
        asking, words, pairs = [], [], []
        for batch in table.to_batches():
            for row in batch.to_pylist():
                own = np.frombuffer(row["words"], np.uint64)
                rest = np.frombuffer(row["low"], "<u4").astype(np.uint64)
                rest |= np.frombuffer(row["high"], "<u1").astype(np.uint64) << np.uint64(32)
                for kind, values, n in ((words, own, "word_counts"), (pairs, rest, "pair_counts")):
                    n = np.frombuffer(row[n], "<u4").astype(np.int64)
                    kind.append((values[n > 0], n[n > 0]))
                if row["asks"]:
                    asking.append((row["chunk"], own, rest))
        (words, word_counts), (pairs, pair_counts) = _summed(words), _summed(pairs)
        model = Model(shape, segment_bits(shape, words, word_counts, pairs, pair_counts), 0, 0)
        segment = table["segment"][0].as_py()
        out = [(segment, None, len(words), int(word_counts.sum()), None, None, None)]
        for chunk, own, rest in asking:
            known = _looked_up(words, word_counts, own).tobytes()
            own_levels = model.levels(shape.split(_word_key(own))[1])
            out.append((segment, chunk, 0, 0, own_levels.tobytes(), known, model.levels(rest).tobytes()))
        return pa.Table.from_batches(_batches(out, _ANSWERS, len(out)))

    return stored(sent.groupBy("segment").applyInArrow(answer, from_arrow_schema(_ANSWERS)), "lm-segments")


def _looked_up(words: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of the wanted words among sorted words; 0 where there is none."""
    if not len(words):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
    return np.where(words[at] == wanted, counts[at], 0).astype(np.int64)


def scores(docs: DataFrame, training: DataFrame, max_words: int | None = None) -> DataFrame:
    """Every row with n_tokens, n_known, train_tokens, base_score and score; ``training`` has the texts to learn from.

    ``max_words`` has no effect any more: exact word counts come with the answers, however many words there are.
    """
    learns = free_name(docs, "learns")
    apart = training.select("text", F.lit(True).alias("learns"))
    return _scored(docs.withColumn(learns, F.lit(False)), docs.columns, learns, apart)


def _scored(docs: DataFrame, columns: list[str], learns: str, apart: DataFrame | None = None) -> DataFrame:
    """The scores beside some columns of the documents; learnt from the rows with ``learns`` and all of ``apart``."""
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    shape = Shape.of(sum(df.agg(size).first()[0] for df in (docs, apart) if df is not None))
    fields = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    new = StructType.fromDDL(fields)
    kept = [f for f in docs.select(*columns).schema.fields if f.name not in set(new.names)]
    keep = [f.name for f in kept]
    chunks = _chunks(docs, keep, learns, True)
    if apart is not None:
        chunks = chunks.union(_chunks(apart, [], "learns", False, 1 << 62))
    chunks = stored(chunks, "lm-chunks")
    answers = _answered(_sent(chunks, shape), shape)
    n_words, n_tokens = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()

    def finish(body, answers):
        body = body.to_pylist()[0]
        rows, chunk = pa.ipc.open_stream(body["rows"]).read_all(), _Chunk.of(body)
        order, begins = _by_segment(shape, chunk.words)[0], chunk.bounds[:-1]
        answers = sorted(answers.to_pylist(), key=lambda a: a["segment"])

        def joined(name, kind):
            return np.frombuffer(b"".join(a[name] for a in answers), kind)

        level, known = np.empty(len(order), np.uint8), np.empty(len(order), np.int64)
        level[order], known[order] = joined("word_levels", np.uint8), joined("known", np.int64)
        together = LEVEL_COUNTS[joined("pair_levels", np.uint8)][chunk.pair_place]
        count = LEVEL_COUNTS[level]
        own = count[chunk.place]
        context = np.concatenate(([0.0], own[:-1]))
        context[begins] = count[np.flatnonzero(chunk.words == END)]
        base = np.log10((known + 1) / (n_tokens + n_words + 1))
        lengths = np.diff(chunk.bounds)
        columns = [
            pa.array(lengths), pa.array(np.add.reduceat((known > 0)[chunk.place].astype(np.int64), begins)),
            pa.array(np.full(len(lengths), n_tokens), pa.int64()), pa.array(np.add.reduceat(base[chunk.place], begins)),
            pa.array(np.add.reduceat(log10(own, context, together, n_tokens, n_words), begins)),
        ]
        return pa.Table.from_arrays([rows[n] for n in keep] + columns, names=keep + new.names)

    bodies = chunks.where("asks").select("chunk", "rows", "place", "lengths", "words")
    found = answers.where("chunk is not null").select("chunk", "segment", "word_levels", "known", "pair_levels")
    return bodies.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(finish, StructType(kept + list(new.fields)))


def log10(own, context, together, n_tokens: int, n_words: int) -> np.ndarray:
    """log10 P(token | token before) from the counts of the token, the token before and the pair."""
    together = np.minimum(together, np.minimum(own, context))
    p = (own + 1) / (n_tokens + n_words + 1)
    spread = np.maximum(context, 1) ** SPREAD
    return np.log10(np.minimum((together + spread * p) / (context + spread), 1))


def score_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, token counts, base score and model score of every document."""
    held_out = remainder("doc_id", 7) == 2
    rows = docs.select("doc_id", held_out.alias("held_out"), "text", (~held_out).alias("learns"))
    return _scored(rows, ["doc_id", "held_out"], "learns")
