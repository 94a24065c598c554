"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A sequence of three letters is bound into one vector:
the first letter's vector rotated twice, times the second's rotated once, times the third's. The
sequences of a text are bundled (added) into the text's vector, unit vectors of texts are bundled into
the prototype of their language, and a text gets the language with the highest cosine.

Letters are case-folded; anything that is no letter ends a word, and a word is framed by one blank.
Every letter of every script has a vector of its own, drawn from a generator that its code point seeds,
so no table of letters is kept or sent.

Defined results: NULL text, empty text and text without a letter give ``und`` with score 0. With no
learned language (no training row) every text gives ``und``. Equal cosines go to the alphabetically
first language. Repeated rows are scored alike; rows are never dropped.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .frames import append_columns, prepare, remainder, tidy

UNKNOWN = "und"
BLANK = ord(" ")
DIMENSIONS = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Sequences that are bound at a time; this many vectors are in memory.
CHUNK = 4096
# A sequence that fewer than one in RARE texts of a block hold is added where it occurs, not for all texts.
RARE = 32
# A model holds one vector per language; more than this many languages is refused, as it is broadcast.
MAX_LANGUAGES = 4096


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def letter_vectors(points: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """The vector of +1 and -1 of each code point, 64 places from each number of its generator."""
    state = tb.mix(points.astype(np.uint64) + (np.uint64(seed) << np.uint64(32)))
    step = np.arange(1, -(-dimensions // 64) + 1, dtype=np.uint64) * _STEP
    bits = np.unpackbits(tb.mix(state[:, None] + step).astype("<u8").view(np.uint8), axis=1)
    return bits[:, :dimensions].astype(np.float32) * 2 - 1


def _code_points(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block and where each text begins among them."""
    points = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    starts = (block.data & 0xC0) != 0x80
    position = np.concatenate(([0], np.cumsum(starts)))
    return points, position[block.offsets]


def text_vectors(block: tb.Block, dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vector and number of letters of each text of a block (already in lower case)."""
    n = len(block)
    points, bounds = _code_points(block)
    points = np.where(_letters()[points], points, BLANK)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    letters = np.bincount(owner[points != BLANK], minlength=n)
    vectors = np.zeros((n, dimensions), dtype=np.float32)
    # A blank before each text and after the last one; runs of blanks count once.
    at = np.concatenate((bounds[:-1], [len(points)]))
    points = np.insert(points, at, BLANK)
    owner = np.insert(owner, at, np.concatenate((np.arange(n), [n - 1])))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != BLANK) | (points[:-1] != BLANK)
    points, owner = points[keep], owner[keep]
    if len(points) < 3 or not letters.any():
        return vectors, letters
    met = np.zeros(0x110000, dtype=bool)
    met[points] = True
    alphabet = np.flatnonzero(met)
    size = len(alphabet)
    place = np.zeros(0x110000, dtype=np.int64)
    place[alphabet] = np.arange(size)
    symbol = place[points]
    gram = (symbol[:-2] * size + symbol[1:-1]) * size + symbol[2:]
    middle = points[1:-1] != BLANK  # the middle is a letter: no sequence reaches from one text to another
    gram, owner = gram[middle], owner[1:-1][middle]
    own = letter_vectors(alphabet, dimensions, seed)
    first, second = np.roll(own, 2, axis=1), np.roll(own, 1, axis=1)

    def bound(grams):
        return first[grams // size**2] * second[grams // size % size] * own[grams % size]

    order = np.argsort(gram)
    starts = np.flatnonzero(np.diff(gram[order], prepend=-1))
    counts = np.diff(np.append(starts, len(order)))
    frequent = counts * RARE >= n
    chosen = np.repeat(frequent, counts)
    grams, ends, found = gram[order[starts[frequent]]], np.cumsum(counts[frequent]), owner[order[chosen]]
    for i in range(0, len(grams), CHUNK):
        part, begin = grams[i : i + CHUNK], ends[i - 1] if i else 0
        lengths = np.diff(ends[i : i + CHUNK], prepend=begin)
        cell = found[begin : begin + lengths.sum()] * len(part) + np.repeat(np.arange(len(part)), lengths)
        times = np.bincount(cell, minlength=n * len(part)).reshape(n, len(part))
        vectors += times.astype(np.float32) @ bound(part)
    rare = np.sort(order[~chosen])  # in the order of the texts
    for i in range(0, len(rare), CHUNK):
        part = rare[i : i + CHUNK]
        begin = np.flatnonzero(np.diff(owner[part], prepend=-1))
        vectors[owner[part[begin]]] += np.add.reduceat(bound(gram[part]), begin, axis=0)
    return vectors, letters


def _batch_vectors(texts: pa.Array, dimensions: int, seed: int):
    """Row of the first text, unit vectors and letter counts, block by block."""
    for block in tb.blocks(pc.utf8_lower(texts.fill_null(""))):
        vectors, letters = text_vectors(block, dimensions, seed)
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        yield block.first, vectors / np.where(norm > 0, norm, 1), letters


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prototypes: np.ndarray
    seed: int


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = 17) -> Model:
    """Bundle all given texts with a non-NULL language into one prototype per language.

    A task adds up its texts before anything is shuffled, so the driver receives one vector per language.
    """
    prepare(docs.sparkSession)

    def run(batches):
        sums = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, vectors, _ in _batch_vectors(batch.column(0), dimensions, seed):
                own = names[first : first + len(vectors)]
                for name in set(own):
                    sums[name] = sums.get(name, 0) + vectors[own == name].sum(axis=0, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["language", "vector"],
            )

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sums = rows.mapInArrow(tidy(run), "language string, vector array<double>")
    total = Summarizer.sum(array_to_vector("vector"))
    found = sums.groupBy("language").agg(vector_to_array(total).alias("vector")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = sorted(found, key=lambda r: r.language)
    prototypes = np.array([r.vector for r in found], dtype=np.float32).reshape(len(found), dimensions)
    norm = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return Model(tuple(r.language for r in found), prototypes / np.where(norm > 0, norm, 1), seed)


def predict(
    docs: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score", letters: str | None = None
) -> DataFrame:
    """Every row with its predicted language and the cosine (0 to 1) with that language's prototype.

    ``letters`` may name a further column for the number of letters of the text.
    """
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    prototypes, seed, dimensions = model.prototypes, model.seed, model.prototypes.shape[1]

    def make():
        def compute(batch):
            n = batch.num_rows
            best, cosine, counts = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n, dtype=np.int64)
            for first, vectors, n_letters in _batch_vectors(batch.column(text), dimensions, seed):
                counts[first : first + len(n_letters)] = n_letters
                if not len(prototypes):
                    continue
                found = vectors @ prototypes.T
                top = found.argmax(axis=1)
                known = n_letters > 0
                rows = first + np.flatnonzero(known)
                best[rows] = top[known]
                cosine[rows] = np.clip(found[np.arange(len(top)), top][known], 0, 1)
            columns = [pa.array(names[best], pa.string()), pa.array(cosine)]
            return columns if letters is None else [*columns, pa.array(counts)]

        return compute

    more = "" if letters is None else f", {letters} long"
    return append_columns(docs, f"{language} string, {score} double{more}", make)


def noise(model: Model) -> float:
    """Standard deviation of the cosine of a text that has nothing in common with a prototype."""
    return 1 / np.sqrt(model.prototypes.shape[1])


def language_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; learned from those not held out."""
    held_out = remainder("doc_id", 5) == 0
    model = fit(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
