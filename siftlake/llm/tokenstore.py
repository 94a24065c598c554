"""Token ids in binary shards with a minimal perfect hash index from document keys to offsets.

A store is a folder:

- ``ids/<shard>-<attempt>.ids``: nothing but the ids of the shard's documents, little-endian unsigned
  16-bit integers (32-bit where the vocabulary needs them), in ascending doc_id order (NULL first).
- ``ids/<shard>-<attempt>.mph``: the index, see ``pack_index``: for each distinct key, at the place its
  perfect hash names, a fingerprint and the first of its documents.
- ``manifest``: a Parquet table with the shards that count: file, documents, ids, ids before it, keys.

A task writes under a name of its own and reports it; only reported shards are in the manifest, so a
repeated or lost task leaves no trace in what readers see. Rows with one doc_id are stored one after
the other and a lookup returns all of them. NULL keys are stored and read, but not found by lookups.
NULL text counts as empty: it has only the end id.
"""

import json
import os
import re
import uuid
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .frames import HELD, prepare, tidy
from .perfecthash import PerfectHash, fingerprint

END_ID = 0
# Text bytes of a shard, about; a task holds one shard's ids in memory when it reads.
SHARD_BYTES = 32 << 20
# Encoded pieces of one generation; a worker process remembers two of them, also for its later tasks.
MEMO_PIECES = 200_000
_SUB_BATCH_CHARS = 1 << 18
# Pieces of one blank and letters are encoded this many at a time, as one text.
_JOINED = 512

# A text is cut only where the byte-level pre-tokenizer always cuts too, so that equal pieces have
# equal ids wherever they stand: before a blank that a letter follows, and between a letter and a
# character that is none. Exceptions stay in one piece: an apostrophe before letters, and a run of
# white space that does not end in a blank. Texts with other characters are not cut at all.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿªµº"
_PIECE = re.compile(
    rf" ?[{_LETTERS}]+(?:'[{_LETTERS}]+)*|[^{_LETTERS}]*(?:'|\s[^\S ])[{_LETTERS}]+|[^{_LETTERS}]+?(?= ?[{_LETTERS}]|\Z)"
)
_UNCUT = re.compile("[^\x00-\x1b\x20-\x84\x86-ÿ]")


class Encoder:
    """Ids of whole texts; pieces are encoded by the tokenizers library and remembered.

    When the remembered pieces are many they become the older generation, which gives back those met again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        state = json.loads(self.tokenizer.to_str())
        before = state["pre_tokenizer"] or {}
        self.cuts = (
            state["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before["add_prefix_space"]
        )
        self.special = [t["content"] for t in state["added_tokens"]]
        self.after_blank = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.after_blank[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("Ġ")]] = True
        self.memo, self.older = {}, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _remember(self, pieces: set[str]) -> None:
        """Encode pieces not met before. Joined pieces part again where an id begins with a blank."""
        plain = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        other = list(pieces.difference(plain))
        groups = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        for group, ids in zip(groups, self._encode(["".join(g) for g in groups])):
            ids = np.frombuffer(ids, self.dtype)
            parts = np.split(ids, np.flatnonzero(self.after_blank[ids])[1:])
            if len(parts) == len(group):
                self.memo.update(zip(group, (p.tobytes() for p in parts)))
            else:
                other += group
        self.memo.update(zip(other, self._encode(other)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes, without an end id."""
        out, cut, whole = [b""] * len(texts), {}, []
        for i, text in enumerate(texts):
            if not self.cuts or _UNCUT.search(text) or any(s in text for s in self.special):
                whole.append(i)
            else:
                cut[i] = _PIECE.findall(text)
        if len(self.memo) > MEMO_PIECES:
            self.memo, self.older = {}, self.memo
        # Not a set difference: that would go through the whole memo each time.
        new = {p for p in set().union(*cut.values()) if p not in self.memo}
        again = {p: self.older[p] for p in new if p in self.older}
        self.memo.update(again)
        self._remember(new.difference(again))
        for i, pieces in cut.items():
            out[i] = b"".join(map(self.memo.__getitem__, pieces))
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


HELD["tokenstore"] = _encoder.cache_clear


def _sub_batches(texts: list[str]):
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= _SUB_BATCH_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def pack_index(keys: np.ndarray, nulls: int, counts: np.ndarray, width: int) -> bytes:
    """Index of a shard: ``keys`` in file order without the first ``nulls`` documents, and ids per document."""
    distinct, first, repeats = np.unique(keys, return_index=True, return_counts=True)
    table = PerfectHash.build(distinct)
    place = table.find(distinct)
    slots = {
        "mark": np.zeros(len(distinct), np.uint32), "first": np.zeros(len(distinct), np.int64),
        "repeats": np.zeros(len(distinct), np.int64),
    }
    slots["mark"][place] = fingerprint(distinct)
    slots["first"][place] = first + nulls
    slots["repeats"][place] = repeats
    arrays = {
        "sizes": table.sizes, "bits": table.bits, "ranks": table.ranks, **slots, "keys": keys,
        "offsets": np.concatenate(([0], np.cumsum(counts))).astype(np.int64),
    }
    head = {"width": width, "nulls": nulls, "arrays": [[n, a.dtype.str, len(a)] for n, a in arrays.items()]}
    head = json.dumps(head).encode()
    return len(head).to_bytes(8, "little") + head + b"".join(a.tobytes() for a in arrays.values())


class Index:
    """A shard's index as read from its file."""

    def __init__(self, packed: bytes):
        size = int.from_bytes(packed[:8], "little")
        head = json.loads(packed[8 : 8 + size])
        at = 8 + size
        for name, dtype, n in head["arrays"]:
            dtype = np.dtype(dtype)
            setattr(self, name, np.frombuffer(packed, dtype, n, at))
            at += n * dtype.itemsize
        self.nulls, self.dtype = head["nulls"], np.dtype(f"<u{head['width']}")
        self.table = PerfectHash(self.sizes, self.bits, self.ranks)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; 0 documents for a key not stored."""
        slot = self.table.find(keys)
        known = slot >= 0
        known[known] = self.mark[slot[known]] == fingerprint(keys)[known]
        first, repeats = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        # A fingerprint may agree by chance; the stored key decides.
        known[known] = self.keys[self.first[slot[known]] - self.nulls] == keys[known]
        first[known], repeats[known] = self.first[slot[known]], self.repeats[slot[known]]
        return first, repeats


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    folder: str

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/manifest")


def _write_shards(rows: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    def run(batches):
        shard = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer)
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(f"{root}/ids", recursive=True)
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        end = np.array([end_id], encoder.dtype).tobytes()
        keys, counts, nulls = [], [], 0
        with system.open_output_stream(f"{root}/ids/{name}.ids") as out:
            for batch in batches:
                ids = batch.column(0)
                nulls += ids.null_count
                keys.append(ids.drop_null().to_numpy(zero_copy_only=False))
                for part in _sub_batches(batch.column(1).fill_null("").to_pylist()):
                    for encoded in encoder.encode(part):
                        out.write(encoded)
                        out.write(end)
                        counts.append(len(encoded) // encoder.dtype.itemsize + 1)
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        if not counts:
            system.delete_file(f"{root}/ids/{name}.ids")
            return
        with system.open_output_stream(f"{root}/ids/{name}.mph") as out:
            out.write(pack_index(keys, nulls, np.array(counts, np.int64), encoder.dtype.itemsize))
        first, last = (int(keys[0]), int(keys[-1])) if len(keys) else (None, None)
        row = [shard, name, len(counts), int(sum(counts)), first, last]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    names = ["shard", "file", "n_docs", "n_tokens", "first_key", "last_key"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return rows.mapInArrow(tidy(run, "tokenstore"), "shard int, file string, n_docs long, n_tokens long, first_key long, last_key long")


def write_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> Store:
    """Encode every text and write the store; ``tokenizer`` is the path of a tokenizers file on every machine."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    # Equal ids spread over shards by their texts and splits, so that one id may have any number of rows.
    tie = docs.withColumn("tie", F.xxhash64("text")).withColumn("split", F.spark_partition_id())
    ordered = tie.repartitionByRange(shards, "doc_id", "tie", "split").sortWithinPartitions("doc_id", "tie", "text")
    written = _write_shards(ordered.select("doc_id", "text"), folder, tokenizer, end_id)
    written.write.parquet(f"{folder}/shards")
    # One row per shard: small enough for one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{folder}/shards").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return Store(spark, folder)


def _opened(folder: str, name: str) -> tuple[Index, np.ndarray]:
    system, root = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{root}/ids/{name}.mph") as f:
        index = Index(f.read())
    with system.open_input_stream(f"{root}/ids/{name}.ids") as f:
        return index, np.frombuffer(f.read(), dtype=index.dtype)


def read_digests(store: Store) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, found through the index of its shard."""
    folder = store.folder
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def digest(index, payload, base, documents, keys):
        begin, end = index.offsets[documents], index.offsets[documents + 1]
        crc = [zlib.crc32(payload[a:b].astype("<u4").tobytes()) for a, b in zip(begin, end)]
        arrays = [keys, pa.array(base + begin), pa.array(end - begin), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                index, payload = _opened(folder, name)
                yield digest(index, payload, base, np.arange(index.nulls), pa.nulls(index.nulls, pa.int64()))
                distinct = np.unique(index.keys)
                for i in range(0, len(distinct), 4096):
                    keys = distinct[i : i + 4096]
                    first, repeats = index.find(keys)
                    within = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
                    documents = np.repeat(first, repeats) + within
                    yield digest(index, payload, base, documents, pa.array(np.repeat(keys, repeats)))

    manifest = store.manifest().select("file", "start")
    tasks = manifest.repartition(max(1, manifest.count()))
    return tasks.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(store: Store, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id and ids of every stored document of the given keys; unknown keys give no row.

    Keys meet the few shards whose key range covers them, and each shard is opened once.
    """
    folder = store.folder
    ranges = store.manifest().where("first_key is not null").select("file", "first_key", "last_key")
    wanted = keys.select(F.col(key).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    joined = wanted.join(F.broadcast(ranges), F.col("doc_id").between(F.col("first_key"), F.col("last_key")))

    def run(table):
        index, payload = _opened(folder, table["file"][0].as_py())
        wanted = table["doc_id"].to_numpy()
        first, repeats = index.find(wanted)
        ids, rows = [], []
        for doc, start, n in zip(wanted, first, repeats):
            for d in range(start, start + n):
                rows.append(doc)
                ids.append(payload[index.offsets[d] : index.offsets[d + 1]].astype(np.int64))
        return pa.table({"doc_id": pa.array(rows, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})

    return joined.groupBy("file").applyInArrow(run, "doc_id long, ids array<long>")
