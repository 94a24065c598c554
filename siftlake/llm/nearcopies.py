"""Near-copies by SuperMinHash signatures, banding, exact verification and grouping.

A text's set holds the distinct sequences of five words; a text with fewer words is one sequence, a
text without words has an empty set and is linked with nothing. Two documents are linked when
100 * |A and B| >= 75 * |A or B|, counted on their full sets.

1. *Signature.* Every element draws a random permutation of the registers (a Fisher-Yates shuffle
   seeded by its hash) and offers round + uniform value to the register that the round names. A text
   stops at the first round in which all its registers are filled: no later round can lower one. The
   shared permutation makes registers negatively correlated, hence less variance than independent
   minima.
2. *Copies.* Documents with equal sets are collapsed to their smallest id; their links need no search.
3. *Banding.* Equal bands put documents into a bucket. Nobody lists all pairs of a bucket: each member
   is compared with the bucket's smallest id first. Linked members then share a component, so only
   members of other components are compared further, in blocks, until their components are joined.
4. *Verification.* Pairs whose signatures agree in at least ``PRUNE`` of the registers are checked on
   full sets computed from whole texts.
5. *Grouping.* Union-find inside partitions, then alternating large-star and small-star steps, each
   written to the shared folder.

With 32 bands of 4 registers a pair at exactly 0.75 shares no bucket with probability 5e-6; with
independent registers it falls below the signature cut of ``PRUNE`` with probability 5e-7.

Defined results: NULL text counts as empty. A NULL doc_id is linked with nothing: its component is
NULL and it is kept. Rows with one doc_id are one document, linked by each of its texts; every row is
returned. Columns besides doc_id and text are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textblocks as tb
from .frames import checked_broadcast, free_name, prepare, stored, tidy

WIDTH = 5
REGISTERS = 128
BANDS = 32
PRUNE = 0.55
NUMERATOR, DENOMINATOR = 75, 100
# Members of one bucket, and elements of their sets, compared in one task against as many others.
BLOCK_MEMBERS = 1024
BLOCK_ELEMENTS = 400_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _stream(i: int) -> np.uint64:
    """Offset of the i-th random draw of an element."""
    return np.uint64(int(_GOLD) * i % (1 << 64))


def shingle_sets(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block, one after the other, and their bounds."""
    data = tb.lower_ascii(block.data)
    words = tb.words(block)
    hashes = tb.span_hashes(data, words.starts, words.ends)
    windows, bounds = tb.window_hashes(hashes, words.bounds, WIDTH)
    sets = []
    for i in range(len(block)):
        own = windows[bounds[i] : bounds[i + 1]]
        if not len(own) and words.bounds[i] < words.bounds[i + 1]:
            own = np.array([tb.sequence_hash(hashes[words.bounds[i] : words.bounds[i + 1]])], dtype=np.uint64)
        sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(sizes)))


def superminhash(elements: np.ndarray, bounds: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (texts x registers) of sets of hashes; a register no element reached is infinite.

    All texts of a block advance round by round; in each round only the elements of texts with an
    open register take part.
    """
    texts = len(bounds) - 1
    sizes = np.diff(bounds)
    signature = np.full(texts * registers, np.inf)
    owner = np.repeat(np.arange(texts), sizes)
    permutation = None
    for j in range(registers):
        draw = tb.mix(elements + _stream(2 * j + 1))
        k = j + (tb.mix(elements + _stream(2 * j + 2)) % np.uint64(registers - j)).astype(np.int64)
        if permutation is None:
            named = k
        else:
            row = np.arange(len(elements))
            named = permutation[row, k].astype(np.int64)
            permutation[row, k] = permutation[:, j]
        value = j + (draw >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        np.minimum.at(signature, owner * registers + named, value)
        still = np.isinf(signature.reshape(texts, registers)).any(axis=1)[owner]
        if not still.any():
            break
        if permutation is None:
            elements, owner, k = elements[still], owner[still], k[still]
            permutation = np.tile(np.arange(registers, dtype=np.uint8 if registers <= 256 else np.uint16), (len(elements), 1))
            permutation[np.arange(len(elements)), k] = 0
        elif not still.all():
            elements, owner, permutation = elements[still], owner[still], permutation[still]
    return signature.reshape(texts, registers)


def _profile_batch(texts: pa.Array) -> list[pa.Array]:
    n_shingles, mark1, mark2, bands, signatures = [], [], [], [], []
    rows = REGISTERS // BANDS
    steps = tb.mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    for block in tb.blocks(texts):
        elements, bounds = shingle_sets(block)
        n_shingles.append(np.diff(bounds))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tb.mix(elements), dtype=np.uint64)))
        mark1.append(sums[bounds[1:]] - sums[bounds[:-1]])
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tb.mix(elements ^ _GOLD), dtype=np.uint64)))
        mark2.append(sums[bounds[1:]] - sums[bounds[:-1]])
        bits = tb.mix(superminhash(elements, bounds).view(np.uint64))
        signatures.append((bits >> np.uint64(48)).astype("<u2"))
        keys = (bits.reshape(len(bits), BANDS, rows) * steps).sum(axis=2, dtype=np.uint64)
        bands.append(tb.mix(keys + np.arange(BANDS, dtype=np.uint64) * _GOLD))
    if not bands:
        return [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())]
    signature = np.concatenate(signatures)
    keys = np.concatenate(bands)
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * BANDS
    return [
        pa.array(np.concatenate(n_shingles)),
        pa.array(np.concatenate(mark1).view(np.int64)),
        pa.array(np.concatenate(mark2).view(np.int64)),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64))),
        pa.array([s.tobytes() for s in signature], pa.binary()),
    ]


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, set size, two marks of the whole set, band keys and the signature's registers as 16-bit values."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_profile_batch(batch.column(1))], names=names)

    schema = "doc_id long, n_shingles long, mark1 long, mark2 long, bands array<long>, signature binary"
    names = ["doc_id", "n_shingles", "mark1", "mark2", "bands", "signature"]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def agreement(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Share of equal registers of pairs of signatures."""
    def registers(column):
        return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), REGISTERS)

    if not len(left):
        return np.zeros(0)
    return (registers(left) == registers(right)).mean(axis=1)


def similar_signatures(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (left, right) whose set sizes and signatures allow a link."""
    def run(batches):
        for batch in batches:
            near = agreement(batch.column("left_signature"), batch.column("right_signature")) >= PRUNE
            yield pa.RecordBatch.from_arrays(
                [batch.column("left").filter(pa.array(near)), batch.column("right").filter(pa.array(near))],
                names=["left", "right"],
            )

    side = {
        name: reps.select(
            F.col("node").alias(name), F.col("n_shingles").alias(f"{name}_size"), F.col("signature").alias(f"{name}_signature")
        )
        for name in ("left", "right")
    }
    fits = F.least("left_size", "right_size") * DENOMINATOR >= F.greatest("left_size", "right_size") * NUMERATOR
    both = pairs.join(side["left"], "left").join(side["right"], "right").where(fits)
    return both.select("left", "right", "left_signature", "right_signature").mapInArrow(tidy(run), "left long, right long")


def _set_list(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for block in tb.blocks(texts):
        elements, bounds = shingle_sets(block)
        out += [elements[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _slices(batch: pa.RecordBatch, names):
    """Parts of a batch with at most about ``tb.BLOCK_BYTES`` in the named columns, or one row."""
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for n in names)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + tb.BLOCK_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _texts_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and text of the given nodes."""
    needed = stored(nodes.select("node").distinct(), "near-needed")
    return texts.join(checked_broadcast(needed), "node", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold, computed from the whole texts of both."""
    def run(batches):
        for batch in (part for whole in batches for part in _slices(whole, ("left_text", "right_text"))):
            both = zip(_set_list(batch.column("left_text")), _set_list(batch.column("right_text")))
            linked = pa.array([_linked(a, b) for a, b in both], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("left").filter(linked), batch.column("right").filter(linked)], names=["left", "right"]
            )

    rows = _texts_of(pairs.select(F.explode(F.array("left", "right")).alias("node")), texts)
    left = rows.select(F.col("node").alias("left"), F.col("text").alias("left_text"))
    right = rows.select(F.col("node").alias("right"), F.col("text").alias("right_text"))
    joined = pairs.join(left, "left").join(right, "right")
    return joined.select("left", "right", "left_text", "right_text").mapInArrow(tidy(run), "left long, right long").distinct()


class _Roots:
    """Union-find with the smallest member as root; unknown members are their own root."""

    def __init__(self):
        self.parent = {}

    def __call__(self, x: int) -> int:
        parent = self.parent
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self(a), self(b)
        self.parent[max(a, b)] = min(a, b)


def _local_union(edges: DataFrame) -> DataFrame:
    """Union-find over the edges of each partition: every node with its partition's smallest root."""
    def run(batches):
        roots = _Roots()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                roots.join(a, b)
        nodes = list(roots.parent)
        for i in range(0, len(nodes), 50_000):
            own = nodes[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([roots(x) for x in own], pa.int64())], names=["a", "b"]
            )

    return edges.mapInArrow(tidy(run), "a long, b long").where("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    moved = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    kept = joined.select(moved.alias("a"), F.col("m").alias("b"))
    return kept.union(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge with the smallest node it reaches.

    ``edges`` has two long columns. Ends when a round changes nothing; each round is a stored table.
    """
    edges = edges.toDF("a", "b").where("a <> b")
    now = stored(_local_union(edges), "near-edges")
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row == state:
            break
        state = row
        now = stored(_small_star(_large_star(now)), "near-edges")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _members(reps: DataFrame) -> DataFrame:
    """Buckets of at least two sets: band, bucket, node, set size, and the bucket's smallest node, members and elements."""
    members = reps.select(F.posexplode("bands").alias("band", "bucket"), "node", "n_shingles")
    buckets = members.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("elements")
    )
    return members.join(buckets.where("size > 1"), "bucket")


def _remaining_links(members: DataFrame, labels: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join components inside buckets spanning several, besides those with the leader.

    Members outside the leader's component are compared with all members, block against block. A pair
    is looked at in the first band it shares only, and not once its components are joined in the task,
    so a task returns fewer links than it has members.
    """
    def compare(table):
        node, component = table["node"].to_numpy(), table["component"].to_numpy()
        registers = np.frombuffer(b"".join(table["signature"].to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
        sets, roots = _set_list(table["text"].combine_chunks()), _Roots()
        band = table["band"][0].as_py()
        size = table["n_shingles"].to_numpy()
        query = table["side"].to_numpy() == 0
        targets = np.flatnonzero(~query)
        left, right = [], []
        for i in np.flatnonzero(query):
            near = (component[targets] != component[i]) & (node[targets] != node[i])
            near &= np.minimum(size[targets], size[i]) * DENOMINATOR >= np.maximum(size[targets], size[i]) * NUMERATOR
            near = targets[near]
            equal = registers[near] == registers[i]
            first = equal.reshape(len(near), BANDS, REGISTERS // BANDS).all(axis=2).argmax(axis=1)
            for j in near[(equal.mean(axis=1) >= PRUNE) & (first == band)]:
                a, b = component[i], component[j]
                if roots(a) != roots(b) and _linked(sets[i], sets[j]):
                    roots.join(a, b)
                    left.append(min(node[i], node[j]))
                    right.append(max(node[i], node[j]))
        return pa.table({"left": pa.array(left, pa.int64()), "right": pa.array(right, pa.int64())})

    component = F.coalesce(F.col("component"), F.col("node"))
    labelled = members.where("size > 2").join(labels, "node", "left").withColumn("component", component)
    leaders = labels.select(F.col("node").alias("leader"), F.col("component").alias("leader_component"))
    labelled = labelled.join(leaders, "leader", "left")
    labelled = labelled.withColumn("outside", F.col("component") != F.coalesce("leader_component", "leader"))
    outside = F.col("outside").cast("long")
    open_ = labelled.groupBy("bucket").agg(
        F.sum(outside).alias("n_outside"), F.sum(outside * F.col("n_shingles")).alias("elements_outside")
    )
    own = labelled.where("node <> leader").join(open_.where("n_outside > 0"), "bucket")
    own = stored(own.select("band", "bucket", "node", "n_shingles", "component", "outside", "size", "elements",
                            "n_outside", "elements_outside"), "near-open")

    def n_blocks(count: str, elements: str):
        return F.greatest(F.ceil(F.col(count) / BLOCK_MEMBERS), F.ceil(F.col(elements) / BLOCK_ELEMENTS))

    place = F.pmod(F.xxhash64("node"), F.lit(1 << 40))
    all_, some = n_blocks("size", "elements"), n_blocks("n_outside", "elements_outside")
    columns = ["band", "bucket", "node", "n_shingles", "component"]
    queries = own.where("outside").select(
        *columns, F.lit(0).alias("side"), F.pmod(place, some).alias("query_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), all_ - 1)).alias("block"),
    )
    targets = own.select(
        *columns, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), some - 1)).alias("query_block"),
        F.pmod(place, all_).alias("block"),
    )
    known = _texts_of(own, texts).join(reps.select("node", "signature"), "node")
    both = queries.union(targets).join(known, "node")
    return both.groupBy("bucket", "query_block", "block").applyInArrow(compare, "left long, right long").distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    name = "near"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = stored(profiles(docs), f"{name}-profiles")
    sets = profile.where("doc_id is not null and n_shingles > 0")
    key = ["n_shingles", "mark1", "mark2"]
    reps = stored(
        sets.groupBy(*key).agg(
            F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
        ),
        f"{name}-sets",
    )
    copies = sets.select("doc_id", *key).join(reps.select(*key, "node"), key).where("doc_id <> node")
    copies = copies.select(F.col("doc_id").alias("left"), F.col("node").alias("right"))

    members = stored(_members(reps), f"{name}-members")
    # One document's text per distinct set: any row of the set's smallest id has the same set, or is verified as such.
    first = members.where("node <> leader").select(F.col("leader").alias("left"), F.col("node").alias("right")).distinct()
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    links = stored(verified(stored(similar_signatures(first, reps), f"{name}-pairs"), texts), f"{name}-links")
    labels = stored(components(links), f"{name}-labels")
    links = links.union(stored(_remaining_links(members, labels, reps, texts), f"{name}-links"))
    labels = stored(components(links.union(copies)), f"{name}-labels")
    found = profile.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component; columns are unchanged.

    Rows with equal doc_id and text are copies of each other, too: one of them stays.
    """
    found = stored(near_copies(docs).select("doc_id", "kept"), "near-kept")
    name = free_name(docs, "near_id")
    same = F.col("doc_id").cast("long") == F.col(name)
    gone = found.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    repeated = found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(name)).count()
    repeated = stored(repeated.where("count > 1").select(name), "near-repeated")
    left = docs.join(checked_broadcast(gone), same, "left_anti")
    once = left.join(checked_broadcast(repeated), same, "left_anti")
    copies = left.join(checked_broadcast(repeated), same, "left_semi")
    return once.union(copies.dropDuplicates(["doc_id", "text"]))
