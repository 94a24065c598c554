"""Mixing sources to target weights with pivotal dependent rounding, in DataFrame operations only.

A source's weight follows from its rank by code point (NULL last): the given weights, repeating. The
total size is shared out by weight; a source stops at ``MAX_COPIES`` times its size and the excess is
reshared by weight among the others until none is above.

A document of a source with target T and size S is wanted f = T / S times. It is taken floor(f) times
for certain; the fraction p is rounded dependently. Two fractions meet in a duel: size-weighted mass
moves from one to the other until one of them is 0 or 1, in the direction drawn so that each keeps its
expected value. The other one goes on with what is left. The one fraction left at the end of a source
goes to the nearer whole number: its taken size is at most half that document's size off its target.

Duels run inside blocks of about ``BLOCK`` documents of one source: every document but one of a block
becomes integral. The ones left form the next level's blocks, so log(rows) / log(BLOCK) levels reduce
any source, and a source with most of the rows is many blocks. Every level is a stored table.

All draws are hashes of a seed and the documents' keys: reruns agree.

Defined results: NULL text has size 0 and a document of size 0 is taken once if its source has any
target, as it moves nothing. Rows equal in doc_id, source and size are one unit: they share one
decision and are taken equally often. A source of size 0 has target 0.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import checked_broadcast, free_name, stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK = 256
WORD = r"[^\x20\x09-\x0D]+"
_EXACT = 1e-9


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size and target, from a table with one row (source, source_size) per source.

    Sources in order of size per weight reach their limit first. The level at which exactly those
    below it are full is found with running sums over this table of sources.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    ratio = F.col("limit") / F.col("weight")
    upto = everything.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1))
        .withColumn("limit", F.lit(float(max_copies)) * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("full", F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
        .withColumn("full_weight", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_weight") - F.col("full_weight")))
    )
    # The first source, in that order, whose limit lies above the level sets it.
    level = F.min_by(F.when(ratio >= F.col("level"), F.col("level")), F.when(ratio >= F.col("level"), ratio)).over(everything)
    target = F.least(F.col("limit"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return shares.select("source", "source_size", target.alias("target"))


def _uniform(*columns) -> Column:
    """A draw in [0, 1) that depends on the given values only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def _unit(u: Column, p: Column) -> Column:
    """A document with a fraction of a copy: ``mass`` is the size it moves when the fraction goes from 0 to 1."""
    return F.struct(u["doc_id"].alias("doc_id"), u["size"].alias("size"), u["mass"].alias("mass"), p.alias("p"))


def _duel(state: Column, u: Column) -> Column:
    """The carried document meets the next: one becomes integral and is done, the other is carried on."""
    left = state["left"]
    give = F.least(left["p"] * left["mass"], (1 - u["p"]) * u["mass"])
    take = F.least((1 - left["p"]) * left["mass"], u["p"] * u["mass"])
    gives = u["draw"] * (give + take) < take
    a = F.when(gives, left["p"] - give / left["mass"]).otherwise(left["p"] + take / left["mass"])
    b = F.when(gives, u["p"] + give / u["mass"]).otherwise(u["p"] - take / u["mass"])
    a_done = (a <= _EXACT) | (a >= 1 - _EXACT)
    met = F.struct(
        F.when(a_done, _unit(u, b)).otherwise(_unit(left, a)).alias("left"),
        F.concat(state["done"], F.array(F.when(a_done, _unit(left, F.round(a))).otherwise(_unit(u, F.round(b))))).alias("done"),
    )
    return F.when(left.isNull(), F.struct(_unit(u, u["p"]).alias("left"), state["done"].alias("done"))).otherwise(met)


def _reduced(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree: per block the documents decided in its duels and the one left."""
    kind = "struct<doc_id:bigint,size:bigint,mass:double,p:double>"
    start = F.struct(F.lit(None).cast(kind).alias("left"), F.array().cast(f"array<{kind}>").alias("done"))
    key = ["source", "doc_id", "size"]
    counts = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).withColumnRenamed("source", "_source")
    blocked = units.join(checked_broadcast(counts), F.col("source").eqNullSafe(F.col("_source")))
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *key), "blocks"))
    entry = F.struct(
        F.xxhash64(F.lit(seed + 1), F.lit(level), *key).alias("order"), "doc_id", "size", "mass", "p",
        _uniform(F.lit(seed + 2), F.lit(level), *key).alias("draw"),
    )
    grouped = blocked.groupBy("source", "block").agg(F.array_sort(F.collect_list(entry)).alias("units"))
    return grouped.select("source", F.aggregate("units", start, _duel).alias("state"))


def _rounded(units: DataFrame, seed: int) -> DataFrame:
    """source, doc_id, size and extra (0 or 1) of every fractional document (doc_id, size, mass, p)."""
    decided = None
    level = 0
    while True:
        most = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        reduced = stored(_reduced(units, level, seed), "mixing-level")
        done = reduced.select("source", F.inline("state.done")).select("source", "doc_id", "size", F.col("p").alias("extra"))
        left = reduced.select("source", "state.left.*")
        if most <= BLOCK:
            done = done.union(left.select("source", "doc_id", "size", F.round("p").alias("extra")))
        decided = done if decided is None else decided.union(done)
        if most <= BLOCK:
            return decided
        units, level = left, level + 1


def copies(
    docs: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 11
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies (0 to ``max_copies``) of every row.

    ``docs`` has doc_id, source and either size or text; other columns are ignored.
    """
    size = F.col("size").cast("long") if "size" in docs.columns and "text" not in docs.columns else word_count(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    rows = stored(rows, "mixing-sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = stored(targets(per_source, weights, max_copies), "mixing-targets").withColumnRenamed("source", "_source")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.join(checked_broadcast(shares), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("wanted", wanted)
    whole = F.floor(F.col("wanted") + _EXACT)
    p = F.greatest(F.col("wanted") - whole, F.lit(0.0))
    units = rows.where((p > _EXACT) & (F.col("size") > 0)).groupBy("doc_id", "source", "size", "wanted").count()
    units = units.select("source", "doc_id", "size", (F.col("size") * F.col("count")).cast("double").alias("mass"), p.alias("p"))
    extra = _rounded(stored(units, "mixing-units"), seed)
    extra = extra.select(*[F.col(c).alias(f"_{c}") for c in extra.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "size")]
    found = rows.join(extra, same, "left")
    n = F.when(F.col("size") > 0, whole + F.coalesce("_extra", F.lit(0.0))).otherwise((F.col("wanted") > 0).cast("int"))
    return found.select("doc_id", "source", "size", "source_size", "target", n.cast("int").alias("copies"))


def mix_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return copies(docs).select("doc_id", "size", "source_size", "target", taken, "copies")


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 11) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns are unchanged."""
    decided = copies(docs.select("doc_id", "source", "text"), weights, max_copies, seed)
    decided = decided.select("doc_id", "source", "size", "copies").distinct().where("copies > 0")
    size, copy, *names = (free_name(docs, c) for c in ("size", "copy", "mix_doc_id", "mix_source", "mix_size", "mix_copies"))
    keyed = docs.withColumn(size, word_count(F.col("text")))
    same = [
        F.col("doc_id").cast("long").eqNullSafe(F.col(names[0])),
        F.col("source").cast("string").eqNullSafe(F.col(names[1])),
        F.col(size) == F.col(names[2]),
    ]
    repeated = keyed.join(decided.toDF(*names), same).withColumn(copy, F.explode(F.sequence(F.lit(1), names[3])))
    return repeated.select(*docs.columns)
