"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

A rule fits its host and all subdomains if the path of the url starts with the rule's; the longest wins.
Rules are a literal map from host to paths, looked up by the suffixes of a url's host, so urls are never
joined or shuffled for them.

Trees are trained from labelled urls: a url and whether it is to be blocked. Features are lexical:
length, labels and hyphens of the host, depth, digit ratio, entropy of its bytes, number of parameters,
and how often labelled urls of the same domain (last two labels of the host) and of the same first path
segment are blocked. These suffix statistics come from one half of the labelled urls (by a hash of
the url) and the trees from the other half, so no tree sees a rate that holds its own label. Features
are small whole numbers: labelled urls with equal features become one weighted row before training, and
trees of all tables have the same thresholds to choose from. All labelled urls count; nothing is sampled.

``url_table`` has no labels of its own: its labelled urls are those that a rule judges.

Defined results: a NULL url or one without ``://`` has empty host and path, fits no rule and is judged by its
features. Without labelled urls of both kinds there is nothing to learn, and every url without a rule is
allowed. Repeated urls are judged alike and counted each. Very long urls are read whole.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import skew
from . import textblocks as tb
from .frames import append_columns, free_name, stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = ("f_length", "f_host", "f_labels", "f_hyphens", "f_depth", "f_digits", "f_entropy", "f_parameters")
STATISTICS = ("f_domain", "f_segment")
# Rates are counted as if this many more labelled urls had the overall rate.
PRIOR = 20
RATE_STEPS = 32

TREES, DEPTH, STEP = 20, 4, 0.3


@dataclass(frozen=True)
class Rule:
    """``place`` is host and path, like ``example.net/en/``."""

    place: str
    verdict: str

    @property
    def host(self) -> str:
        return self.place.split("/", 1)[0].lower()

    @property
    def path(self) -> str:
        return self.place[len(self.host) :]


RULES = (Rule("net/", BLOCK), Rule("example.net/en/", ALLOW), Rule("example.com/de/", BLOCK), Rule("org/fr/", ALLOW))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest fitting rule as (place, verdict), NULL if none fits."""
    by_host = {}
    for rule in sorted(rules, key=lambda r: (-len(r.place), r.place)):
        by_host.setdefault(rule.host, []).append(rule)

    def entry(rule):
        fields = ("path", rule.path), ("place", rule.place), ("verdict", rule.verdict)
        return F.struct(F.lit(-len(rule.place)).alias("order"), *[F.lit(v).alias(n) for n, v in fields])

    if not by_host:
        return F.lit(None).cast("struct<place: string, verdict: string>")
    known = F.create_map(*[x for name, group in by_host.items() for x in (F.lit(name), F.array(*map(entry, group)))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # A host of very many labels has no more fitting suffixes than there are rule hosts.
    named = F.filter(suffixes, lambda s: F.map_contains_key(known, s))
    fitting = F.filter(F.flatten(F.transform(named, lambda s: F.element_at(known, s))), lambda r: F.startswith(path, r["path"]))
    best = F.array_min(fitting)
    return F.when(best.isNotNull(), F.struct(best["place"].alias("place"), best["verdict"].alias("verdict")))


def _each(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _steps(x: np.ndarray) -> np.ndarray:
    """Four steps for each doubling; 0 stays 0."""
    return np.floor(4 * np.log2(1.0 + x)).astype(np.int32)


def _counts(block: tb.Block, marks: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(marks)] = True
    return _each(table[block.data], block.offsets)


def _entropy(block: tb.Block) -> np.ndarray:
    """Bits per byte of each text; the texts of a block are short or few."""
    size = np.diff(block.offsets)
    owner = np.repeat(np.arange(len(block)), size)
    key, times = np.unique(owner * 256 + block.data, return_counts=True)
    owner, share = key // 256, times / size[key // 256]
    return np.bincount(owner, weights=-share * np.log2(share), minlength=len(block))


def lexical(urls: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Every row with the lexical features of its url; a row's NULL texts count as empty."""
    def make():
        def compute(batch):
            rows = {name: [] for name in LEXICAL}
            for block in tb.blocks(batch.column(url)):
                size = np.diff(block.offsets)
                rows["f_length"].append(_steps(size))
                digits = _counts(block, b"0123456789")
                rows["f_digits"].append(np.floor(32 * digits / np.maximum(size, 1)).astype(np.int32))
                rows["f_entropy"].append(np.floor(8 * _entropy(block)).astype(np.int32))
                rows["f_parameters"].append(_steps(_counts(block, b"=")))
            for block in tb.blocks(batch.column(host)):
                rows["f_host"].append(_steps(np.diff(block.offsets)))
                rows["f_labels"].append(_steps(_counts(block, b".")))
                rows["f_hyphens"].append(_steps(_counts(block, b"-")))
            for block in tb.blocks(batch.column(path)):
                rows["f_depth"].append(_steps(_counts(block, b"/")))
            return [pa.array(np.concatenate(rows[n]) if rows[n] else np.zeros(0), pa.int32()) for n in LEXICAL]

        return compute

    return append_columns(urls, ", ".join(f"{n} int" for n in LEXICAL), make)


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def segment(path: Column) -> Column:
    """The first segment of a path."""
    return F.substring_index(F.substring(path, 2, F.length(path)), "/", 1)


@dataclass(frozen=True)
class Model:
    """``rates`` (kind, value, rate) is a stored table; ``trees`` is None where nothing could be learned."""

    rates: DataFrame
    base: int
    trees: GBTClassificationModel | None


def with_statistics(urls: DataFrame, rates: DataFrame, base: int, host: str = "host", path: str = "path") -> DataFrame:
    """Rows with the blocked share of their domain and first segment, in steps; unknown ones get the overall share."""
    for name, kind, value in zip(STATISTICS, ("domain", "segment"), (domain(F.col(host)), segment(F.col(path)))):
        key, ref = free_name(urls, "_key"), free_name(urls, "_ref")
        side = rates.where(F.col("kind") == kind).select(F.col("value").alias(ref), F.col("rate").alias(name))
        keyed = urls.withColumn(key, value)
        hot = skew.hot_keys(urls, value)
        urls = skew.spread_lookup(keyed, side, key, ref, hot).drop(key, ref)
        urls = urls.withColumn(name, F.coalesce(name, F.lit(base)))
    return urls


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked", trees: int = TREES, depth: int = DEPTH) -> Model:
    """Suffix statistics and trees from all labelled urls; ``blocked`` is boolean, rows without it are left out."""
    host, path = host_and_path(F.col(url))
    rows = labelled.where(F.col(blocked).isNotNull()).select(
        F.col(url).alias("url"), F.col(blocked).cast("int").alias("blocked"), host.alias("host"), path.alias("path")
    )
    half = F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(2))
    first, second = rows.where(half == 0), rows.where(half == 1)
    kinds = F.inline(F.array(
        F.struct(F.lit("all").alias("kind"), F.lit("").alias("value")),
        F.struct(F.lit("domain").alias("kind"), domain(F.col("host")).alias("value")),
        F.struct(F.lit("segment").alias("kind"), segment(F.col("path")).alias("value")),
    ))
    counted = first.select("blocked", kinds).groupBy("kind", "value").agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "url-rates")
    overall = counted.where("kind = 'all'").first()
    share = overall.blocked / overall.n if overall else 0.5
    rate = F.round(RATE_STEPS * (F.col("blocked") + PRIOR * share) / (F.col("n") + PRIOR)).cast("int").alias("rate")
    rates = stored(counted.where("kind <> 'all'").select("kind", "value", rate), "url-rates")
    base = round(RATE_STEPS * share)

    features = [*LEXICAL, *STATISTICS]
    full = with_statistics(lexical(second), rates, base)
    grouped = stored(full.groupBy(*features, "blocked").agg(F.count(F.lit(1)).cast("double").alias("weight")), "url-training")
    if grouped.select("blocked").distinct().count() < 2:
        return Model(rates, base, None)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(grouped)
    learner = GBTClassifier(
        labelCol="blocked", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=STEP, maxBins=64, seed=7, minInstancesPerNode=1
    )
    return Model(rates, base, learner.fit(vectors.select("features", "blocked", "weight")))


def predict(urls: DataFrame, model: Model, url: str = "url", host: str = "host", path: str = "path", score: str = "block_score") -> DataFrame:
    """Every row with the probability that its url is to be blocked; 0 where nothing was learned."""
    if model.trees is None:
        return urls.withColumn(score, F.lit(0.0))
    names = [url, host, path]
    clash = {c: f"_own{i}" for i, c in enumerate(urls.columns) if c not in names}
    rows = urls.select(*[F.col(c).alias(clash.get(c, c)) for c in urls.columns])
    rows = with_statistics(lexical(rows, url, host, path), model.rates, model.base, host, path)
    vectors = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(rows)
    judged = model.trees.transform(vectors)
    probability = vector_to_array(F.col("probability"))[1]
    return judged.select(*[F.col(clash.get(c, c)).alias(c) for c in urls.columns], probability.alias(score))


def judged(urls: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """Rows with host, path, and the rule that fits with its verdict (both NULL without one); such columns of the rows are replaced."""
    host, path = host_and_path(F.col(url))
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "rule_verdict")]
    match = free_name(urls, "_match")
    rows = urls.select(*kept, host.alias("host"), path.alias("path"))
    rows = rows.withColumn(match, matching_rule(F.col("host"), F.col("path"), rules))
    return rows.select(*kept, "host", "path", F.col(f"{match}.place").alias("rule"), F.col(f"{match}.verdict").alias("rule_verdict"))


def verdicts(urls: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """Rows with host, path, rule, block_score and verdict: the rule's, else block from a score of one half."""
    rows = predict(judged(urls, rules, url), model, url)
    learned = F.when(F.col("block_score") >= 0.5, BLOCK).otherwise(ALLOW)
    return rows.withColumn("verdict", F.coalesce("rule_verdict", learned)).drop("rule_verdict")


def url_table(pages: DataFrame, trees: int = TREES) -> DataFrame:
    """page_id, host, path, rule, block_score and verdict of every page; urls that a rule judges are the labelled ones."""
    urls = pages.select("page_id", "url")
    labelled = judged(urls).where(F.col("rule").isNotNull()).select("url", (F.col("rule_verdict") == BLOCK).alias("blocked"))
    return verdicts(urls, fit(labelled, trees=trees)).drop("url")
