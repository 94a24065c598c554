"""The corpus pipeline: documents in, binary token store out, every stage written as Parquet and read again.

Each stage works on all rows its predecessor kept and takes effect on them; all but the last return the
columns of ``documents``, the last one reads the store back: doc_id, start, n_tokens, ids_crc32 of every
stored document. Empty tables pass through every stage.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftlake.llm import decontaminate, langid, mixing, nearcopies, tokenstore
from siftlake.llm.frames import free_name, new_folder
from siftlake.llm.queries import read, tokenizer_path

# A text of at least LETTERS letters is rejected if its cosine with the best language lies within this many
# standard deviations of chance, like a text without a letter. Shorter texts are too short to be judged.
DEVIATIONS = 3.5
LETTERS = 64


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts without a letter, and longer ones unlike every language, go."""
    language, score, letters = (free_name(docs, n) for n in ("lang_pred", "lang_score", "lang_letters"))
    model = langid.fit(docs.select("text", "lang"))
    found = langid.predict(docs, model, language=language, score=score, letters=letters)
    like = (F.col(letters) < LETTERS) | (F.col(score) >= float(DEVIATIONS * langid.noise(model)))
    known = (F.col(language) != langid.UNKNOWN) & like
    return found.where(known).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies, the one with the smallest id."""
    return nearcopies.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = free_name(docs, "leaks")
    found = decontaminate.leaks(docs, decontaminate.indexes_of(read(spark, sf_dir, "benchmark")), column=leaks)
    return found.where(F.size(leaks) == 0).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of all rows, read back through its index."""
    store = tokenstore.write_store(docs, new_folder(spark, "token-store"), tokenizer_path())
    return tokenstore.read_digests(store)


STAGES = [
    ("language ID", language_id),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("token output", token_output),
]

# Near-copies, rounding and tokens cannot be expressed in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
