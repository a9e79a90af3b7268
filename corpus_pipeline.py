"""From documents to packed training sequences: language ID, exact and near deduplication,
packing. Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import exact, language, near, packing
from tickspark.llm.queries import PIECE_MODEL, WORD_MODEL, model_path
from tickspark.session import stage

# A document goes if it has no letters, or if its likelihood per letter is that far below what
# documents labelled with the language have: FAR times as far from their median as the quantile
# LOW of theirs, over all of them.
LOW, FAR = 0.001, 3.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language, as they are. A null text and one without letters
    have none; a language without any document labelled so sets no limit. Repeated rows fare
    alike, an empty table gives no rows, columns of any name stay."""
    model = language.fit(docs.filter(~language.held_out(docs["doc_id"])), model_path(PIECE_MODEL))
    mark = fresh("language", docs)
    found = stage(language.identify(model, docs, out=mark))  # scored once, read twice
    said = F.col(f"{mark}.lang_pred")
    # Rounded, so that a language has some thousands of different values at most.
    fits = found.filter(said == F.col("lang")).groupBy(said.alias("said"))
    fits = fits.agg(F.percentile(F.round(f"{mark}.fit", 2), [LOW, 0.5]).alias("q")).collect()  # one row per language
    limit = F.lit(float("-inf"))
    for row in fits:
        low, middle = row["q"]
        limit = F.when(said == row["said"], middle - FAR * (middle - low)).otherwise(limit)
    # The last digit is left open: a document on the limit stays.
    sure = (said != language.UNDETERMINED) & (F.col(f"{mark}.fit") >= limit - 0.01)
    return found.filter(sure).select(*[F.col(f"`{c}`") for c in docs.columns])


def fresh(name: str, df: DataFrame) -> str:
    """A column name that the frame does not have."""
    while name in df.columns:
        name += "_"
    return name


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, letter case aside: the one with the largest id. A null text
    is an empty one; of rows equal in id and text any one stays. An empty table gives no rows."""
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle sets alike to 80 % or more. Null and empty
    texts and those without words are linked with nothing. An empty table gives no rows."""
    return near.drop_near(docs, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens. A null text is an empty one; an
    empty table gives no rows."""
    return packing.pack(docs, model_path(WORD_MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("packing", packed),
]

# Segmentation sums, near-duplicate groups and packing have no SQL; tests hold them against
# brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
