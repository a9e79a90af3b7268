"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability
of a word is the sum over all its segmentations into pieces, which a forward pass computes;
training re-estimates the pieces from their expected counts over all segmentations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.arrays import slices
from tickspark.llm.lattice import Edges, Pieces
from tickspark.session import stage

# Different texts per language that the model is fitted on: all of a rarer language, of a common
# one about so many, chosen by a hash of the text. Copies of a text count once.
SAMPLE = 1500
# Tasks over which the chosen texts are dealt, and the values of the hash that chooses them.
SAMPLE_TASKS = 32
CHOICES = 1 << 40
ROUNDS = 2
# Added to every expected count, so that no piece of a language is impossible.
SMOOTHING = 0.01
# Longer runs of letters are cut into runs of so many, all of which count.
RUN = 32
# Words whose scores a task remembers; beyond it the memory is emptied and filled anew.
REMEMBERED = 250_000
SCORED = 1 << 18
UNDETERMINED = "und"

LETTERS = re.compile(rf"[^\W\d_]{{1,{RUN}}}")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    """The letter-only pieces of a SentencePiece model, lower-cased, each once."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i).lstrip("▁").lower()
        if piece and LETTERS.fullmatch(piece) and len(piece) <= 16:
            found.setdefault(piece, len(found))
    return Pieces(found)


@dataclass
class Model:
    """Probabilities by piece and language; the last piece stands for unknown letters."""

    path: str
    languages: list[str]
    chances: np.ndarray


def forward(edges: Edges, chances: np.ndarray) -> np.ndarray:
    """Sums over the segmentations of each prefix (position by language)."""
    sums = np.zeros((int(edges.bounds[-1]) + 1, chances.shape[1]))
    for lo, hi in zip(edges.cuts[:-1], edges.cuts[1:]):
        if lo == hi:
            continue
        first = edges.first[lo:hi, None]
        part = np.where(first, 1.0, sums[edges.start[lo:hi]]) * chances[edges.piece[lo:hi]]
        by = np.argsort(edges.end[lo:hi], kind="stable")
        ends = edges.end[lo:hi][by]
        cut = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
        sums[ends[cut]] = np.add.reduceat(part[by], cut, axis=0)
    return sums


def expected(edges: Edges, chances: np.ndarray, sums: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected number of uses of each edge in its word, for one language, times the word's
    weight. ``chances`` and ``sums`` have one column."""
    rest = np.zeros(len(sums))  # sums over the segmentations of what follows a position
    last = np.zeros(len(sums), dtype=bool)
    last[edges.bounds[1:]] = True
    out = np.zeros(len(edges.start))
    total = np.repeat(sums[edges.bounds[1:], 0], np.diff(edges.bounds))
    weights = np.repeat(weight, np.diff(edges.bounds))
    # An end shared with the next word's start must not take that word's rest.
    for lo, hi in zip(edges.cuts[-2::-1], edges.cuts[:0:-1]):
        if lo == hi:
            continue
        start, end = edges.start[lo:hi], edges.end[lo:hi]
        after = np.where(last[end], 1.0, rest[end])
        share = after * chances[edges.piece[lo:hi], 0]
        before = np.where(edges.first[lo:hi], 1.0, sums[start, 0])
        out[lo:hi] = before * share / total[start] * weights[start]
        np.add.at(rest, start, share)
    return out


def counted_words(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) of the lower-cased letter runs."""

    def count(batches):
        for batch in batches:
            tally: dict[tuple[str, str], int] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in LETTERS.findall((body or "").lower()):
                    tally[name, word] = tally.get((name, word), 0) + 1
            names, words = zip(*tally) if tally else ((), ())
            arrays = [pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(tally.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

    words = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    words = words.mapInArrow(count, "lang string, word string, n long")
    return words.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    df: DataFrame, path: str, text: str = "text", lang: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS
) -> Model:
    """Fit from the rows that have a text and a language; others are left aside.

    About ``sample`` different texts per language count, all of a rarer one. The driver gets the
    vocabulary's expected counts per language, nothing that grows with the documents. Without
    any labelled document the model has no language and everything is undetermined.
    """
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    distinct = rows.groupBy("lang").agg(F.approx_count_distinct("mark", 0.02).alias("n"))
    sizes = {r["lang"]: r["n"] for r in distinct.collect()}
    languages = sorted(sizes)
    pieces = vocabulary(path)
    unknown = len(pieces.text)
    chances = np.full((unknown + 1, len(languages)), 1.0 / (unknown + 1))
    if not languages:
        return Model(path, languages, chances)
    shares = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, sample / sizes[name]))))
    chosen = rows.filter(F.pmod("mark", F.lit(CHOICES)) < shares[F.col("lang")] * CHOICES)
    # Copies meet after a map-side step, so a text that fills the table is one row per task.
    chosen = chosen.dropDuplicates(["lang", "mark"]).repartition(SAMPLE_TASKS, "mark")
    words = stage(counted_words(chosen, "text", "lang"))
    column = {name: i for i, name in enumerate(languages)}

    for _ in range(rounds):
        now = chances

        def estimate(batches, now=now):
            pieces = vocabulary(path)
            total = np.zeros((len(languages), unknown + 1))
            for batch in batches:
                names = np.array([column[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
                texts, n = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for i in np.unique(names):
                    at = np.flatnonzero(names == i)
                    edges = pieces.edges([texts[j] for j in at], other=unknown)
                    own = now[:, i : i + 1]
                    uses = expected(edges, own, forward(edges, own), n[at])
                    total[i] += np.bincount(edges.piece, uses, minlength=unknown + 1)
            i, piece = np.nonzero(total)
            arrays = [pa.array(i), pa.array(piece), pa.array(total[i, piece])]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "piece", "n"])

        counts = words.mapInArrow(estimate, "lang long, piece long, n double")
        counts = counts.groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        chances = np.full((unknown + 1, len(languages)), SMOOTHING)
        for row in counts.collect():  # languages times the fixed vocabulary
            # Sums of doubles depend on the order of tasks in their last digits; drop those.
            chances[row["piece"], row["lang"]] += round(row["n"], 6)
        chances /= chances.sum(axis=0)
    return Model(path, languages, chances)


def scorer(model: Model):
    """A function from a list of texts to (predicted language, score, fit) triples."""
    pieces, unknown = vocabulary(model.path), len(vocabulary(model.path).text)
    known: dict[str, int] = {}
    table = np.zeros((REMEMBERED + 1, len(model.languages)))

    def learn(words: list[str]) -> None:
        at = 0
        while at < len(words):
            to, chars = at, 0
            while to < len(words) and (to == at or chars + len(words[to]) <= SCORED):
                chars += len(words[to])
                to += 1
            edges = pieces.edges(words[at:to], other=unknown)
            sums = forward(edges, model.chances)[edges.bounds[1:]]
            base = len(known)
            known.update(zip(words[at:to], range(base, base + to - at)))
            table[base : base + to - at] = np.log(np.maximum(sums, 1e-300))
            at = to

    def score(texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        nonlocal table
        out = []
        split = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        for lo in range(0, len(split), 64):
            part = split[lo : lo + 64]
            new = list(set().union(*part).difference(known))
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set().union(*part))
            if len(new) > len(table):
                table = np.zeros((len(new), len(model.languages)))
            learn(new)
            for words in part:
                if not words or not model.languages:
                    out.append((UNDETERMINED, 0.0, None))
                    continue
                total = table[np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
                best = int(total.argmax())
                sure = float(1.0 / np.exp(total - total[best]).sum())
                out.append((model.languages[best], sure, float(total[best]) / sum(map(len, words))))
        return out

    return score


def identify(model: Model, df: DataFrame, text: str = "text", out: str = "language") -> DataFrame:
    """Add a struct column (``lang_pred``, ``score``, ``fit``): the language of highest
    probability, a uniform prior assumed, that probability, and the logarithm of the text's
    likelihood in that language per letter, which falls for texts of no language learned.

    A text that is null or has no letter is ``und`` with score 0 and no fit. Ties go to the
    language first in the alphabet. Only the text is used, whole; repeated rows are alike, an
    empty table gives no rows. An existing column ``out`` is replaced, others stay."""
    # The vocabulary times the languages: its size does not depend on the table.
    shared = df.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer(shared.value)
        for texts in batches:
            whole = pa.RecordBatch.from_arrays([texts], names=["text"])
            rows = [row for part in slices(whole, 0) for row in score(part.column(0).to_pylist())]
            columns = zip(*rows) if rows else ((), (), ())
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.float64()))]
            yield pa.StructArray.from_arrays(arrays, names=["lang_pred", "score", "fit"])

    # Marked so that a filter on the result does not make Spark work it out twice.
    find = F.arrow_udf(found, "struct<lang_pred: string, score: double, fit: double>").asNondeterministic()
    return df.withColumn(out, find(F.col(f"`{text}`").cast("string")))


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
