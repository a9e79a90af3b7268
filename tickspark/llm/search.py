"""Ranked lexical search for stated items, without an index of the documents.

An Aho-Corasick automaton of all the items' terms, each guarded by a space on both sides, reads
the documents themselves: one scan for the corpus counts, one for the term counts of each
document, which the automaton's outputs lead to the items. Each task keeps the best documents
of every item; the tasks' lists are merged by a window.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tickspark.llm.arrays import string_buffers
from tickspark.llm.words import pieces, plain
from tickspark.session import stage

# Pairs of item and term in one automaton. More items make more blocks, each scanned for in
# turn; an item of more terms is a block of its own.
BLOCK_PAIRS = 200_000
# Scores (documents by items) held at a time by a task.
GRID = 1 << 20
# Candidates a task holds, for each of the best wanted, before it sorts out.
SLACK = 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Block(NamedTuple):
    """Some items: ``names``, their distinct ``terms`` (plain bytes), and for each term the
    items that hold it (``items[starts[t] : starts[t + 1]]``)."""

    names: list
    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        """Bytes are read as characters of the same number, so that any UTF-8 can be matched."""
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term.decode('latin-1')} ", number)
        if self.terms:
            made.make_automaton()
        return made


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[Block]:
    """The items with their distinct terms, in blocks of bounded size. Rows under one id make
    one item; one without terms is left out."""
    split = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(_TERM), F.lit(0))
    rows = items.select(F.col(f"`{item}`").alias("item"), F.explode(split).alias("term"))
    rows = rows.select("item", F.translate("term", _UPPER, _UPPER.lower()).alias("term")).distinct()
    names: list = []
    pairs: list[tuple[bytes, int]] = []
    here: list[bytes] = []
    for row in stage(rows).orderBy("item").toLocalIterator():
        if not names or row["item"] != names[-1]:
            if names and len(pairs) >= BLOCK_PAIRS:
                yield _block(names, pairs)
                names, pairs = [], []
            names.append(row["item"])
        pairs.append((row["term"].encode(), len(names) - 1))
    if names:
        yield _block(names, pairs)


def _block(names: list, pairs: list[tuple[bytes, int]]) -> Block:
    pairs.sort()
    terms = sorted({term for term, _ in pairs})
    number = {term: at for at, term in enumerate(terms)}
    at = np.array([number[term] for term, _ in pairs], dtype=np.int64)
    starts = np.searchsorted(at, np.arange(len(terms) + 1))
    return Block(names, terms, starts, np.array([item for _, item in pairs], dtype=np.int64))


_BUILT: list = []  # the last block and its automaton


def _automaton(shared: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a block, built once by each worker process."""
    if not _BUILT or _BUILT[0] is not shared.value:
        _BUILT[:] = [shared.value, shared.value.automaton()]
    return _BUILT[1]


def _counts(automaton: ahocorasick.Automaton, low: bytes) -> tuple[int, Counter]:
    """How many terms a text of plain bytes has, and how often each of the block's."""
    total, found = 0, Counter()
    for piece in pieces(low):
        total += len(piece.split())
        if len(automaton):
            found.update(number for _, number in automaton.iter(f" {piece.decode('latin-1')} "))
    return total, found


def _texts(column: pa.Array) -> Iterator[bytes]:
    bounds, raw = string_buffers(column)
    for row in range(len(column)):
        yield plain(raw[bounds[row] : bounds[row + 1]].tobytes())


def _corpus(docs: DataFrame, shared: Broadcast) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, their terms with repeats, and for each term of the block the
    documents that hold it. Every task counts its rows, so one row per term and task is summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared)
        filled = terms = 0
        holding: Counter = Counter()
        for batch in batches:
            for low in _texts(batch.column(0)):
                n, found = _counts(automaton, low)
                filled += n > 0
                terms += n
                holding.update(found.keys())
        rows = [(-2, filled), (-1, terms), *holding.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["term", "n"])

    summed = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = {row["term"]: row["n"] for row in summed.toLocalIterator()}  # at most the block's terms
    return total.pop(-2, 0), total.pop(-1, 0), total


class _Best:
    """The best documents of every item seen so far by a task."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(items, dtype=np.int64)  # scores below cannot be among the best
        self.most = max(1 << 16, items * k * 2, k * SLACK)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, scores: np.ndarray, docs: np.ndarray, absent: np.ndarray) -> None:
        """Scores, a row per document; the documents' ids, and whether they are null."""
        row, item = np.nonzero(scores >= self.least)
        self.parts.append((item, scores[row, item], docs[row], absent[row]))
        self.size += len(row)
        if self.size > self.most:
            self.sort_out()

    def sort_out(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))
        item, score, doc, absent = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((doc, ~absent, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.k - 1
        self.least[item[last]] = np.maximum(score[order][last], 1)
        order = order[rank < self.k]
        self.parts = [(item[rank < self.k], score[order], doc[order], absent[order])]
        self.size = len(order)
        return self.parts[0]


def _candidates(
    docs: DataFrame, shared: Broadcast, filled: int, terms: int, weights: np.ndarray, k: int
) -> DataFrame:
    """(item number, score, doc): each task's best documents of every item."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, automaton = shared.value, _automaton(shared)
        best = _Best(len(block.names), k)
        rows = max(1, GRID // max(1, len(block.names)))
        for batch in batches:
            ids = batch.column(1)
            absent = np.array(ids.is_null())
            docs_ = ids.fill_null(0).to_numpy(zero_copy_only=False)
            texts = _texts(batch.column(0))
            for at in range(0, batch.num_rows, rows):
                to = min(batch.num_rows, at + rows)
                row, term, value = [], [], []
                for here in range(to - at):
                    n, found = _counts(automaton, next(texts))
                    if not found:
                        continue
                    # Python's integers: the product may exceed 64 bits before it is divided.
                    m = 10 + 90 * n * filled // terms
                    row.append(np.full(len(found), here))
                    term.append(np.fromiter(found.keys(), dtype=np.int64, count=len(found)))
                    tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                    value.append((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                if row:
                    grid = _grid(block, weights, to - at, *(np.concatenate(c) for c in (row, term, value)))
                    best.add(grid, docs_[at:to], absent[at:to])
        item, points, doc, null = best.sort_out()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(points, pa.int64()), pa.array(doc, pa.int64(), mask=null)],
            names=["item", "score", "doc"],
        )

    return docs.select("text", "doc").mapInArrow(score, "item long, score long, doc long")


def _grid(block: Block, weights: np.ndarray, rows: int, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Scores of some documents for all items, from their terms' saturated counts."""
    scores = np.zeros(rows * len(block.names), dtype=np.int64)
    value = value * weights[term]
    step = 1 << 15  # pairs of document and term taken to their items at a time
    for at in range(0, len(row), step):
        t, base, v = term[at : at + step], row[at : at + step] * len(block.names), value[at : at + step]
        held = block.starts[t + 1] - block.starts[t]
        which = np.repeat(np.arange(len(t)), held)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(held) - held, held)
        item = block.items[block.starts[t][which] + inner]
        np.add.at(scores, base[which] + item, v[which])
    return scores.reshape(rows, len(block.names))


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: ``item``, ``rank`` (int, from 1), ``key``, ``score``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
    With N documents that have terms, L of them all with repeats, n of a document, df documents
    holding a term and tf its occurrences there, a term weighs w = floor(1000 * ln((2 * N + 2) /
    (2 * df + 1))), a document's m is 10 + 90 * n * N // L, and its score for an item sums
    w * (1000000000 * tf // (1000 * tf + 8 * m)) over the item's different terms. Documents
    score above 0; equal scores rank by the key, an integer, null first.

    Null and empty texts have no terms. Rows under one item id (null is one) make one item; an
    item without terms has no rows. Repeated documents rank one after the other. Without items
    or documents there are no rows. Other columns are left aside. Items are taken in blocks of
    about ``BLOCK_PAIRS`` terms, each with two scans of the documents.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{key}`").cast("long").alias("doc"))
    kind = items.schema[item].dataType
    out = None
    for block in _blocks(items, item, item_text):
        shared = spark.sparkContext.broadcast(block)  # about BLOCK_PAIRS terms, or one item's
        filled, terms, holding = _corpus(narrow, shared)
        weights = np.zeros(len(block.terms), dtype=np.int64)
        for number, df in holding.items():
            weights[number] = math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1)))
        found = _candidates(narrow, shared, filled, terms, weights, k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_first())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = StructType().add("item", LongType()).add("name", kind)
        names = spark.createDataFrame(list(enumerate(block.names)), named)
        part = ranked.join(F.broadcast(names), "item").select(
            F.col("name").alias(item), "rank", F.col("doc").alias(key), "score"
        )
        out = part if out is None else stage(out).unionByName(part)
    if out is None:
        out = items.select(F.col(f"`{item}`").alias(item)).filter(F.lit(False))
        out = out.select("*", F.lit(0).alias("rank"), F.lit(None).cast("long").alias(key), F.lit(0).cast("long").alias("score"))
    return out
