"""SentencePiece encoding and decoding by suffix sorting and relaxation.

A batch's new words are laid one after the other and their suffixes sorted; every piece of the
vocabulary finds its occurrences as one range of suffixes. Sorted by position, these edges are
relaxed from left to right over all words at once: the last piece of a word's prefix is the
one that is compatible with the last piece of the prefix before it. For byte-pair models with
one score per piece exactly one edge into each position is compatible, and following them back
gives the ids that merging pairs by score gives.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.arrays import slices
from tickspark.llm.lattice import Pieces

BLANK = "\u2581"
# Words whose ids, and pairs of pieces whose compatibility, a task remembers; beyond it the
# memory is emptied and filled anew.
REMEMBERED = 250_000
# Characters of new words that are sorted at a time.
SORTED = 1 << 18
# Rows decoded at a time, so that their texts do not pile up beside the ids.
DECODED = 64


class Encoder:
    """A SentencePiece byte-pair model with byte fallback and plain normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.bytes = {}
        self.pieces: dict[str, int] = {}
        for i in range(self.size):
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[model.id_to_piece(i)] = i
        inner = [p for p in self.pieces if BLANK in p.lstrip(BLANK)]
        single = set(self.pieces)
        if inner or len(self.bytes) != 256 or any(c not in single for p in self.pieces for c in p):
            raise ValueError("not a byte-pair model with byte fallback and word-wise pieces")
        self.text = [""] * self.size
        for piece, i in self.pieces.items():
            self.text[i] = piece
        self.score = {p: model.get_score(i) for p, i in self.pieces.items()}
        self.vocabulary = Pieces(self.pieces)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        # A word takes the blanks before it; control characters of no piece stand alone.
        used = set("".join(self.pieces))
        alone = "".join(c for c in "\n\t\r" if c not in used)
        single_out = f"[{alone}]|" if alone else ""
        self.words = re.compile(rf"{single_out}{BLANK}+[^{BLANK}{alone}]*|[^{BLANK}{alone}]+")

    def merged(self, text: str) -> list[str]:
        """Pieces by merging the best-scored neighbours, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces (or -1 at a word's start) stay apart as they are. A character
        that is no piece, ``size``, never merges."""
        code = (left + 1) * (self.size + 1) + right
        unique, where = np.unique(code, return_inverse=True)
        out = np.empty(len(unique), dtype=bool)
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        for i, c in enumerate(unique.tolist()):
            known = self.pairs.get(c)
            if known is None:
                a, b = divmod(c, self.size + 1)
                a -= 1
                if b == self.size:
                    known = True
                elif a in (-1, self.size):
                    known = self.merged(self.text[b]) == [self.text[b]]
                else:
                    known = self.merged(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
                self.pairs[c] = known
            out[i] = known
        return out[where]

    def learn(self, words: list[str]) -> None:
        edges = self.vocabulary.edges(words, other=self.size)
        total = int(edges.bounds[-1])
        last = np.full(total + 1, -2, dtype=np.int64)  # piece that ends before a position
        back = np.zeros(total + 1, dtype=np.int64)
        for lo, hi in zip(edges.cuts[:-1], edges.cuts[1:]):
            start, piece, end = edges.start[lo:hi], edges.piece[lo:hi], edges.end[lo:hi]
            left = np.where(edges.first[lo:hi], -1, last[start])
            live = np.flatnonzero(left > -2)
            good = live[self.compatible(left[live], piece[live])]
            last[end[good]], back[end[good]] = piece[good], start[good]
        # Back from the words' ends, all words at once; the positions met are the pieces' ends.
        ends = np.zeros(total + 1, dtype=bool)
        at, begin = edges.bounds[1:].copy(), edges.bounds[:-1]
        while (go := at > begin).any():
            at, begin = at[go], begin[go]
            ends[at] = True
            at = back[at]
        found = np.flatnonzero(ends)
        ids = last[found]
        cuts = np.searchsorted(found, edges.bounds, side="right")
        flat, other = ids.astype("<i4").tobytes(), set(np.flatnonzero(np.add.reduceat(ids == self.size, cuts[:-1])).tolist())
        for i, (word, b, e) in enumerate(zip(words, (4 * cuts[:-1]).tolist(), (4 * cuts[1:]).tolist())):
            self.known[word] = flat[b:e] if i not in other else self._spelled(word, ids[b // 4 : e // 4])

    def _spelled(self, word: str, ids: np.ndarray) -> bytes:
        """Ids in which characters that are no piece are written as bytes."""
        out, at = [], 0
        for i in ids.tolist():
            if i == self.size:
                out += [self.bytes[x] for x in word[at].encode("utf-8")]
                at += 1
            else:
                out.append(i)
                at += len(self.text[i])
        return np.array(out, dtype="<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; none for null or empty."""
        split = [self.words.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.known))
        if new and len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set().union(*split))
        at = 0
        while at < len(new):
            to, chars = at, 0
            while to < len(new) and (to == at or chars + len(new[to]) <= SORTED):
                chars += len(new[to])
                to += 1
            self.learn(new[at:to])
            at = to
        known = self.known
        return [b"".join([known[w] for w in words]) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> list[bytes]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[1:-1], 16)]))
        else:
            out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.encode("utf-8"))
    return out


def encode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``key``, ``ids`` (array of int), ``n_ids`` and ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers).

    A null or empty text has no ids. Texts are taken whole, a long one costs memory in
    proportion to it. Repeated rows are alike; other columns are left aside; an empty table
    gives no rows. The blank character of the vocabulary in a text is encoded like a space.
    """

    def run(batches):
        e = encoder(path)
        for whole in batches:
            for batch in slices(whole, 1):
                made = e.encode(batch.column(1).to_pylist())
                ends = np.concatenate(([0], np.cumsum([len(m) // 4 for m in made]))).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(made), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(ends, flat),
                        pa.array(np.diff(ends), pa.int32()),
                        pa.array([zlib.crc32(m) for m in made], pa.int64()),
                    ],
                    names=["key", "ids", "n_ids", "ids_crc32"],
                )

    narrow = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    out = narrow.mapInArrow(run, "key long, ids array<int>, n_ids int, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of a column of ids: pieces one after the other, bytes joined, without the
    first blank. Null or no ids give the empty text, control ids nothing; ids outside the
    vocabulary are an error."""

    df = df.drop(out)
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        table = _piece_bytes(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, DECODED):
                batch = whole.slice(lo, DECODED)
                column = batch.column(at)
                flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
                texts = []
                for known, i, j in zip(column.is_valid().to_pylist(), ends[:-1], ends[1:]):
                    row = flat[i:j].tolist() if known else ()
                    text = b"".join([table[x] for x in row]).decode("utf-8", "replace").replace(BLANK, " ")
                    texts.append(text[1:] if text.startswith(" ") else text)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out]
                )

    return df.mapInArrow(run, schema)
