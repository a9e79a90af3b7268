"""Packing token sequences into windows by minimum bin slack."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.numbering import hash52, number
from tickspark.session import stage

CAPACITY = 4096
# Parts of texts whose ids a task remembers; beyond it the memory is emptied and filled anew.
REMEMBERED = 600_000


class WordIds:
    """Ids of whole texts by a ``tokenizers`` file, remembering the ids of their parts.

    White space separates tokens in this vocabulary, so a text's ids are those of its
    white-space-separated runs one after the other. In runs of plain characters, each stretch
    of letters and each stretch of signs is in turn encoded for itself, in lower case.
    """

    # Characters whose class is beyond doubt in any edition of Unicode; no apostrophe, which
    # joins letters in this vocabulary, and no digit.
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
    SIGNS = r"!-&(-/:-@\[-`{-~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        plain, space = self.LETTERS + self.SIGNS, r" \t\n\r"
        self.parts = re.compile(rf"[{self.LETTERS}]+|[{self.SIGNS}]+")
        self.odd = re.compile(rf"[^{plain}{space}]")
        # A run with other than plain characters, from its beginning to its end.
        self.odd_run = re.compile(rf"(?<![^{space}])([{plain}]*+[^{plain}{space}][^{space}]*+)")
        # Strings of special tokens are matched before a text is cut.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            text = text or ""
            if any(s in text for s in self.special):
                yield self.encode(text).tobytes()
                continue
            parts = self.cut(text)
            try:
                yield b"".join(map(self.known.__getitem__, parts))
            except KeyError:
                self.learn(set(parts))
                yield b"".join(map(self.known.__getitem__, parts))

    def cut(self, text: str) -> list[str]:
        """Plain stretches in lower case, and runs with other characters as they are."""
        if not self.odd.search(text):
            return self.parts.findall(text.lower())
        parts = []
        for i, piece in enumerate(self.odd_run.split(text)):
            if i % 2:
                parts.append(piece)
            else:
                parts += self.parts.findall(piece.lower())
        return parts

    def encode(self, text: str) -> np.ndarray:
        # Without the places of the tokens in the text, which nobody reads.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def forget(self) -> None:
        self.known.clear()

    def learn(self, parts: set[str]) -> None:
        if len(self.known) + len(parts) > REMEMBERED:
            self.known.clear()
        new = parts.difference(self.known)
        plain = []
        for part in new:
            if self.odd.search(part):
                self.known[part] = self.encode(part).tobytes()
            else:
                plain.append(part)
        if plain:
            ids = self.encode(" ".join(plain))
            ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(ends) != len(plain):
                raise ValueError("the vocabulary does not mark the ends of words")
            raw, at = ids.tobytes(), 0
            for part, end in zip(plain, ends.tolist()):
                self.known[part] = raw[at:end]
                at = end


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(df: DataFrame, path: str, capacity: int, end: int, key: str, text: str) -> DataFrame:
    """Cut each text's ids, with ``end`` after them, into full windows and one rest."""

    def cut(batches):
        encode = word_ids(path)
        tail = np.array([end], dtype="<u4").tobytes()
        encode.forget()  # a worker outlives its tasks
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            rows: list[tuple] = []
            for k, ids in zip(keys, encode(t.as_py() for t in texts)):
                ids += tail
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((k, start, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*rows)) or [()] * 5
            names = ["key", "start", "length", "crc", "total"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
        encode.forget()

    narrow = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(cut, "key long, start long, length long, crc long, total long")


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Windows that hold every piece: [([(length, copies), ..], times), ..].

    Each step fixes the longest length left and finds, among all multisets of the remaining
    lengths, one whose sum comes closest to the room left. Reachable sums are the bits of one
    integer per length; walking them back gives the copies. The window found is used as often
    as the counts allow, which uses up one of its lengths or nearly so; the number of steps
    therefore depends on the number of distinct lengths, not of pieces.
    """
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        room = capacity - longest
        full = (1 << (room + 1)) - 1
        reach, seen = 1, []
        for length in sorted((x for x in left if left[x] and x <= room), reverse=True):
            seen.append((length, reach))
            copies, width = min(left[length], room // length), 1
            while copies:
                take = min(copies, width)
                reach |= (reach << (take * length)) & full
                copies, width = copies - take, width * 2
            if reach >> room:
                break
        best = reach.bit_length() - 1
        use = {longest: 1}
        for length, before in reversed(seen):
            copies = 0
            while not before >> best & 1:
                best, copies = best - length, copies + 1
            if copies:
                use[length] = use.get(length, 0) + copies
        left[longest] += 1
        times = min(left[length] // n for length, n in use.items())
        for length, n in use.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        out.append((sorted(use.items(), reverse=True), times))
    return out


def plan(found: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their number among those of the length: rows of
    (length, first number, copies per window, first window, first offset), ascending."""
    used: dict[int, int] = {}
    rows, window = [], 0
    for use, times in found:
        offset = 0
        for length, copies in use:
            base = used.get(length, 0)
            rows.append((length, base, copies, window, offset))
            used[length] = base + copies * times
            offset += copies * length
        window += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "base", "copies", "window", "offset"), table.T))


def pack(
    df: DataFrame, path: str, capacity: int = CAPACITY, end: int = 2, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    A text gives its ids by the tokenizer file ``path`` and the id ``end``; null is empty. Its
    full windows are sequences of their own; the rests, one per text, are packed whole. Sequences
    are gapless from offset 0 and hold at most ``capacity`` ids. Repeated rows and null keys are
    packed like others. Other columns are left aside; an empty table gives no rows.

    Only the number of rests of each length, at most ``capacity`` numbers, reaches the driver,
    and the plan has a few rows per length. Rests are numbered within their length by many
    tasks, however common a length is, and find their place in the plan by that number.
    """
    if capacity < 1:
        raise ValueError("capacity has to be positive")
    cut = stage(pieces(df, path, capacity, end, key, text))
    rests = cut.filter(F.col("length") < capacity)
    counts = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}
    found = patterns(counts, capacity)
    table, windows = plan(found), sum(times for _, times in found)
    mark = F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("null")), "start", "crc", "total")
    spread = rests.withColumn("spread", hash52(mark))
    numbered = number(spread, "length", "spread", ["key", "crc"], "number", sum(counts.values()))
    first = np.searchsorted(table["length"], np.arange(capacity + 2))

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            n = batch.column("number").to_numpy()
            # Rows of a length lie together; the last whose base is not above the number counts.
            at = _find(table, first, length, n)
            inside = n - table["base"][at]
            copies = table["copies"][at]
            sequence = table["window"][at] + inside // copies
            offset = table["offset"][at] + inside % copies * length
            columns = [batch.column(c) for c in ("key", "start", "length", "crc", "total")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["key", "start", "length", "crc", "total", "sequence", "offset"],
            )

    schema = "key long, start long, length long, crc long, total long, sequence long, offset long"
    packed = numbered.select("key", "start", "length", "crc", "total", "number").mapInArrow(place, schema)
    whole = cut.filter(F.col("length") == capacity).withColumn("all", F.lit(0))
    mark = F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("null")), "start", "crc", "total")
    whole = number(whole.withColumn("spread", hash52(mark)), "all", "spread", ["key", "crc"], "number", cut.count())
    whole = whole.select(
        "key", "start", "length", "crc", "total",
        (F.col("number") + windows).alias("sequence"), F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole).select(
        F.col("key").alias(key),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"),
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


def _find(table: dict[str, np.ndarray], first: np.ndarray, length: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The plan's row for each piece, by halving the rows of its length."""
    lo, hi = first[length], first[length + 1]
    while (go := hi - lo > 1).any():
        mid = (lo + hi) // 2
        below = table["base"][mid * go] <= n
        lo = np.where(go & below, mid, lo)
        hi = np.where(go & ~below, mid, hi)
    return lo
