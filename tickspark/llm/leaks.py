"""Passages of test items in training texts, by a generalised suffix automaton of the items.

The automaton is built once from the words of a bounded block of items and sent to the tasks.
Training words stream through it; at every word it knows the longest run of words ending there
that occurs in some item. Runs as long as the window, and whole shorter items, are hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.arrays import string_buffers
from tickspark.llm.words import WORD_RUN, pieces, plain
from tickspark.session import stage

# Words of the items in one automaton. More items make more blocks, each with an automaton of
# its own; an item of more words is cut into pieces that overlap by a window less one.
BLOCK_WORDS = 200_000

FOUND = (
    "struct<n_words: bigint, n_hit: bigint, longest: bigint, "
    "spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


class Automaton:
    """A generalised suffix automaton of word sequences.

    A state stands for the runs of words that end at the same places of the items. ``reach``
    holds its longest run, ``link`` the state of its longest run that ends at more places.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.words: dict[bytes, int] = {}
        self.to: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.reach = [0]
        coded = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items]
        for _, ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self._mark(coded)

    def _state(self, reach: int, link: int, to: dict[int, int]) -> int:
        self.to.append(to)
        self.link.append(link)
        self.reach.append(reach)
        return len(self.to) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """Part the runs of ``target`` reached from ``state`` by ``word`` from its longer ones."""
        twin = self._state(self.reach[state] + 1, self.link[target], dict(self.to[target]))
        self.link[target] = twin
        while state >= 0 and self.to[state].get(word) == target:
            self.to[state][word] = twin
            state = self.link[state]
        return twin

    def _extend(self, last: int, word: int) -> int:
        """The state of the item's words so far and ``word``, from that of the words so far."""
        target = self.to[last].get(word)
        if target is not None:
            if self.reach[target] == self.reach[last] + 1:
                return target
            return self._split(last, word, target)
        fresh = self._state(self.reach[last] + 1, 0, {})
        while last >= 0 and word not in self.to[last]:
            self.to[last][word] = fresh
            last = self.link[last]
        if last >= 0:
            target = self.to[last][word]
            longer = self.reach[target] > self.reach[last] + 1
            self.link[fresh] = self._split(last, word, target) if longer else target
        return fresh

    def _mark(self, items: list[tuple[str | None, list[int]]]) -> None:
        """Tell every state which items hold its window, and which short items end in it."""
        order = np.argsort(self.reach, kind="stable").tolist()
        # The state that stands for the last ``window`` words of a state's runs.
        self.gram = [0] * len(self.to)
        for state in order[1:]:
            if self.reach[state] >= self.window:
                above = self.link[state]
                self.gram[state] = self.gram[above] if self.reach[above] >= self.window else state
        holders: dict[int, set] = {}
        whole: dict[int, dict[int, set]] = {}
        for name, ids in items:
            state = 0
            for at, word in enumerate(ids):
                state = self.to[state][word]
                if at + 1 >= self.window:
                    holders.setdefault(self.gram[state], set()).add(name)
            if 0 < len(ids) < self.window:
                whole.setdefault(state, {}).setdefault(len(ids), set()).add(name)
        self.holders = {state: tuple(names) for state, names in holders.items()}
        self.short: list[tuple] = [()] * len(self.to)
        for state in order[1:]:
            own = tuple((size, tuple(names)) for size, names in sorted(whole.get(state, {}).items()))
            self.short[state] = own + self.short[self.link[state]]
        # A run of known words shorter than any window or whole short item cannot hold a hit.
        sizes = [min(len(ids), self.window) for _, ids in items if ids]
        self.least = min(sizes, default=0)

    def walk(self, ids: list[int], spans: list, found: set) -> int:
        """Stream word numbers through the automaton; add the spans of hits and the names of
        their items, and return the longest matching length that reached a hit."""
        to, link, reach, window = self.to, self.link, self.reach, self.window
        state = size = longest = 0
        for at, word in enumerate(ids):
            target = to[state].get(word)
            while target is None and state:
                state = link[state]
                size = reach[state]
                target = to[state].get(word)
            if target is None:
                continue
            state = target
            size += 1
            start = at + 1
            if size >= window:
                start = at + 1 - window
                found.update(self.holders[self.gram[state]])
            for length, names in self.short[state]:
                if length <= size:
                    start = min(start, at + 1 - length)
                    found.update(names)
            if start <= at:
                longest = max(longest, size)
                spans.append((start, at + 1))
        return longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _scan_text(automaton: Automaton, low: bytes) -> tuple[int, int, list, set]:
    """(words, longest match, spans, items) of one text of plain bytes."""
    known = automaton.words.get
    parts = [np.zeros(0, dtype=np.int32)]
    for piece in pieces(low):
        words = piece.split()
        parts.append(np.fromiter(map(known, words, repeat(-1)), dtype=np.int32, count=len(words)))
    ids = np.concatenate(parts) if len(parts) > 2 else parts[-1]
    spans: list[tuple[int, int]] = []
    found: set = set()
    longest = 0
    if automaton.least and len(ids) >= automaton.least:
        gaps = np.flatnonzero(ids < 0)
        edges = np.concatenate(([-1], gaps, [len(ids)]))
        for run in np.flatnonzero(np.diff(edges) > automaton.least).tolist():
            first = int(edges[run]) + 1
            inner: list[tuple[int, int]] = []
            longest = max(longest, automaton.walk(ids[first : int(edges[run + 1])].tolist(), inner, found))
            spans.extend((first + a, first + b) for a, b in inner)
    return len(ids), longest, _merged(spans), found


def _item_blocks(items: DataFrame, item: str, text: str, window: int) -> Iterator[list]:
    """The items' words in blocks of bounded size, read partition by partition."""
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in items.select(F.col(item).cast("string"), F.col(text).cast("string")).toLocalIterator():
        words = plain((row[1] or "").encode()).split()
        step = max(1, BLOCK_WORDS - window + 1)
        for at in range(0, max(1, len(words) - window + 1), step):
            piece = words[at : at + BLOCK_WORDS]
            if block and size + len(piece) > BLOCK_WORDS:
                yield block
                block, size = [], 0
            block.append((row[0], piece))
            size += len(piece)
    if block:
        yield block


def scan(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    out: str = "leaks",
) -> DataFrame:
    """Add a struct column ``out`` with what each text shares with the items.

    Its fields: ``n_words``, ``n_hit`` (words inside any hit), ``longest`` (the longest run of
    words that occurs in an item, where it reaches a hit, else 0), ``spans`` (hit words as
    merged ranges of word numbers, the end excluded), ``items`` (ids, as strings, of the items
    with hits, each once, in order). A hit is a run of ``window`` consecutive words of an item,
    or the whole of an item of fewer words. Words are runs of ASCII letters and digits and of
    characters beyond ASCII; A-Z is lower-cased first.

    A null or empty text has no words. Items without words never hit; items under one id count
    as one, an item without an id marks words but is not listed. Without items nothing is hit;
    an empty table gives no rows. Rows and other columns stay as they are; an existing column
    ``out`` is replaced. Items are taken in blocks of ``BLOCK_WORDS`` words: one pass over the
    texts for each, the result written to the shared folder before the next.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    spark = df.sparkSession
    names = [name for name in df.columns if name != out]
    done = F.lit(None).cast(FOUND)
    blocks = _item_blocks(items, item, item_text, window)
    block = next(blocks, [])
    while True:
        shared = spark.sparkContext.broadcast(Automaton(block, window))  # at most BLOCK_WORDS words

        @F.arrow_udf(FOUND)
        def search(texts: pa.Array, before: pa.Array) -> pa.Array:
            return _search(shared.value, texts, before)

        df = df.select(*[F.col(f"`{name}`") for name in names], search(F.col(text).cast("string"), done).alias(out))
        block = next(blocks, [])
        if not block:
            return df
        df = stage(df)
        done = F.col(f"`{out}`")


def _search(automaton: Automaton, texts: pa.Array, before: pa.Array) -> pa.Array:
    bounds, raw = string_buffers(texts)
    earlier = before.to_pylist() if before.null_count < len(before) else [None] * len(texts)
    words, hits, longest, spans, items = [], [], [], [], []
    for row, old in enumerate(earlier):
        low = plain(raw[bounds[row] : bounds[row + 1]].tobytes())
        count, length, ranges, found = _scan_text(automaton, low)
        names = {name for name in found if name is not None}
        if old is not None:
            ranges = _merged(ranges + [(s["start"], s["end"]) for s in old["spans"]])
            length = max(length, old["longest"])
            names |= set(old["items"])
        words.append(count)
        hits.append(sum(b - a for a, b in ranges))
        longest.append(length)
        spans.append([{"start": a, "end": b} for a, b in ranges])
        items.append(sorted(names, key=lambda name: name.encode()))
    return pa.StructArray.from_arrays(
        [
            pa.array(words, pa.int64()),
            pa.array(hits, pa.int64()),
            pa.array(longest, pa.int64()),
            pa.array(spans, pa.list_(_SPAN)),
            pa.array(items, pa.list_(pa.string())),
        ],
        names=["n_words", "n_hit", "longest", "spans", "items"],
    )


def remove(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    longest: int = 12,
    coverage: float = 0.1,
) -> DataFrame:
    """The rows with their texts rid of passages of the items, and all columns as before.

    A span of hits (see ``scan``) goes if it has more than ``longest`` words; all spans of a
    text go if they cover more than the share ``coverage`` of its words. One space takes the
    place of each; the rest of the text stays as it is. No row is dropped: a text that is
    nothing but a test item becomes blank. Null texts stay null.
    """
    marked = "__leaks"
    while marked in df.columns:
        marked += "_"
    found = scan(df, items, text, item, item_text, window, marked)
    field = F.col(marked)
    over = field["n_hit"] > F.lit(float(coverage)) * field["n_words"]
    gone = F.filter(field["spans"], lambda s: over | (s["end"] - s["start"] > F.lit(longest)))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for body, ranges in zip(texts.to_pylist(), spans.to_pylist()):
            out.append(None if body is None else _without(body.encode(), ranges))
        return pa.array(out, pa.string())

    # Only texts that lose something are sent to Python.
    loses = F.size(gone) > 0
    body = F.col(f"`{text}`")
    rest = F.when(loses, cut(F.when(loses, body), F.when(loses, gone))).otherwise(body)
    return found.select(*[rest.alias(n) if n == text else F.col(f"`{n}`") for n in df.columns])


def _without(body: bytes, ranges: list[dict]) -> str:
    places = [match.span() for match in WORD_RUN.finditer(plain(body))]
    kept, at = [], 0
    for span in ranges:
        kept.append(body[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    kept.append(body[at:])
    return b" ".join(kept).decode()
