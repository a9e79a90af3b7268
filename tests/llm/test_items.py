"""Test items against documents, and the manifest: brute force and edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tickspark.llm import leaks, manifest, search
from tickspark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ITEM = "One two three four five six seven eight nine ten eleven twelve."
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
DOCS = [
    (1, f"before {ITEM.upper()} after"),
    (2, "one two three four five six seven eight nine but no more"),
    (3, None),
    (4, ""),
    (5, " \t.;\n"),
    (6, LONG + ITEM + LONG),
    (7, "tiny, item! and Tiny  ITEM again"),
    (7, "tiny, item! and Tiny  ITEM again"),
    (8, "İx ﬁ ① 中文 \U0001f600 don't 12 é"),
    (8, "other text of one id"),
    (None, "two three four five six seven eight nine ten eleven"),
]
ITEMS = [
    ("a", ITEM),
    ("b", "tiny item"),
    ("b", "12 É"),
    ("c", None),
    ("d", " .. "),
    ("e", "zero one two three four five six seven eight nine ten"),
    (None, "other text"),
    ("f", "中文 \U0001f600 don"),
    ("a", ITEM),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    for name in ("leaks", "item", "term", "score", "rank", "item_id", "tree", "node", "n", "i", "key"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string").selectExpr("*", "'x' AS item", "1 AS term")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(text, items, window):
    own = words(text)
    hit, found = set(), set()
    for name, body in items:
        its = words(body)
        size = min(window, len(its))
        if not size:
            continue
        runs = {tuple(its[i : i + size]) for i in range(len(its) - size + 1)}
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in runs:
                hit.update(range(i, i + size))
                found.add(name)
    return len(own), len(hit), sorted(n for n in found if n is not None)


@pytest.mark.parametrize("block", [leaks.BLOCK_WORDS, 14])
@pytest.mark.parametrize("window", [1, 3, 10])
def test_leaks_agree_with_brute_force(spark, docs, items, monkeypatch, block, window):
    monkeypatch.setattr(leaks, "BLOCK_WORDS", max(block, window))
    got = leaks.scan(docs, items, window=window)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = sorted((str(r.doc_id), r.text or "", r.leaks.n_words, r.leaks.n_hit, r.leaks["items"]) for r in got.collect())
    assert rows == sorted((str(d), t or "", *brute_hits(t, ITEMS, window)) for d, t in DOCS)


def test_leaks_on_repetitive_items(spark):
    """Items over few words, where runs of one item recur within it and in others."""
    rng = __import__("random").Random(5)
    some = [(str(k), " ".join(rng.choices("ab", k=rng.randint(1, 14)))) for k in range(30)]
    texts = [(k, " ".join(rng.choices("aab" + "c" * (k % 2), k=rng.randint(0, 60)))) for k in range(60)]
    made = leaks.scan(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(some, "item_id string, text string"), window=6
    )
    for row in made.collect():
        assert (row.leaks.n_words, row.leaks.n_hit, row.leaks["items"]) == brute_hits(row.text, some, 6)
        assert row.leaks.n_hit == sum(s.end - s.start for s in row.leaks.spans)


def test_leaks_across_pieces_of_a_text(spark, monkeypatch):
    low = leaks.plain(LONG.encode())
    assert [w for p in leaks.pieces(low, 100) for w in p.split()] == low.split()


def test_leaks_without_items_or_rows(spark, docs, items):
    none = leaks.scan(docs, items.limit(0)).select("leaks.*").collect()
    assert len(none) == len(DOCS) and all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in none)
    assert leaks.scan(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        leaks.scan(docs, items, window=0)


def test_removal_by_length_and_coverage(spark, docs, items):
    clean = leaks.remove(docs, items, window=5, longest=11, coverage=0.9)
    assert clean.columns == docs.columns
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[1] == "before  . after"  # twelve words, longer than allowed; the full stop is in none
    assert got[6] == LONG + " ." + LONG
    assert got[2] == DOCS[1][1]  # nine words of eleven: neither too long nor too much
    assert got[3] is None and got[4] == "" and got[5] == " \t.;\n"
    assert got[None] == " "  # ten words, but they are all there is
    kept = {r.doc_id: r.text for r in leaks.remove(docs, items, window=5, longest=20, coverage=1.0).collect()}
    assert kept == {d: t for d, t in DOCS} | {8: kept[8]}


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_level(nodes):
    return [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]


def brute_path(nodes, at):
    """Siblings from a leaf to the top: (left, digest or nothing)."""
    path = []
    while len(nodes) > 1:
        other = at ^ 1
        path.append((other < at, nodes[other] if other < len(nodes) else ""))
        nodes, at = brute_level(nodes), at // 2
    return path, nodes[0]


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    subroots = []
    for name in order:
        trees[name].sort(key=lambda x: x[:3])
        subroots.append(brute_path([x[2] for x in trees[name]], 0)[1])
    out = []
    for k, name in enumerate(order):
        nodes = [x[2] for x in trees[name]]
        way, root = brute_path(subroots, k)
        for at, (_, _, own, row) in enumerate(trees[name]):
            path = brute_path(nodes, at)[0] + way
            node = own
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for left, other in path:
                node = H(other, node) if left else H(node, other)
            out.append((row[0], own, subroots[k], root, H(*(x for _, x in path)), node, node == root))
    return out


def manifest_rows(df, levels):
    from pyspark.sql import functions as F

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(chosen, F.col("n_chars").cast("decimal(20, 0)") + 1)
    made = manifest.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"n_chars": more}, levels=levels)
    fields = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted((tuple(r[f] for f in fields) for r in made.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_manifest_agrees_with_brute_force(spark, levels):
    rows = [(k, f"s{k % 3}", ["en", "de", None, "en", "é", "en"][k % 6], k, f"text {k}") for k in range(75)]
    rows += [(7, None, "en", None, None), (7, "", "en", 2**63 - 1, ""), (None, "a", "en", 3, "x"), (9, "a", "zz", 1, LONG)]
    rows += [(k, "a", "", 1, "lone") for k in (49, 49, 49)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.selectExpr("*", "'x' AS tree", "1 AS i", "2 AS n", "'y' AS node").repartition(4)
    got = manifest_rows(df, levels)
    assert got == sorted(brute_manifest(rows), key=repr)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("rows", [0, 1, 2])
def test_small_manifests(spark, rows):
    table = [(k, None, None, None, None) for k in range(rows)]
    df = spark.createDataFrame(table, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_rows(df, 2) == sorted(brute_manifest(table), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 11, 16, 21])
def test_places_in_the_log(leaves):
    own = [hashlib.sha256(bytes([k])).digest() for k in range(leaves)]
    log = manifest.append(own, manifest.height(leaves))
    places = []
    nodes = [d.hex() for d in own]
    for level in range(manifest.height(leaves) + 1):
        assert len(nodes) == manifest.width(level, leaves)
        for index, node in enumerate(nodes):
            at = manifest.place(level, index, leaves)
            assert log[at].hex() == node
            places.append(at)
        nodes = brute_level(nodes)
    assert sorted(places) == list(range(len(log)))


def test_equal_rows_are_sorted_by_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20000).selectExpr("'=en' AS tree", "1 AS key", "id AS tie")
    made = manifest.in_order(rows, ["key", "tie"])
    assert made.agg(F.countDistinct("i"), F.min("i"), F.max("i"), F.max("n")).first()[:] == (20000, 0, 19999, 20000)


def brute_rank(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    texts = [[w.translate(LOWER) for w in term.findall(t or "")] for _, t in docs]
    filled, total = sum(1 for t in texts if t), sum(map(len, texts))
    df = Counter(w for t in texts for w in set(t))
    counts = [Counter(t) for t in texts]
    wanted = {}
    for name, body in items:
        wanted.setdefault(name, set()).update(w.translate(LOWER) for w in term.findall(body or ""))
    out = []
    for name, terms in wanted.items():
        scored = []
        for (key, _), own, tf in zip(docs, texts, counts):
            m = 10 + (90 * len(own) * filled) // total if total else 0
            weight = {t: math.floor(1000 * math.log((2 * filled + 2) / (2 * df[t] + 1))) for t in terms if tf[t]}
            points = sum(w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t, w in weight.items())
            if points > 0:
                scored.append((-points, key is not None, key or 0, key))
        out += [(name, i, key, -points) for i, (points, _, _, key) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "grid"), [(search.BLOCK_PAIRS, search.GRID), (5, 8)])
def test_search_agrees_with_brute_force(spark, docs, items, monkeypatch, block, grid):
    monkeypatch.setattr(search, "BLOCK_PAIRS", block)
    monkeypatch.setattr(search, "GRID", grid)
    got = [tuple(r) for r in search.rank(docs, items, k=3).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == brute_rank(DOCS, ITEMS, 3)


def test_search_sorts_out_candidates(spark):
    rows = [(k, "same text" if k % 3 else f"same text {'word ' * (k % 7)}") for k in range(3000, 0, -1)]
    rows += [(None, "same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = [(1, "text word"), (2, "same")]
    best = search._Best
    try:
        search._Best = lambda n, k: setattr(b := best(n, k), "most", 50) or b
        got = [tuple(r) for r in search.rank(docs, spark.createDataFrame(items, "item_id long, text string"), k=5).collect()]
    finally:
        search._Best = best
    assert sorted(got, key=repr) == brute_rank(rows, items, 5)


def test_search_without_items_or_rows(spark, docs, items):
    empty = search.rank(docs, items.limit(0))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert search.rank(docs.limit(0), items).collect() == []
    assert search.rank(docs.filter("text is null"), items).collect() == []


def test_item_queries_have_their_columns(spark):
    want = {
        "op11_leaks": "doc_id bigint,n_words bigint,n_hit bigint,n_items bigint,items_sha256 string,contaminated boolean",
        "op13_search": "item_id bigint,rank int,doc_id bigint,score bigint",
    }
    for name, columns in want.items():
        assert ",".join(" ".join(d) for d in QUERIES[name](spark, SF_DIR).dtypes) == columns
