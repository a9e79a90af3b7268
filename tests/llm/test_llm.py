"""The training-data operators against brute force, and their edge cases."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tickspark.llm import chat, exact, language, lines, near, neighbours, packing, pages, shards, wordpieces
from tickspark.llm.components import components
from tickspark.llm.queries import ORACLE, PIECE_MODEL, QUERIES, WORD_MODEL, model_path

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
# Null, empty, blank, repeated, long and odd texts; names that clash with inner columns.
TEXTS = [
    (1, "One two three four five six.\nSame line.", "en", "a"),
    (2, "ONE two three four five six.\nSame line.", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n ", "en", "c"),
    (6, LONG, "en", "a"),
    (7, LONG + "omega", "de", "b"),
    (8, "short", "de", "b"),
    (8, "short", "de", "b"),
    (9, "ﬁ ① 中文 \U0001f600 İx don't 12 \x1c y\n\n", "fr", "d"),
    (None, "no key here but words enough for shingles", "fr", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    for name in ("key", "hash", "row", "keep", "n", "shard", "slot", "site", "pos", "tile", "language"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="module")
def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows, percent):
    sets = {k: shingle_set(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    from workload.check import connect, differences

    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_near_agrees_with_brute_force(spark, table):
    want = brute_components([r[:2] for r in table], 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_near"](spark, SF_DIR).collect()}
    assert got == want


@pytest.mark.parametrize("block", [near.BLOCK_BYTES, 2000])
def test_near_family_larger_than_a_block(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_BYTES", block)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        for at in rng.choice(120, size=k % 9, replace=False):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    want = brute_components(rows, 80)
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_edges(spark, docs):
    got = {(r.doc_id, r.n_shingles): r for r in near.near_duplicates(docs, 85).collect()}
    assert got[2, 4].component_id == 1 and not got[2, 4].kept
    assert got[3, 0].component_id == 3 and got[4, 0].kept and got[5, 0].kept
    assert got[7, 11].component_id == 6
    assert got[None, 4].component_id is None and got[None, 4].kept
    assert near.near_duplicates(docs.limit(0)).count() == 0


def test_drop_near_decides_by_row(spark):
    words = {k: [f"{k}{i}" for i in range(60)] for k in "abcde"}
    first, clean, lost, alone, same = (" ".join(w) for w in words.values())
    rows = [
        (1, first), (2, first + " more"), (2, clean),  # one text under id 2 is a near copy, the other has none
        (None, lost), (None, lost + " more"), (None, lost + " more still"), (None, alone), (None, first + " too"),
        (3, same), (3, same.upper()), (4, ""), (4, None), (None, " "),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS row", "1 AS key").repartition(3)
    stays = near.drop_near(df, 80)
    assert stays.columns == df.columns
    got = [(r.doc_id, r.text) for r in stays.collect()]
    assert sorted(set(got) & {rows[i] for i in (0, 1, 2, 6, 7)}, key=str) == sorted([rows[0], rows[2], rows[6]], key=str)
    assert sum((t or "").startswith(lost) for _, t in got) == 1
    assert [k for k, t in got if (t or "").lower() == same] == [3]
    assert len(got) == 8
    assert near.drop_near(df.limit(0)).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 100)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}


def test_exact_edges(spark, docs):
    got = exact.exact_groups(docs).collect()
    assert len(got) == len(TEXTS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1][0].keep_id == 2 and not by[1][0].kept and by[2][0].kept
    assert by[3][0].keep_id == 4 and by[3][0].group_size == 2
    assert sorted(r.kept for r in by[8]) == [False, True]
    assert exact.exact_groups(docs.limit(0)).count() == 0
    stays = exact.drop_exact(docs)
    assert stays.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in stays.collect()) == [0, 2, 4, 5, 6, 7, 8, 9]


def test_filter_finds_all_repeats(spark):
    df = spark.range(3000).selectExpr("sha2(cast(id % 2900 as string), 256) AS h")
    marked = exact.maybe_repeated(df, "h", exact.build_filter(df, "h", 1 << 16), "again").groupBy("h")
    rows = marked.agg({"*": "count", "again": "max"}).collect()
    assert all(r["max(again)"] for r in rows if r["count(1)"] > 1)
    assert sum(not r["max(again)"] for r in rows) > 2000


def test_ids_are_learnt_by_part():
    """A part is learnt once, whatever its case and the signs beside it; ids stay the tokenizer's."""
    encode = packing.WordIds(model_path(WORD_MODEL))
    list(encode(["Word, WORD word", "wOrd (word) WORD,"]))
    assert set(encode.known) == {"word", ",", "(", ")"}
    texts = [t for _, t, *_ in TEXTS] + [
        "It's DON'T we'll, 3rd--x,y;z", "foo\xa0BAR baz's\x0bqux  Straße,ŒUVRE", "a\x1cb c\x1f 'S", "İx ŉ ſ Σας ΣΑΣ", "e\u0301a E\u0301, \u0301z",
        "a <|endoftext|> B", "x<|startoftext|>y,z", "漢字 and,漢 字's", "-- '' , \u200b", "42 4x2, A1B2!!",
    ]
    encode.forget()
    got = list(encode(texts))
    want = [encode.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got == [np.array(ids, dtype="<u4").tobytes() for ids in want]
    assert got == list(encode(texts))


def check_packing(rows, got, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(model_path(WORD_MODEL))
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows}
    places, cuts = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        places[r.sequence_id].append((r.offset, r.length))
        cuts[r.doc_id].append((r.start, r.length))
    assert sorted(places) == list(range(len(places)))
    for spans in [*places.values(), *cuts.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
    assert all(sum(n for _, n in spans) <= capacity for spans in places.values())
    assert all(sum(n for _, n in cuts[k]) == len(ids[k]) for k in ids)
    return len(places), sum(map(len, ids.values()))


def test_packing(spark, table):
    windows, tokens = check_packing([r[:2] for r in table], QUERIES["op2_packing"](spark, SF_DIR).collect(), 4096)
    assert windows <= tokens / 4096 + 2


def test_packing_edges(spark, docs):
    some = docs.dropDuplicates(["doc_id"]).filter("doc_id IS NOT NULL")
    rows = [(r.doc_id, r.text) for r in some.collect()]
    check_packing(rows, packing.pack(some, model_path(WORD_MODEL), capacity=64).collect(), 64)
    assert packing.pack(docs, model_path(WORD_MODEL)).count() >= len(TEXTS)
    assert packing.pack(docs.limit(0), model_path(WORD_MODEL)).count() == 0


def test_patterns_fill_windows():
    assert packing.patterns({}, 10) == []
    assert packing.patterns({6: 3, 4: 2, 2: 2}, 10) == [([(6, 1), (4, 1)], 2), ([(6, 1), (2, 2)], 1)]


def test_pieces_equal_the_library(spark, docs, table):
    import sentencepiece

    path = model_path(PIECE_MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = QUERIES["op4_pieces"](spark, SF_DIR).collect()
    text = {k: t for k, t, _ in table}
    assert all(list(r.ids) == model.encode(text[r.doc_id]) for r in got)
    odd = wordpieces.decode(wordpieces.encode(docs, path), path).collect()
    known = {(k, len(model.encode(t or ""))): t for k, t, *_ in TEXTS}
    assert all(r.decoded == (known[r.doc_id, r.n_ids] or "") for r in odd)
    assert wordpieces.encode(docs.limit(0), path).count() == 0


def test_sharding(spark, docs):
    weights = dict.fromkeys(range(8), 1.0)
    got = shards.shard(docs, weights, grown=1.0).collect()
    assert len(got) == len(TEXTS)
    slots = defaultdict(list)
    for r in got:
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.size for r in got if r.doc_id in (3, 4)} == {1}
    many = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    counts = shards.shard(many, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 20_000 for r in counts}
    assert abs(share[1] - 0.75) < 0.02
    assert shards.shard(docs.limit(0), weights).count() == 0


def test_lines(spark, docs):
    got = {r.doc_id: r for r in lines.drop_lines(docs, sites=2).collect()}
    assert list(got[1].removed) == [0, 1] and got[1].text == ""  # letter case aside, both lines are on two sites
    assert got[3].text is None and got[3].n_lines == 0
    assert got[5].n_removed == 0 and got[9].text == TEXTS[9][1]
    assert lines.drop_lines(docs.limit(0)).count() == 0


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "Rules", "x"), (1, 1, "ann", "Hi", "x"), (1, 2, "bob", None, "x"), (1, 300, "ann", "Bye", "x"),
        (None, None, None, "lost", "x"), (2, 0, "system", "alone", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    whole = {(r.conv_id, r.part, r.perspective) for r in chat.rotate(df).collect()}
    assert whole == {(1, 0, "ann"), (1, 0, "bob"), (None, 0, "unknown")}
    got = {(r.conv_id, r.part, r.perspective): r for r in chat.rotate(df, turns=3).collect()}
    assert set(got) == {(1, 0, "ann"), (1, 0, "bob"), (1, 1, "ann"), (1, 1, "bob"), (None, 0, "unknown")}
    r = got[1, 0, "ann"]
    assert "<|im_start|>assistant\nHi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n" in r.rendered
    assert [r.rendered[a : a + n] for a, n in zip(r.mask_starts, r.mask_lengths)] == ["Hi<|im_end|>\n"]
    assert got[1, 1, "bob"].n_target == 0
    assert chat.rotate(df.limit(0)).count() == 0


LONG_TALKS = [(1, 0, "system", "Rules"), (1, 300, "system", "More"), (1, 301, "system", "Rules")]
LONG_TALKS += [(1, i, ("ann", "bob")[i % 2], f"t{i:04}") for i in range(1, 700)]
LONG_TALKS += [(None, None, "ann", f"n{i:04}") for i in range(1000)] + [(None, None, "system", "Lost")]
LONG_TALKS += [(2, 5, "bob", "same")] * 600 + [(2, 0, "system", "Be brief"), (2, 400, "bob", "last"), (2, None, None, None)]
LONG_TALKS += [(3, i, "system", f"Rule {i}") for i in range(600)] + [(3, 900, "eve", "Well.")] + [(4, 9, "ann", "short")]


def brute_perspectives(rows, turns):
    """(conv, part, perspective) -> text, by sorting each conversation."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, talk in talks.items():
        talk.sort()
        for at in range(0, len(talk), turns):
            told = [m for m in talk[:at] if m[2] == "system"]
            shown = told[:1] + told[1:][-1:] + talk[at : at + turns]
            for name in {m[2] for m in talk} - {"system"}:
                heads = {name: "assistant", "system": "system"}
                text = "".join(f"<|im_start|>{heads.get(r, f'user name={r}')}\n{t}<|im_end|>\n" for _, _, r, t in shown)
                out[conv, at // turns, name] = (text, len(shown))
    return out


@pytest.mark.parametrize("turns", [chat.TURNS, 7])
def test_perspectives_of_long_conversations(spark, turns):
    df = spark.createDataFrame(LONG_TALKS, "conv_id long, turn long, role string, text string").repartition(5)
    rows = chat.rotate(df, turns=turns).collect()
    got = {(r.conv_id, r.part, r.perspective): (r.rendered, r.n_turns) for r in rows}
    assert len(rows) == len(got) and got == brute_perspectives(LONG_TALKS, turns)
    for r in rows:
        assert r.n_turns <= turns + 2 and r.n_chars == len(r.rendered)
        spans = [r.rendered[a : a + n] for a, n in zip(r.mask_starts, r.mask_lengths)]
        assert spans == [f"{t}<|im_end|>\n" for t in re.findall(r"<\|im_start\|>assistant\n(.*?)<\|im_end\|>", r.rendered)]
        assert r.n_target == sum(map(len, spans))


def test_perspectives_of_long_conversations_agree_with_sql(spark, tmp_path):
    import duckdb
    from workload.check import differences

    df = spark.createDataFrame(LONG_TALKS, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "talks"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/talks/*.parquet')")
    assert differences(chat.rotate(df), con, ORACLE["op5_perspectives"]) == []


def test_neighbours_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
        (6, [1.0, 2.0, 3.0]), (20, [0.5, 0.5]), (None, [9.0, 9.0]), (7, [None, 1.0]), (8, []),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS r")
    got = [tuple(r) for r in neighbours.nearest(df, k=3).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5),
    ]
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_of_repeated_ids(spark):
    """No row is lost or left out but the query's own."""
    rng = np.random.default_rng(2)
    ids = [int(i) for i in rng.integers(0, 12, size=60)]
    table = [(i, [float(x) for x in rng.integers(-3, 4, size=3)]) for i in ids] + [(1, [5.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0])]
    table = [(i, v) for i, v in table if any(v)]
    want = []
    for at, (query, q) in enumerate(table):
        if query % 4 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for j, (i, v) in enumerate(table) if j != at)
            want += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:7], 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").repartition(3)
    got = [tuple(r) for r in neighbours.nearest(df, k=7, every=4).collect()]
    assert sorted(got) == sorted(want)


def test_main_text():
    def simple(page):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article[1]).replace("<br>", " "))
        import html

        return "\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))

    import pyarrow.parquet as pq

    for page in pq.read_table(f"{SF_DIR}/pages.parquet", columns=["html"]).column(0).to_pylist():
        assert pages.main_text(page) == simple(page)
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<nav>x</nav>") == ""
    framed = (
        '<body class="has-sidebar"><form><header>Site</header><div class="with-sidebar"><main><header><h1>T</h1></header>'
        "<p>A &amp; b&nbsp; c<br>d<p>Two<script>x</script><aside>no</aside></main></div></form>"
        '<section id="comments"><article class="comment"><p>I think, therefore.</p></article></section>'
    )
    assert pages.main_text(framed) == "T\nA & b c d\nTwo"
    bare = "<div id=c><h2>Head</h2><p>" + "Long text, with signs. " * 9 + "</p><p>Short.</p></div><ul><li>a</li></ul><footer>f, g.</footer>"
    assert pages.main_text(bare).split("\n")[::2] == ["Head", "Short."]
    apart = (
        '<article><p>One <span class="ad">Buy</span>two.</p><p>Three <a class="share">x <a>y</a></a> four '
        '<i class="social">open</p><p title=" hidden ">Five</p><div class="x" hidden>gone</div></article>'
    )
    assert pages.main_text(apart) == "One two.\nThree four\nFive"


def test_main_text_beside_cards_and_in_named_frames():
    story = ["The story goes on, sentence after sentence, and says what happened." + f" Part {i}, told in full." for i in range(6)]
    body = "".join(f"<p>{p}</p>" for p in story)
    cards = "".join(f'<article class="card"><h3>Next {i}</h3><p>Read on, it is good.</p></article>' for i in range(3))
    menu = '<div class="main-menu"><p>Home</p></div>'
    side = '<div class="left-sidebar"><p>About us, and about the others who write here. We do, they do, all do, and so on and on.</p></div>'
    for page in (
        f"<div id=story><h1>Title</h1>{body}</div>{cards}",
        f"<form><div id=story><h1>Title</h1>{body}</div></form>{cards}",
        *(
            f'{menu}<div class="{name}"><h1>Title</h1>{body}{side}</div>'
            for name in ("content sidebar-right", "page-with-sidebar", "layout-sidebar", "page-no-sidebar", "sidebarLeft")
        ),
        f'{side}<article><h1>Title</h1>{body}</article><div id="comments-list"><p>{"I think, therefore I am. " * 90}</p></div>',
    ):
        got = pages.main_text(page).split("\n")
        assert got[:7] == ["Title", *story] and (len(got) == 7 or cards in page)
    featured = f"<div id=story>{body}</div><article><p>{story[0]}</p><p>{story[1]}</p><p>{story[2]}</p></article>"
    assert pages.main_text(featured).split("\n") == [*story, *story[:3]]


STORY = [
    "The river rose in the night, and by morning the bridge was gone.",
    "Nobody in the village had seen such water; the old ones, asked twice, said so again.",
    "Boats came from the town, first two, then ten, with bread, blankets and news.",
    "It took three weeks, more or less, until the mill could turn its wheel again.",
]
LINKS = ["Home", "News", "Sport", "Weather", "Contact us"]


def _plain_forms():
    """Pages without HTML5 elements, classes or ids: only their ratios tell what is content."""
    paragraphs = "".join(f"<p>{t}</p>" for t in STORY)
    menu = "".join(f"<li><a href=x>{t}</a></li>" for t in LINKS)
    foot = "<div>Copyright 2020. All rights reserved.</div>"
    yield f"<body><ul>{menu}</ul><div>{paragraphs}</div>{foot}"
    yield f"<body><div><ul>{menu}</ul></div><div><div>{paragraphs}</div></div>{foot}"
    yield f"<table><tr><td><a>{'</a><br><a>'.join(LINKS)}</a></td></tr></table><table><tr><td>{paragraphs}</td></tr></table>{foot}"
    yield f"<body>{paragraphs}<ul>{menu}</ul>{foot}".replace("<ul>", "<div><ul>").replace("</ul>", "</ul></div>")
    yield f"<center><font>{' | '.join(LINKS)}</font></center><div>{''.join(f'<div>{t}</div>' for t in STORY)}</div><hr>{foot}"
    yield f"<div>{'<br>'.join(LINKS)}</div><div><div><div>{paragraphs}</div></div></div><div>{foot}</div>"
    yield f"<div><dl>{''.join(f'<dt>{t}' for t in LINKS)}</dl></div><div>{''.join(f'<p>{t}' for t in STORY)}</div><div>{foot}</div>"
    yield f"<ol>{menu}</ol><div><blockquote>{paragraphs}</blockquote></div>{foot}"
    yield f"<div><select><option>{'<option>'.join(LINKS)}</select></div><div>{paragraphs}</div><div><ul>{menu}</ul></div>{foot}"
    yield f"<div><div><p>{'</p><p>'.join(LINKS)}</p></div></div><div>{paragraphs}</div>{foot}"


@pytest.mark.parametrize("form", range(10))
def test_main_text_without_any_marks(form):
    assert pages.main_text(list(_plain_forms())[form]).split("\n") == STORY


def test_main_text_comes_from_ratios(monkeypatch):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{SF_DIR}/pages.parquet", columns=["html"]).column(0).to_pylist()
    texts = [pages.main_text(page) for page in table]
    unmarked = [re.sub(r' (class|id)="[^"]*"', "", re.sub(r"(</?)(article|nav|footer)\b", r"\1div", page)) for page in table]
    same = sum(pages.main_text(page) == text for page, text in zip(unmarked, texts))
    assert same >= 0.85 * len(table)
    monkeypatch.setattr(pages, "_smooth", lambda values, stems: np.zeros(len(values)))
    assert all(pages.main_text(page) == "" for page in table)


def test_main_text_keeps_what_stands_in_the_container():
    extra = "<h1>Flood</h1><ul><li>Rain</li><li>Wind</li></ul><table><tr><td>Level</td><td>9 m</td></tr></table><p>Short</p>"
    page = f"<div>{extra}{''.join(f'<p>{t}</p>' for t in STORY)}<div class='share-box'>Send, share.</div></div><div>More, less.</div>"
    assert pages.main_text(page).split("\n") == ["Flood", "Rain", "Wind", "Level", "9 m", "Short", *STORY]


def test_main_text_of_broken_markup():
    import time

    assert pages.main_text('<p>One, two.<div class="a>Two.') == "One, two.\nTwo."
    assert pages.main_text('<div class="a>Two, three.</div><p>Four, five.</p>') == "Two, three.\nFour, five."
    assert pages.main_text("a < b, c <3 d") == "a < b, c <3 d"
    assert pages.main_text('<p title="a > b" data-x=\'<b>\'>Text, more.</p>') == "Text, more."
    assert pages.main_text("<p>Cut, off <a href=") == "Cut, off"
    n = 50_000
    broken = ['<a x ' * n + '"', '<a x="' * n + ">", "<div>" * n + "x" + "</p>" * n, "<" * n + "<!--" * n, '<div class="a>' * n, "<p '" * n]
    for page in broken:
        start = time.monotonic()
        pages.main_text(page)
        assert time.monotonic() - start < 10


def test_pages_edges(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>Hello there.")], "page_id long, url string, html string")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in pages.extract(df.selectExpr("*", "1 AS text")).collect()}
    assert got == {1: (None, "", 0), None: ("u", "Hello there.", 12)}


def test_language(spark, docs, table):
    got = QUERIES["op8_language"](spark, SF_DIR).collect()
    lang = {k: name for k, _, name in table}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    model = language.fit(docs, model_path(PIECE_MODEL))
    odd = {r.doc_id: r["found"] for r in language.identify(model, docs, out="found").collect()}
    assert odd[3].lang_pred == odd[4].lang_pred == odd[5].lang_pred == "und" and odd[3].score == 0
    assert 0 < odd[6].score <= 1
    empty = language.fit(docs.limit(0), model_path(PIECE_MODEL))
    assert {r["found"].lang_pred for r in language.identify(empty, docs, out="found").collect()} == {"und"}


def test_language_sample_counts_copies_once(spark):
    rows = [("a", "lorem ipsum dolor")] * 300 + [("a", f"lorem ipsum{'x' * i}") for i in range(20)] + [("b", "sit amet")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    once = language.fit(df.distinct(), model_path(PIECE_MODEL))
    copied = language.fit(df, model_path(PIECE_MODEL))
    assert copied.languages == once.languages == ["a", "b"]
    assert np.array_equal(copied.chances, once.chances)


def test_forward_sums_all_segmentations():
    pieces = language.Pieces({"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4})
    chances = np.array([[0.3], [0.2], [0.25], [0.15], [0.1]])

    def slow(word):
        if not word:
            return 1.0
        return sum(
            chances[i, 0] * slow(word[len(p) :]) for p, i in zip(pieces.text, pieces.ids) if word.startswith(p)
        )

    words = ["aba", "abab", "b", "bbabaab"]
    edges = pieces.edges(words)
    sums = language.forward(edges, chances)
    assert np.allclose(sums[edges.bounds[1:], 0], [slow(w) for w in words])
    uses = language.expected(edges, chances, sums, np.ones(4))
    sizes = np.array([1, 1, 2, 2, 3])[edges.piece]
    assert np.isclose((uses * sizes).sum(), sum(map(len, words)))  # every character is used once


def test_language_stage_rejects_what_is_in_no_language(spark, table):
    """Clean documents stay, junk and languages never learned go, columns may clash."""
    clean = [(k, t, lang) for k, t, lang in table if re.search(r"[^\W\d_]", t or "")]
    junk = [(-1, "xkcd qwzx", "en"), (-2, "zzzz qqqq xxxx jjjj wwww kkkk", None), (-3, "12 9", "en"), (-4, None, "de")]
    junk += [(-5, "\u042d\u0442\u043e \u0440\u0443\u0441\u0441\u043a\u0438\u0439 \u0442\u0435\u043a\u0441\u0442", None), (-6, "", "fr")]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    df = df.selectExpr("*", "'x' AS language", "1 AS language_", "2 AS fit").repartition(3)
    kept = corpus_pipeline.known_language(spark, df, SF_DIR)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _, _ in clean)
    assert corpus_pipeline.known_language(spark, df.limit(0), SF_DIR).count() == 0


def test_identify_replaces_its_column(spark, docs, table):
    model = language.fit(spark.createDataFrame(table, "doc_id long, text string, lang string"), model_path(PIECE_MODEL))
    made = language.identify(model, docs)
    assert made.columns == docs.columns
    found = {r.doc_id: r.language for r in made.collect()}
    assert found[3].fit is None and found[8].fit < 0 and found[8].lang_pred in model.languages


def test_lines_of_a_long_text(spark):
    rows = [(1, "\n".join(["same"] * 6_000 + ["own"]), "s0")] + [(k, "same", f"s{k}") for k in range(2, 14)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1] == ("own", 6_001, 6_000) and got[2] == ("", 1, 1)


def test_pipeline(spark, table):
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    fit_on = [k for k, t, _ in table if re.search(r"[^\W\d_]", t or "")]
    texts = {k: t for k, t, _ in table}
    last = {}
    for k in fit_on:
        text = texts[k].translate(LOWER)
        last[text] = max(k, last.get(text, k))
    near_ids = [k for k, (_, root) in brute_components([(k, texts[k]) for k in last.values()], 80).items() if k == root]
    assert sorted({r.doc_id for r in got}) == sorted(near_ids)
    check_packing([(k, texts[k]) for k in near_ids], got, 4096)
