"""The queries of this subpackage: each operator, with its production parameters, over its
whole table. SQL is given where it can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import chat, exact, language, leaks, lines, manifest, near, neighbours, packing, pages, shards
from tickspark.llm import search, wordpieces

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_MODEL = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def model_path(name: str) -> str:
    """Where a public tokenizer file is; the same on every machine of the cluster."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), model_path(WORD_MODEL))


@_query
def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_lines(_table(spark, sf_dir, "documents"))


@_query
def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = model_path(PIECE_MODEL)
    made = wordpieces.decode(wordpieces.encode(_table(spark, sf_dir, "documents"), path), path)
    decoded = F.sha2(F.encode("decoded", "UTF-8"), 256)
    return made.select("doc_id", "n_ids", "ids_crc32", "ids", decoded.alias("decoded_sha256"))


@_query
def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations"))


@_query
def op6_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents"), dict.fromkeys(range(8), 1.0), grown=1.0)


@_query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


@_query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"))
    model = language.fit(docs.filter(~held), model_path(PIECE_MODEL))
    found = language.identify(model, docs.select("doc_id", "text"))
    return found.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


@_query
def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


@_query
def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


@_query
def op11_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.scan(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "leaks.n_words",
        "leaks.n_hit",
        F.size("leaks.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "leaks.items"), 256).alias("items_sha256"),
        (F.col("leaks.n_hit") > 0).alias("contaminated"),
    )


@_query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(chosen, F.col("n_chars").cast("decimal(20, 0)") + 1)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    return manifest.manifest(docs, columns, tampered={"n_chars": more})


@_query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


ORACLE["op1_nearest"] = """
WITH fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER () AS row FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.row, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""

_LINE = r"lower(regexp_replace(line, '^\s+|\s+$', '', 'g'))"
ORACLE["op3_lines"] = rf"""
WITH l AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    unnest(string_split(text, chr(10))) AS line FROM documents
), k AS (SELECT *, {_LINE} AS body FROM l WHERE {_LINE} <> ''),
common AS (SELECT body FROM k GROUP BY body HAVING count(DISTINCT coalesce(source, chr(1))) >= {lines.SITES}),
hit AS (SELECT doc_id, text, list(DISTINCT pos::INTEGER ORDER BY pos::INTEGER) AS removed FROM k SEMI JOIN common USING (body) GROUP BY doc_id, text)
SELECT d.doc_id, d.source,
  CASE WHEN removed IS NULL THEN d.text ELSE array_to_string(
    list_filter(string_split(d.text, chr(10)), lambda x, i: NOT list_contains(removed, (i - 1)::INTEGER)), chr(10)) END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::INTEGER AS n_lines,
  coalesce(removed, CAST([] AS INTEGER[])) AS removed, coalesce(len(removed), 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN hit h ON d.doc_id IS NOT DISTINCT FROM h.doc_id AND d.text = h.text
"""

ORACLE["op5_perspectives"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS i FROM conversations
), pieces AS (SELECT DISTINCT conv_id, i // {chat.TURNS} AS part FROM t),
told AS (
  SELECT s.conv_id, s.part, min(t.i) AS first, max(t.i) AS last FROM pieces s
  JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.role = 'system' AND t.i < s.part * {chat.TURNS} GROUP BY s.conv_id, s.part
), r AS (
  SELECT conv_id, i // {chat.TURNS} AS part, i, role, text FROM t UNION ALL
  SELECT t.conv_id, h.part, i, role, text FROM told h JOIN t ON t.conv_id IS NOT DISTINCT FROM h.conv_id AND t.i IN (h.first, h.last)
), p AS (SELECT DISTINCT conv_id, role AS perspective FROM r WHERE role <> 'system'),
m AS (
  SELECT r.*, perspective, CASE WHEN role = perspective THEN '{chat.START}assistant' WHEN role = 'system'
    THEN '{chat.START}system' ELSE '{chat.START}user name=' || role END || chr(10) AS head,
    text || '<|im_end|>' || chr(10) AS body
  FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id
), n AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part, perspective
    ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS place FROM m
)
SELECT conv_id, part, perspective, count(*)::INTEGER AS n_turns,
  string_agg(head || body, '' ORDER BY i) AS rendered,
  sum(length(head) + length(body))::INTEGER AS n_chars,
  coalesce(list(place::INTEGER ORDER BY place) FILTER (WHERE role = perspective), CAST([] AS INTEGER[])) AS mask_starts,
  coalesce(list(length(body)::INTEGER ORDER BY place) FILTER (WHERE role = perspective), CAST([] AS INTEGER[])) AS mask_lengths,
  coalesce(sum(length(body)) FILTER (WHERE role = perspective), 0)::INTEGER AS n_target
FROM n GROUP BY conv_id, part, perspective
"""

ORACLE["op9_exact"] = f"""
WITH h AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{exact.UPPER}', '{exact.UPPER.lower()}')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM h JOIN g USING (text_sha256)
"""

_LOWER = f"translate(coalesce(text, ''), '{exact.UPPER}', '{exact.UPPER.lower()}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op11_leaks"] = f"""
WITH items AS (
  SELECT item_id, words, least(len(words), 10) AS size FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, size, words[i : i + size - 1] AS run
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS words FROM documents
), runs AS (
  SELECT row, i, size, words[i : i + size - 1] AS run
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT size FROM items))
), hits AS (SELECT * FROM runs JOIN windows USING (size, run)),
hit AS (SELECT row, count(DISTINCT spot) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY row),
named AS (
  SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM hits GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_RECORD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text"))
_CRC = """xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')],
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v // 2, (v % 2) * 3988292384))), 4294967295)"""
# A level of a tree to the next: nodes i and their siblings, then the parents.
ORACLE["op12_manifest"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, sha256({_RECORD.format(n="n_chars")}) AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN sha256({_RECORD.format(n="(n_chars + 1)")}) END AS shown, row_number() OVER () AS row FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM docs
), nodes AS (
  SELECT lang, 0 AS level, i, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM nodes
  WHERE n > 1 GROUP BY lang, level, i // 2, n
), heads AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, i, n, subroot AS node FROM heads
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n
), steps AS (
  SELECT row, s.level, i >> s.level AS j, leaves.lang FROM leaves, (SELECT DISTINCT level FROM nodes WHERE n > 1) s
  WHERE (n - 1) >> s.level > 0
  UNION ALL
  SELECT row, 1000 + t.level, h.i >> t.level, NULL FROM leaves JOIN heads h ON leaves.lang IS NOT DISTINCT FROM h.lang,
    (SELECT DISTINCT level FROM tops WHERE n > 1) t
), way AS (
  SELECT row, s.level, j % 2 = 1 AS "left", coalesce(a.node, b.node) AS node
  FROM steps s LEFT JOIN nodes a ON s.level < 1000 AND a.lang IS NOT DISTINCT FROM s.lang AND a.level = s.level AND a.i = xor(j, 1)
  LEFT JOIN tops b ON s.level >= 1000 AND b.level = s.level - 1000 AND b.i = xor(j, 1)
), proofs AS (
  SELECT row, list({{'l': "left", 'x': coalesce(node, '')}} ORDER BY level) AS proof FROM way GROUP BY row
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate([p.x for p in proof], 'string_agg', ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified, 2 * i - bit_count(i) AS leaf_place
FROM (
  SELECT l.*, subroot, proof, (SELECT node FROM tops WHERE n = 1) AS root, list_reduce(
    [{{'l': false, 'x': coalesce(shown, leaf)}}] || coalesce(proof, []),
    lambda a, p: {{'l': false, 'x': sha256(CASE WHEN p.l THEN p.x || a.x ELSE a.x || p.x END)}}).x AS folded_root
  FROM leaves l JOIN heads h ON l.lang IS NOT DISTINCT FROM h.lang LEFT JOIN proofs p USING (row)
)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_search"] = f"""
WITH wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
docs AS (SELECT doc_id, row_number() OVER () AS row, {_TERMS} AS terms FROM documents),
corpus AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs),
tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY row, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term, n_docs
), parts AS (
  SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * n_docs) // n_terms))) AS part
  FROM tf JOIN weights USING (term) JOIN docs USING (row), corpus
), scores AS (SELECT item_id, row, sum(part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY item_id, row)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM scores JOIN docs USING (row) WHERE score > 0 QUALIFY rank <= 10
"""
