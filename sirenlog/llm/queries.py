"""The queries of the operators in this folder, as (spark, sf_dir) functions, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.llm.common import materialize, new_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_secret_ledger(spark, sf_dir):
    from sirenlog.llm import secret_scan as s

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = s.BlobLedger(spark, new_folder(spark, "blob-ledger"))
    ledger.scan(documents)
    paths = documents.select("doc_id", s.blob_id(F.col("text")).alias("blob_id"))
    spans = s.span_text(F.col("found"))
    return s._with_findings(paths, ledger, s.RULES).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


_SPLIT = """
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, generate_subscripts(m, 1) AS i,
         unnest(list_transform(pieces[1:len(m)], lambda x: length(x))) AS gap,
         unnest(list_transform(m, lambda x: length(x))) AS width, unnest(list_transform(v, lambda x: length(x))) AS n
  FROM (SELECT doc_id, string_split_regex(t, '{split}') AS pieces, regexp_extract_all(t, '{pattern}', 0) AS m,
               regexp_extract_all(t, '{pattern}', {group}) AS v FROM d)"""
_ASSIGN = """(?i)(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ORACLES["op3_secret_ledger"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_SPLIT.format(kind=k, rank=r, split=p, pattern=p, group=g) for k, r, p, g in (
    ("assign", 0, _ASSIGN, 2), ("access", 1, "AKIA[A-Z0-9]+", 0), ("hex", 2, "[0-9a-f]+", 0)))}),
ends AS (
  SELECT doc_id, kind, rank, width, n, sum(gap + width) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM found),
fits AS (
  SELECT * FROM ends WHERE n >= CASE kind WHEN 'assign' THEN 6 WHEN 'access' THEN 20 ELSE 24 END),
spans AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(concat(kind, ':', CAST(e - width AS BIGINT), ':', CAST(e AS BIGINT)), ','
                    ORDER BY e - width, rank) AS spans
  FROM fits GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id
"""


@_query
def op2_simhash_groups(spark, sf_dir):
    from sirenlog.llm import simhash as h

    prints = materialize(h.fingerprints(_table(spark, sf_dir, "documents"), keep=["doc_id"]), "simhash-prints")
    return h.near_copy_groups(prints).select(
        "doc_id", h.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


@_query
def op5_quality_rules(spark, sf_dir):
    from sirenlog.llm import quality as q

    documents = _table(spark, sf_dir, "documents")
    model = q.fit(documents, _table(spark, sf_dir, "labels"))
    return q.assess(documents, model, keep=["doc_id"])


def word_lengths(documents):
    """doc_id, a digest of the text and its number of words."""
    return documents.select(
        "doc_id", F.xxhash64("text").alias("digest"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("n_words"))


@_query
def op7_length_buckets(spark, sf_dir):
    from sirenlog.llm.packing import pack

    lengths = materialize(word_lengths(_table(spark, sf_dir, "documents")), "lengths")
    return pack(lengths, "n_words", ["doc_id", "digest"]).drop("digest")


@_query
def op9_bpe_prefixes(spark, sf_dir):
    from sirenlog.llm.bpe import encode_digests

    return encode_digests(_table(spark, sf_dir, "documents"), keep=["doc_id"])


@_query
def op10_language_centroids(spark, sf_dir):
    from sirenlog.llm import language as g

    documents = _table(spark, sf_dir, "documents")
    model = g.fit(documents, ~g.held_out())
    return g.predict(documents.withColumn("held_out", g.held_out()), model, keep=["doc_id", "held_out"])


@_query
def op8_chunk_fingerprints(spark, sf_dir):
    from sirenlog.llm import chunks as c

    return c.map_neighbours(_table(spark, sf_dir, "documents"), "doc_id", "text", c.compare_with_next, c.EDITED)


@_query
def op6_token_shards(spark, sf_dir):
    from sirenlog.llm import token_shards as t

    folder = new_folder(spark, "token-shards")
    t.write_shards(_table(spark, sf_dir, "documents"), folder)
    return t.read_documents(spark, folder)


@_query
def op4_suffix_repeats(spark, sf_dir):
    from sirenlog.llm.repeats import removal_digests

    return removal_digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


SHARDS = 40


@_query
def op11_minimax_shards(spark, sf_dir):
    from sirenlog.llm import sharding as s

    sizes = s.document_sizes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return s.shard_rows(sizes, "text_group", "size", "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


# Checksums byte by byte; the capacity by a machine that looks up one group end a step.
_ORACLES["op11_minimax_shards"] = """
WITH RECURSIVE
poly(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM poly WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS entries FROM poly WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 16 AS size FROM documents),
crc AS (
  SELECT t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST(concat('0x', x) AS BIGINT))),
           lambda c, b: xor(c // 256, entries[CAST(xor(c % 256, b) AS INTEGER) + 1])), 4294967295) AS text_crc32
  FROM (SELECT DISTINCT t FROM d), crc_table),
g AS (SELECT t, sum(size)::BIGINT AS size, min(doc_id) AS first, sha256(t) AS tie FROM d GROUP BY t),
by_size AS (
  SELECT *, row_number() OVER w AS i, sum(size) OVER () - coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
         AND 1 PRECEDING), 0) AS rest FROM g WINDOW w AS (ORDER BY size DESC, tie)),
own AS (SELECT *, bool_and(i < 40 AND size * (41 - i) >= rest) OVER (ORDER BY i) AS alone FROM by_size),
n_own AS (SELECT count(*) FILTER (alone) AS k FROM own),
ends AS (SELECT t, (sum(size) OVER (ORDER BY first NULLS FIRST, tie ROWS UNBOUNDED PRECEDING))::BIGINT AS e, size
         FROM own WHERE NOT alone),
limits AS (SELECT max(e) AS total, greatest(max(size), (max(e) + 39 - any_value(k)) // (40 - any_value(k)))::BIGINT AS low,
                  40 - any_value(k) AS shards FROM ends, n_own),
machine AS (
  SELECT low, total AS high, (low + total) // 2 AS c, 0::BIGINT AS pos, 0::BIGINT AS used FROM limits
  UNION ALL
  SELECT CASE WHEN full_up THEN c + 1 ELSE low END, CASE WHEN fits THEN c ELSE high END,
         CASE WHEN fits THEN (low + c) // 2 WHEN full_up THEN (c + 1 + high) // 2 ELSE c END,
         CASE WHEN fits OR full_up THEN 0 ELSE next END, CASE WHEN fits OR full_up THEN 0 ELSE used + 1 END
  FROM (SELECT m.low, m.high, m.c, m.used, max(e) AS next, max(e) = any_value(l.total) AS fits,
               max(e) < any_value(l.total) AND m.used + 1 = any_value(l.shards) AS full_up
        FROM machine m, limits l, ends WHERE m.low < m.high AND e <= m.pos + m.c GROUP BY m.low, m.high, m.c, m.pos, m.used)),
best AS (SELECT min(high) AS c FROM machine WHERE low = high),
cuts AS (
  SELECT 0::BIGINT AS pos, -1 AS shard
  UNION ALL
  SELECT max(e), any_value(shard) + 1 FROM cuts, best, limits, ends WHERE pos < total AND e <= pos + c GROUP BY cuts.pos),
placed AS (
  SELECT t, i - 1 AS shard, 0 AS e FROM own WHERE alone
  UNION ALL
  SELECT t, k + (SELECT min(shard) FROM cuts WHERE cuts.pos >= e AND shard >= 0), e FROM ends, n_own)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY e, sha256(d.t), doc_id NULLS FIRST) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN crc ON d.t = crc.t JOIN placed ON d.t = placed.t
"""


@_query
def op13_ranked_search(spark, sf_dir):
    from sirenlog.llm.ranked_search import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
_TERMS += "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_ORACLES["op13_ranked_search"] = f"""
WITH found AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
held AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, whole GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (doc_id), whole GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@_query
def op12_phrase_collocations(spark, sf_dir):
    from sirenlog.llm.phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))


_ORACLES["op12_phrase_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
placed AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM numbered),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
follow AS (
  SELECT lang, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3, lead(w, 3) OVER s AS w4, lead(w, 4) OVER s AS w5
  FROM placed WINDOW s AS (PARTITION BY p ORDER BY i)),
held AS (
  SELECT lang, unnest([[w1], CASE WHEN w2 IS NOT NULL THEN [w1, w2] END, CASE WHEN w3 IS NOT NULL THEN [w1, w2, w3] END,
         CASE WHEN w4 IS NOT NULL THEN [w1, w2, w3, w4] END, CASE WHEN w5 IS NOT NULL THEN [w1, w2, w3, w4, w5] END]) AS ws
  FROM follow),
f AS (SELECT lang, ws, count(*) AS n FROM held WHERE ws IS NOT NULL GROUP BY lang, ws HAVING count(*) >= 100),
covers AS (
  SELECT lang, unnest([ws[:-2], ws[2:]]) AS ws, n FROM f WHERE len(ws) > 2),
lone AS (
  SELECT f.lang, f.ws, f.n AS a FROM f LEFT JOIN (SELECT lang, ws, max(n) AS n FROM covers GROUP BY lang, ws) c
  ON f.lang = c.lang AND f.ws = c.ws WHERE len(f.ws) > 1 AND (c.n IS NULL OR c.n < f.n)),
cuts AS (SELECT *, unnest(range(1, len(ws))) AS k FROM lone),
scored AS (
  SELECT cuts.lang, cuts.ws, a, k, x.n AS l, y.n AS r, totals.n AS n,
         ((1000::HUGEINT * a * totals.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts JOIN totals ON cuts.lang = totals.lang
  JOIN f x ON x.lang = cuts.lang AND x.ws = cuts.ws[:k] JOIN f y ON y.lang = cuts.lang AND y.ws = cuts.ws[k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
         array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM best)
SELECT * FROM ranked WHERE rank <= 2000
"""


TOOLS = ("search", "translate", "count")
TOOL_SCHEMA = {
    "type": "object", "required": ["limit", "query"], "additionalProperties": False,
    "properties": {"limit": {"type": "integer", "minimum": 0, "maximum": 40},
                   "query": {"type": "string", "minLength": 1}, "after": {"type": "object"}},
}


def derived_calls(spark, sf_dir):
    """Calls and results read into the conversations: an assistant's turn calls, the user's next turn answers.

    Calls refer to the call two turns before, in every third conversation to
    the one two turns later.
    """
    turns = _table(spark, sf_dir, "conversations")
    call_id = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    turn, back = F.col("turn"), F.col("conv_id") % 3 == 0
    after = F.when(back, call_id(turn + 2)).when(turn >= 3, call_id(turn - 2))
    arguments = F.to_json(F.struct(
        F.col("text").alias("query"), (F.char_length("text") % 50).alias("limit"),
        F.when(after.isNotNull(), F.struct(after.alias("$ref"))).alias("after")))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", "turn", F.lit(0).alias("place"), call_id(turn).alias("call_id"),
        F.element_at(F.array(*map(F.lit, TOOLS)), (turn % 3 + 1).cast("int")).alias("name"),
        arguments.alias("arguments"))
    results = turns.filter("role = 'user' AND turn > 0").select(
        "conv_id", "turn", call_id(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@_query
def op1_tool_call_links(spark, sf_dir):
    from sirenlog.llm.tool_calls import link_calls

    calls, results = derived_calls(spark, sf_dir)
    linked = link_calls(calls, results, {name: TOOL_SCHEMA for name in TOOLS})
    return linked.withColumn("errors", F.array_join("errors", "; ")).drop("place")


_ORACLES["op1_tool_call_links"] = """
WITH calls AS (
  SELECT conv_id, turn, text, concat('call_', conv_id, '_', turn) AS call_id,
         CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' ELSE 'count' END AS name,
         CASE WHEN conv_id % 3 = 0 THEN concat('call_', conv_id, '_', turn + 2)
              WHEN turn >= 3 THEN concat('call_', conv_id, '_', turn - 2) END AS ref
  FROM conversations WHERE role = 'assistant'),
results AS (
  SELECT conv_id, turn, text, concat('call_', conv_id, '_', turn - 1) AS call_id
  FROM conversations WHERE role = 'user' AND turn > 0),
islands AS (
  SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM calls),
levels AS (
  SELECT *, CASE WHEN conv_id % 3 = 0
      THEN row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn DESC)
      ELSE row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) END - 1 AS level FROM islands),
linked AS (
  SELECT l.conv_id, l.call_id, l.turn, l.name, CAST(l.level AS INTEGER) AS level,
         CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
         concat_ws('; ', CASE WHEN length(l.text) % 50 > 40 THEN '$.limit: too large' END,
                   CASE WHEN length(l.text) = 0 THEN '$.query: too short' END,
                   CASE WHEN l.ref IS NOT NULL AND c.call_id IS NULL THEN concat('no call ', l.ref) END) AS errors,
         concat('{"call":{"arguments":{', CASE WHEN l.ref IS NOT NULL THEN concat('"after":{"$ref":"', l.ref, '"},') END,
                '"limit":', length(l.text) % 50, ',"query":', to_json(l.text), '},"id":"', l.call_id, '","name":"',
                l.name, '"}', CASE WHEN r.call_id IS NOT NULL THEN
                concat(',"result":{"content":', to_json(r.text), ',"id":"', l.call_id, '"}') END, '}') AS message
  FROM levels l LEFT JOIN results r ON l.call_id = r.call_id LEFT JOIN calls c ON l.ref = c.call_id)
SELECT * FROM linked
UNION ALL
SELECT r.conv_id, r.call_id, r.turn, NULL, NULL, 'orphan_result', '',
       concat('{"result":{"content":', to_json(r.text), ',"id":"', r.call_id, '"}}')
FROM results r LEFT JOIN calls c ON r.call_id = c.call_id WHERE c.call_id IS NULL
"""
