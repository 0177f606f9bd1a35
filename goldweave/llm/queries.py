"""Registered queries of this package, one per operator, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm import (
    conversation_repair, decontamination, jaccard, language, lines, neighbours, ngram_model, packing, personal_data, prefix_trie, secret_scan, topk, toxicity,
)
from goldweave.llm.common import fold_of, read, scratch
from goldweave.llm.turns import joined_digests
from goldweave.session import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def op1_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = packing.pack(read(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket",
    )


def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), scratch(spark, "op2"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _digest(spans: Column) -> Column:
    """kind:start:stop of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op3_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read(spark, sf_dir, "documents"), scratch(spark, "op3"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[_number(F.col("spans"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"),
    )


def op4_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[_number(base, kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"),
    )


def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    cfg = language.Settings()
    field = language.fit(language.training_rows(docs.filter(fold_of(F.col("doc_id"), 3) != 1), cfg), cfg)
    return language.identified(docs.select("doc_id", "text"), field).select(
        "doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, scratch(spark, "op6"))
    return found.withColumnRenamed("neighbour_id", "vec_id")


def op7_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 10) == 0
    model, scored = ngram_model.train_and_score(docs, ~held_out, scratch(spark, "op7"))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op8_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(read(spark, sf_dir, "documents"), scratch(spark, "op8")).select("doc_id", "source", "n_lines", "n_dropped", "text")


def op9_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = _toxicity(docs, read(spark, sf_dir, "labels"))
    return toxicity.scored(docs, machine).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.Machine:
    cfg = toxicity.Settings()
    return toxicity.fit(toxicity.training_rows(docs, labels.filter(fold_of(F.col("doc_id"), 5) != 0), cfg), cfg)


def op10_minhash_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.jaccard_join(read(spark, sf_dir, "documents"), scratch(spark, "op10"))
    return joined.select("doc_id", "class_id", "copy_id", "n_links")


def repaired_digests(known: DataFrame, rows: DataFrame, work: Scratch, cfg: conversation_repair.Settings = conversation_repair.Settings()) -> DataFrame:
    """The report of each conversation of ``known``, repaired from ``rows``, with the digest of its repaired turns."""
    edits, report = conversation_repair.repair_conversations(rows, work, cfg)
    turns = edits.filter("edit <> 'Delete'")
    digests = joined_digests(turns, F.col("conv_id"), F.concat_ws(":", "role", "text"), "\n", "chunk", "step")
    every = known.select("conv_id").distinct()
    joined = every.join(report.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("key")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_auction_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return repaired_digests(rows, conversation_repair.damage(rows), scratch(spark, "op11"))


def op12_tiled_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, scratch(spark, "op12"))
    return found.withColumnRenamed("neighbour_id", "vec_id")


def op13_burst_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"), scratch(spark, "op13"))


def _base_digest(spans: DataFrame, base: Column, kinds: tuple[str, ...]) -> DataFrame:
    return spans.select("doc_id", *[_number(base, kind).alias(f"n_{kind}") for kind in kinds], F.sha2(_digest(base), 256).alias("base_sha256"))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the secret scan that SQL can express."""
    found = secret_scan.scan_secrets(read(spark, sf_dir, "documents"), scratch(spark, "secret-base"))
    return _base_digest(found, F.filter("spans", lambda s: s["kind"] != "random"), secret_scan.KINDS[:3])


def personal_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the search for personal data that SQL can express."""
    found = personal_data.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return _base_digest(found, F.filter("spans", lambda s: s["base"]), personal_data.KINDS)


def word_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the language model that SQL can express, scores to three places."""
    scored = op7_elias_fano_trie(spark, sf_dir)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score"))


def queries() -> dict[str, Query]:
    return {
        "op1_power_of_two_packing": op1_power_of_two_packing,
        "op2_winnowing_decontamination": op2_winnowing_decontamination,
        "op3_randomness_secrets": op3_randomness_secrets,
        "op4_crf_personal_data": op4_crf_personal_data,
        "op5_crf_language": op5_crf_language,
        "op6_multiprobe_neighbours": op6_multiprobe_neighbours,
        "op7_elias_fano_trie": op7_elias_fano_trie,
        "op8_site_line_frequency": op8_site_line_frequency,
        "op9_factorization_toxicity": op9_factorization_toxicity,
        "op10_minhash_jaccard_join": op10_minhash_jaccard_join,
        "op11_auction_conversation_repair": op11_auction_conversation_repair,
        "op12_tiled_top_k": op12_tiled_top_k,
        "op13_burst_prefix_trie": op13_burst_prefix_trie,
        "secret_base_spans": secret_base_spans,
        "personal_base_spans": personal_base_spans,
        "word_base_scores": word_base_scores,
    }


_OP2 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)
), place AS (
  SELECT k, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (
  SELECT place.k, place.i, place.n, win.item_id FROM place JOIN win ON place.n = win.n AND place.words = win.words
), covered AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT k, i, n FROM hit)) GROUP BY k
), named AS (
  SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (k) LEFT JOIN named USING (k)
"""

_OP8 = r"""
WITH page AS (
  SELECT row_number() OVER () AS p, source, string_split(text, chr(10)) AS l FROM (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL)
), line AS (
  SELECT DISTINCT p, source, t FROM (SELECT p, source, trim(unnest(l), ' ') AS t FROM page) WHERE t <> ''
), total AS (
  SELECT source, count(*) AS pages FROM page GROUP BY source
), frequent AS (
  SELECT c.source, c.t FROM (SELECT source, t, count(*) AS n FROM line GROUP BY source, t HAVING count(*) > 1) c
  JOIN total ON c.source IS NOT DISTINCT FROM total.source WHERE c.n > 0.02 * total.pages
), framed AS (
  SELECT p, sum(length(line.t)) AS size, coalesce(sum(length(frequent.t)), 0) AS shared FROM line
  LEFT JOIN frequent ON line.source IS NOT DISTINCT FROM frequent.source AND line.t = frequent.t GROUP BY p
), own AS (
  SELECT p, source FROM page LEFT JOIN framed USING (p) WHERE coalesce(shared, 0) <= 0.5 * coalesce(size, 0)
), own_total AS (
  SELECT source, count(*) AS pages FROM own GROUP BY source
), often AS (
  SELECT c.source, c.t FROM (
    SELECT line.source, line.t, count(*) AS n FROM line JOIN own USING (p)
    JOIN frequent ON line.source IS NOT DISTINCT FROM frequent.source AND line.t = frequent.t GROUP BY line.source, line.t HAVING count(*) > 1) c
  JOIN own_total ON c.source IS NOT DISTINCT FROM own_total.source WHERE c.n > 0.02 * own_total.pages
), doc AS (
  SELECT row_number() OVER () AS k, doc_id, source, text, string_split(text, chr(10)) AS l FROM documents
), kept AS (
  SELECT x.k, string_agg(x.line, chr(10) ORDER BY x.i) AS text, count(*) AS n
  FROM (SELECT k, source, i, l[i] AS line, trim(l[i], ' ') AS t FROM (SELECT k, source, l, unnest(range(1, len(l) + 1)) AS i FROM doc)) x
  LEFT JOIN often ON x.source IS NOT DISTINCT FROM often.source AND x.t = often.t WHERE often.t IS NULL GROUP BY x.k
)
SELECT doc_id, source, coalesce(CAST(len(l) AS BIGINT), 0) AS n_lines, coalesce(CAST(len(l) AS BIGINT), 0) - coalesce(n, 0) AS n_dropped,
  CASE WHEN doc.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM doc LEFT JOIN kept USING (k)
"""


_OP10 = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), gram AS (
  SELECT DISTINCT k, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), amount AS (
  SELECT k, count(*) AS n FROM gram GROUP BY k
), pair AS (
  SELECT a.k AS ka, b.k AS kb, count(*) AS n FROM gram a JOIN gram b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k
), link AS (
  SELECT ka, kb FROM pair JOIN amount x ON x.k = ka JOIN amount y ON y.k = kb WHERE 5 * pair.n >= 4 * (x.n + y.n - pair.n)
), tie AS (
  SELECT ka AS a, kb AS b FROM link UNION ALL SELECT kb, ka FROM link
), reach AS (
  SELECT k AS a, k AS b FROM doc UNION SELECT reach.a, tie.b FROM reach JOIN tie ON reach.b = tie.a
), class AS (
  SELECT reach.a AS k, min(doc.doc_id) AS class_id FROM reach JOIN doc ON doc.k = reach.b GROUP BY reach.a
)
SELECT doc_id, class_id, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) END AS copy_id,
  (SELECT count(*) FROM tie WHERE tie.a = doc.k) AS n_links
FROM doc JOIN class USING (k)
"""


def _crc(text: str) -> str:
    """DuckDB expression for the CRC-32 of an ASCII text, bit by bit."""
    bit = "xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda l: CAST(ord(l) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {byte}), 4294967295)"


_OP13 = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, {_crc("CAST(c AS VARCHAR)")} % 6 AS h, c - c % 100 AS base FROM (SELECT DISTINCT c FROM own)
), walk AS (
  SELECT conv.c, 0 AS part, p, role, text FROM conv JOIN own ON own.c = conv.base WHERE p < h
  UNION ALL SELECT conv.c, 1, p, role, text FROM conv JOIN own ON own.c = conv.c WHERE p >= h
), path AS (
  SELECT conv.c, list({{'role': role, 'text': text}} ORDER BY part, p) FILTER (role IS NOT NULL) AS t FROM conv LEFT JOIN walk USING (c) GROUP BY conv.c
), sized AS (
  SELECT c, coalesce(t, []) AS t, coalesce(len(t), 0) AS n FROM path
), member AS (
  SELECT c, CAST(d AS BIGINT) AS depth, t[1 : d] AS node, d = n AS ends FROM (SELECT c, t, n, unnest(range(0, n + 1)) AS d FROM sized)
), node AS (
  SELECT node, depth, min(c) AS low, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids FROM member GROUP BY node, depth
), kids AS (
  SELECT node[1 : depth - 1] AS node, depth - 1 AS depth, count(*) AS k FROM node WHERE depth > 0 GROUP BY 1, 2
), below AS (
  SELECT a.node, a.depth, count(*) FILTER (kids.k IS NULL) AS leaves, sum(CASE WHEN b.depth > 0 THEN (b.n - 1) * length(b.node[-1].text) ELSE 0 END) AS saved
  FROM node a JOIN node b ON b.node[1 : a.depth] = a.node AND b.depth >= a.depth LEFT JOIN kids ON kids.node = b.node AND kids.depth = b.depth GROUP BY a.node, a.depth
)
SELECT node.low AS conv_id, node.depth, up.low AS parent_conv_id, node.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(node.ids) AS ends_sha256
FROM node JOIN below ON below.node = node.node AND below.depth = node.depth LEFT JOIN kids ON kids.node = node.node AND kids.depth = node.depth
LEFT JOIN node up ON up.depth = node.depth - 1 AND up.node = node.node[1 : node.depth - 1]
"""

# Cheapest repairs row by row: the best (cost, initials) of each state as one text, so that least() finds the cheapest and of those the least.
_INF = "'999999'"


def _add(state: str, cost: str, edit: str) -> str:
    return f"CASE WHEN {state} >= {_INF} THEN {_INF} ELSE lpad(CAST(CAST(substr({state}, 1, 6) AS BIGINT) + {cost} AS VARCHAR), 6, '0') || substr({state}, 7) || '{edit}' END"


def _step() -> str:
    """The states behind a row, before anything is inserted: n (nothing yet), s, u, a."""
    may = lambda condition, value: f"CASE WHEN {condition} THEN {value} ELSE {_INF} END"
    rise = "(CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END)"
    stays = "coalesce(fault, '') NOT IN ('blank', 'duplicate')"
    keep = lambda state, initial: may(f"{stays} AND initial = '{initial}'", _add(state, rise, "K"))
    retag = lambda state: may(stays, _add(state, f"(2 + {rise})", "R"))
    into_u = ", ".join(f"{keep(x, 'u')}, {retag(x)}" for x in ("walk.n", "walk.s", "walk.a"))
    return f"""{_add('walk.n', '3', 'D')} AS n, least({_add('walk.s', '3', 'D')}, {keep('walk.n', 's')}) AS s,
      least({_add('walk.u', '3', 'D')}, {into_u}) AS u, least({_add('walk.a', '3', 'D')}, {keep('walk.u', 'a')}, {retag('walk.u')}) AS a"""


def _inserted(source: str) -> str:
    """The states of ``source`` after insertions: a user turn before an assistant one."""
    return f"""SELECT c, i, n, s, u, least(a, {_add('u', '2', 'I')}) AS a FROM (
      SELECT c, i, n, s, least(u, {_add('n', '2', 'I')}, {_add('s', '2', 'I')}, {_add('a', '2', 'I')}) AS u, a FROM ({source}))"""


_OP11 = f"""
WITH RECURSIVE raw AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm
  FROM conversations
), harmed AS (
  SELECT c, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE harm <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail FROM harmed
), judged AS (
  SELECT c, i, turn, role, text, left(role, 1) AS initial, CASE WHEN tail = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
), size AS (
  SELECT c, max(i) AS last FROM judged GROUP BY c
), walk AS (
  {_inserted(f"SELECT c, CAST(0 AS BIGINT) AS i, '000000' AS n, {_INF} AS s, {_INF} AS u, {_INF} AS a FROM size")}
  UNION ALL
  {_inserted(f"SELECT judged.c, judged.i, {_step()} FROM walk JOIN judged ON judged.c = walk.c AND judged.i = walk.i + 1")}
), best AS (
  SELECT walk.c, CAST(substr(least(n, a), 1, 6) AS BIGINT) AS cost, substr(least(n, a), 7) AS audit FROM walk JOIN size ON size.c = walk.c AND size.last = walk.i
), letter AS (
  SELECT c, j, audit[j] AS edit, len(replace(audit[1 : j], 'I', '')) AS i, len(replace(audit[1 : j], 'D', '')) AS place
  FROM (SELECT c, audit, unnest(range(1, len(audit) + 1)) AS j FROM best)
), turned AS (
  SELECT letter.c, j, place, edit, role, text, max(CASE WHEN edit = 'K' AND place = 1 AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY letter.c) AS system
  FROM letter LEFT JOIN judged ON judged.c = letter.c AND judged.i = letter.i AND edit <> 'I' WHERE edit <> 'D'
), repaired AS (
  SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS text
  FROM turned GROUP BY c
), counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM judged GROUP BY c
), unlike AS (
  SELECT c, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT c, initial, lag(initial) OVER (PARTITION BY c ORDER BY i) AS before FROM judged) GROUP BY c
)
SELECT DISTINCT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM (SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c FROM conversations)
LEFT JOIN counted USING (c) LEFT JOIN unlike USING (c) LEFT JOIN best USING (c) LEFT JOIN repaired USING (c)
"""

_OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT q.k, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.k <> v.k WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST) AS n FROM pair
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""


def _spans(kind: str, place: int, pattern: str, holds: str) -> str:
    """Matches of a pattern in all texts, found between the pieces that they leave; ``holds`` is a condition on the match ``x``."""
    length = lambda items: f"coalesce(list_sum(list_transform({items}, lambda y: length(y))), 0)"
    return f"""SELECT k, '{kind}' AS kind, {place} AS place, start, start + length(x) AS stop FROM (
      SELECT k, m[i] AS x, CAST({length("p[1 : i]")} + {length("m[1 : i - 1]")} AS BIGINT) AS start FROM (
        SELECT k, m, p, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT k, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM doc))) WHERE {holds}"""


def _base_sql(kinds: list[tuple[str, str, str]]) -> str:
    found = " UNION ALL ".join(_spans(kind, place, pattern, holds) for place, (kind, pattern, holds) in enumerate(kinds))
    counts = ", ".join(f"count(kind) FILTER (kind = '{kind}') AS n_{kind}" for kind, _, _ in kinds)
    return f"""WITH doc AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), span AS ({found})
    SELECT doc_id, {counts}, sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place), '')) AS base_sha256
    FROM doc LEFT JOIN span USING (k) GROUP BY k, doc_id"""


_either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
_ASSIGNED = f"(?:{'|'.join(map(_either, ('password', 'passwd', 'secret', 'token', 'api_?key')))})[\"'']?\\x20*[:=]\\x20*[\"'']?"
_NUMBER = "regexp_replace(x, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_NUMBER}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_NUMBER})[i] AS INTEGER)
  ELSE CAST(reverse({_NUMBER})[i] AS INTEGER) * 2 - CASE WHEN CAST(reverse({_NUMBER})[i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_OP3_BASE = _base_sql([
    ("assign", _ASSIGNED + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(x, '^{_ASSIGNED}', '')) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(x) >= 20"), ("hex", "[0-9a-f]+", "length(x) >= 24"),
])
_OP4_BASE = _base_sql([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(x, '.'), lambda y: try_cast(y AS HUGEINT) IS NULL OR try_cast(y AS HUGEINT) > 255)) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_NUMBER}) BETWEEN 12 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_NUMBER}) BETWEEN 9 AND 15"),
])
_OP7_BASE = f"""
WITH doc AS (
  SELECT row_number() OVER () AS k, doc_id, {_crc("coalesce(CAST(doc_id AS VARCHAR), '')")} % 10 = 0 AS held_out, list_append(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), chr(10)) AS w FROM documents
), word AS (
  SELECT w, count(*) AS c FROM (SELECT unnest(w) AS w FROM doc WHERE NOT held_out) GROUP BY w
), total AS (
  SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS v FROM word
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, n AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))), 3) AS base_score
FROM (SELECT k, doc_id, held_out, unnest(w) AS w FROM doc) LEFT JOIN word USING (w), total GROUP BY k, doc_id, held_out, n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op10_minhash_jaccard_join": _OP10, "op2_winnowing_decontamination": _OP2, "op8_site_line_frequency": _OP8,
        "op11_auction_conversation_repair": _OP11, "op12_tiled_top_k": _OP12, "op13_burst_prefix_trie": _OP13,
        "secret_base_spans": _OP3_BASE, "personal_base_spans": _OP4_BASE, "word_base_scores": _OP7_BASE,
    }
