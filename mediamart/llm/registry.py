"""The queries of the thirteen numbered operators: each applies its operator, with
production parameters, to its whole table. ``ORACLES`` has the DuckDB SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.llm import (
    ann_tree,
    bpe,
    chat_format,
    context_tree,
    exact_topk,
    language_mixture,
    packing,
    phrases,
    pii,
    prefix_trie,
    quality_rules,
    simhash_tiles,
    suffix_dedup,
)
from mediamart.llm.common import id_remainder, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.score(docs, model, "score").select(
        "doc_id", (id_remainder("doc_id", quality_rules.LABEL_FOLDS) == quality_rules.HELD_OUT_FOLD).alias("held_out"), "score",
        (F.col("score") >= quality_rules.THRESHOLD).cast("int").alias("predicted"))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, (kept, n_bytes, spans) = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", n_bytes, (F.col(n_bytes) - F.octet_length(kept)).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_mixture.fit(docs)
    found = language_mixture.predict(docs.select("doc_id", "text"), model, "found")
    return found.select(
        "doc_id", (id_remainder("doc_id", language_mixture.FOLDS) == language_mixture.HELD_OUT_FOLD).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, placed = packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)
    return placed


def op7_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.search(table(spark, sf_dir, "embeddings"), k=5, query_mod=50)


def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # the fixed conversation of the contract
    fixed = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.digest(chat_format.format_examples(talks.unionByName(fixed)))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), k=10, query_mod=100)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id", *[F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_bpe_segment_tree": op1_bpe_segment_tree,
    "op2_quality_rules": op2_quality_rules,
    "op3_context_tree": op3_context_tree,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_language_mixture": op5_language_mixture,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_ann_kmeans_tree": op7_ann_kmeans_tree,
    "op8_simhash_tiles": op8_simhash_tiles,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pii": op12_pii,
    "op13_phrases": op13_phrases,
}

_OP9 = r"""
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 13 + length(replace(replace(replace(role || text, '\', '\e'), '<', '\l'), '[', '\b')) AS size FROM talks),
placed AS (
  SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS total
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR nth = total)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""

_OP10 = """
WITH vectors AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
WHERE rank <= 10"""

_OP11 = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, count(*) AS n, c - c % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii(substring(c::VARCHAR, i, 1))::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), list_transform(range(8), lambda i: i::BIGINT)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM turns GROUP BY c),
rebuilt AS (
  SELECT i.c, t.place AS pos, 0 AS part, t.role, t.text FROM ids i JOIN turns t ON t.c = i.base AND t.place <= i.h
  UNION ALL SELECT i.c, t.place, 1, t.role, t.text FROM ids i JOIN turns t ON t.c = i.c AND t.place > i.h),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, count(*) OVER (PARTITION BY c) AS len FROM rebuilt),
paths AS (
  SELECT c, d, len, octet_length(encode(text)) AS size,
    list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS seq FROM placed
  UNION ALL SELECT i.c, 0, coalesce(p.len, 0), 0, [] FROM ids i LEFT JOIN (SELECT DISTINCT c, len FROM placed) p USING (c)),
member AS (SELECT c, d, len, size, min(c) OVER (PARTITION BY d, seq) AS conv_id FROM paths),
nodes AS (
  SELECT conv_id, d, count(*) AS n_convs, (count(*) - 1) * max(size) AS own,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends_sha256 FROM member GROUP BY conv_id, d),
linked AS (SELECT n.*, m.conv_id AS parent_conv_id FROM nodes n LEFT JOIN member m ON m.c = n.conv_id AND m.d = n.d - 1),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
whole AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids k USING (conv_id, d)),
sums AS (
  SELECT m.conv_id, m.d, sum((w.n_children = 0)::BIGINT) AS n_leaves, sum(w.own) AS saved
  FROM whole w JOIN member m ON m.c = w.conv_id AND m.d <= w.d GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM whole JOIN sums USING (conv_id, d)"""

_OP12_RULES = (   # ord, kind, pattern, confirmed, raising, lowering, prior, base
    (0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE", "", "", 0.9, True),
    (1, "ip", r"[0-9]+(?:\.[0-9]+){3}",
     "len(list_filter(string_split(found, '.'), lambda x: len(ltrim(x, '0')) > 3 OR ('0' || right(ltrim(x, '0'), 3))::INT > 255)) = 0", "", "", 0.6, True),
    (2, "card", r"[0-9](?:[ -]?[0-9])+", """len(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1),
      lambda i: CASE WHEN i % 2 = 1 THEN digits[len(digits) - i + 1]::INT ELSE 2 * digits[len(digits) - i + 1]::INT - CASE WHEN digits[len(digits) - i + 1]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0""",
     "", "", 0.6, True),
    (3, "phone", r"\+[0-9][ ().0-9-]+[0-9]", "len(digits) BETWEEN 9 AND 15", "", "", 0.6, True),
    (3, "phone", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
     "NOT regexp_matches(before, '(?:[0-9]|[+][0-9 ().-]*)$') AND NOT regexp_matches(after, '^[0-9]')",
     "tel|phone|call|fax|mobile|cell", "isbn|serial|order|tracking", 0.3, False),
    (4, "iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9])+",
     """span IS NOT NULL AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(substring(found, len(span) + 1) || after, '^[A-Za-z0-9]')
      AND list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substring(replace(span, ' ', ''), 5) || left(span, 4), ''), lambda ch: (strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', ch) - 1)::BIGINT)),
        lambda acc, d: (acc * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1""",
     "iban|account|bank|transfer", "", 0.9, False),
    (5, "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
     "NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]') AND NOT regexp_matches(found, '^(?:000|666|9)|-00-|-0000$')",
     "ssn|social|security|taxpayer", "isbn|serial|order|invoice|part|ticket", 0.5, False),
)


def _op12() -> str:
    def near(words):
        return f"regexp_matches(near_before, '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)') OR regexp_matches(near_after, '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)')"

    parts = []
    for ord_, kind, pattern, confirmed, raising, lowering, prior, base in _OP12_RULES:
        span = ("CASE WHEN found[1:2] IN ({}) THEN nullif(regexp_extract(found, '^(?:[A-Z0-9] ?){{' || (CASE found[1:2] {} END - 1) || '}}[A-Z0-9]'), '') END".format(
            ", ".join(f"'{x[:2]}'" for x in pii.IBAN_LENGTHS.split()), " ".join(f"WHEN '{x[:2]}' THEN {x[2:]}" for x in pii.IBAN_LENGTHS.split()))
            if kind == "iban" else "found")
        score = f"{prior}" + (f" + CASE WHEN {near(raising)} THEN 0.35 ELSE 0 END" if raising else "") + (f" - CASE WHEN {near(lowering)} THEN 0.35 ELSE 0 END" if lowering else "")
        lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        parts.append(f"""
  SELECT DISTINCT rid, {ord_} AS ord, '{kind}' AS kind, {base} AS base, start, start + len(span) AS stop FROM (
    SELECT *, {span} AS span, regexp_replace(found, '[^0-9]', '', 'g') AS digits, {lower.format('before')} AS near_before, {lower.format('after')} AS near_after FROM (
      SELECT rid, f[i] AS found, right(p[i], 40) AS before, left(p[i + 1], 40) AS after, list_sum(list_transform(p[1:i], lambda x: len(x)))
        + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: len(x))), 0) AS start
      FROM (SELECT rid, f, p, unnest(range(1, len(f) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(text, '{pattern}') AS f, string_split(regexp_replace(text, '{pattern}', chr(1), 'g'), chr(1)) AS p
        FROM docs WHERE regexp_matches(text, '{pattern}')))))
  WHERE {confirmed}{'' if base else f' AND {score} >= 0.5'}""")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ".join(parts)}),
each AS (
  SELECT rid, ord, start, stop, bool_or(base) AS base, kind || ':' || start || ':' || stop AS shown FROM spans GROUP BY ALL),
merged AS (
  SELECT rid, {", ".join(f"count(*) FILTER (base AND ord = {i}) AS n_{k}" for i, k in enumerate(("email", "ip", "card", "phone")))},
    coalesce(string_agg(shown, ',' ORDER BY start, ord, stop) FILTER (base), '') AS base_spans,
    string_agg(shown, ',' ORDER BY start, ord, stop) AS spans FROM each GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ("email", "ip", "card", "phone"))},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN merged USING (rid)"""


_OP13 = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split(translate(text, '.,;:!?' || chr(11) || chr(12) || chr(13), repeat(chr(10), 9)), chr(10))) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents)),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) AS ks(k)),
counts AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
words AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
halves AS (
  SELECT lang, k, phrase, f, 1 AS cut, w[1] AS head, array_to_string(w[2:k], ' ') AS tail FROM words
  UNION ALL SELECT lang, k, phrase, f, 2, array_to_string(w[1:2], ' '), w[3] FROM words WHERE k = 3),
cuts AS (
  SELECT h.lang, h.k, h.phrase, h.f AS a, x.f AS l, y.f AS r, cut, (1000000 * h.f * h.f) // (x.f * y.f) AS score
  FROM halves h JOIN counts x ON x.lang = h.lang AND x.phrase = h.head JOIN counts y ON y.lang = h.lang AND y.phrase = h.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covers AS (
  SELECT lang, part AS phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM words WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN covers v ON v.lang = b.lang AND v.phrase = b.phrase
  WHERE b.k = 3 OR v.f IS NULL OR 100 * v.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op9_chat_formatting": _OP9, "op10_exact_top_k": _OP10,
                           "op11_prefix_trie": _OP11, "op12_pii": _op12(), "op13_phrases": _OP13}
