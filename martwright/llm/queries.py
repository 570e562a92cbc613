"""The registered queries of the corpus operators, and their SQL oracles.

Each query applies its operator to the whole of its table and derives the
digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martwright.llm import (fim, jaccard_join, katz, line_dedup, packing, pii, quality, resampling, sentencepiece_codec,
                            simhash, substring_dedup, topk, toxicity)
from martwright.llm.common import documents, only

# Production parameters of the contracts.
MIN_DOCS, MIN_CHARS = 10, 1
TOXIC_HELD_OUT, TOXIC_FROM = (3, 1), 0.7  # crc32(doc_id) mod 3 = 1 never trains
KATZ_HELD_OUT = (7, 2)  # crc32(doc_id) mod 7 = 2 never trains
TOP, SCALE, QUERY_EVERY = 20, 64.0, 20
REPEAT = 13  # words of a window
SHINGLE, DISTANCE = 4, 4
CAPACITY, END_ID = 1024, 2
BUCKETS, FEATURE_WORDS, DRAW_SEED, DRAW_WORDS, DRAW_PERCENT = 10_000, 1, 2024, 20, 10
SIMILAR_WORDS, SIMILAR_PERCENT = 3, 90
FIM_SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(only(documents(spark, sf_dir), "doc_id", "text"))
    spans = F.col("pii")
    return found.select(
        "doc_id", *[pii.count_kind(spans, k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.span_list(spans, base_only=True), 256).alias("base_sha256"),
        pii.span_list(spans).alias("spans"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, r = KATZ_HELD_OUT
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % m == r, F.lit(False))
    return katz.score(documents(spark, sf_dir), held)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = topk.top_k(table, F.col("id") % QUERY_EVERY == 0, TOP, SCALE)
    return found.withColumnRenamed("id", "vec_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    judged = quality.judge(docs, quality.train(docs, _labels(spark, sf_dir)))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each text, digested, and whether decoding them gives the text back."""
    docs = only(documents(spark, sf_dir), "doc_id", "text")
    return sentencepiece_codec.round_trip(docs).select(
        "doc_id", "n_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.col("decoded") == F.coalesce("text", F.lit("")), F.lit(False)).alias("round_trip"))


def toxicity_machine(spark: SparkSession, sf_dir: str) -> toxicity.FactorizationMachine:
    return toxicity.train(documents(spark, sf_dir), _labels(spark, sf_dir), skip_mod=TOXIC_HELD_OUT)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(documents(spark, sf_dir), toxicity_machine(spark, sf_dir))
    m, r = TOXIC_HELD_OUT
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % m == r).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.drop_repeats(documents(spark, sf_dir), REPEAT)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(documents(spark, sf_dir), SHINGLE, DISTANCE)
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), capacity=CAPACITY, end_id=END_ID)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(only(documents(spark, sf_dir), "doc_id", "text"), MIN_DOCS, MIN_CHARS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resampling.resample(documents(spark, sf_dir), target, buckets=BUCKETS, run=FEATURE_WORDS, seed=DRAW_SEED,
                                least_words=DRAW_WORDS, percent=DRAW_PERCENT)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_classes(documents(spark, sf_dir), SIMILAR_WORDS, SIMILAR_PERCENT)
    return linked.withColumnRenamed("id", "doc_id")


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(documents(spark, sf_dir), seed=FIM_SEED, plain_from=PLAIN_FROM, spm_below=SPM_BELOW)
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return fim.restore(made, *columns).drop("restored")


# chr(9) to chr(13) and the space, as DuckDB text
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = f"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM doc),
keyed AS (SELECT doc_id, pos, line, {_LOW.format(f"trim(line, {_WS})")} AS key FROM line),
common AS (SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY doc_id
"""


def _op1_sql() -> str:
    """The same rules over the contract's own patterns, span by span, with the
    context taken from the text by position."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        **{k: pii.PATTERNS[k] for k in ("phone", *pii.MORE)},
        "iban": r"(?:^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}",  # where one can start
    }
    parts = []
    for n, (kind, pattern) in enumerate(plain.items()):
        words = pii.CONTEXT_WORDS[kind]
        parts.append(f"""SELECT doc_id, row, text, {n} AS k, '{kind}' AS kind,
  unnest(regexp_extract_all(text, '{pattern}')) AS hit,
  unnest(string_split_regex(text, '{pattern}')[:-2]) AS before,
  generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS i,
  '(?i)\\b(?:{words})' AS words
FROM doc WHERE regexp_matches(text, '{pattern}')""")
    luhn = ("list_sum([CASE WHEN i % 2 = 0 THEN 2 * d - CASE WHEN d > 4 THEN 9 ELSE 0 END ELSE d END "
            "FOR d, i IN [CAST(x AS INT) FOR x IN string_split(reverse(digits), '')]]) % 10 = 0")
    mod97 = ("CAST(list_reduce([0] || [CAST(ascii(x) AS INT) FOR x IN string_split("
             "substr(plain, 5) || substr(plain, 1, 4), '')], lambda a, c: CASE WHEN c >= 65 "
             "THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) AS INT) = 1")
    usual = ", ".join(f"('{c}', {n})" for n, codes in pii.IBAN_LENGTHS.items() for c in codes.split())
    context, ahead = pii.CONTEXT, 4 + pii.IBAN_AHEAD
    return f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
hit AS ({' UNION ALL '.join(parts)}),
placed AS (
  SELECT *, length(hit) AS n,
         CAST(sum(length(before) + length(hit)) OVER (PARTITION BY row, k ORDER BY i) AS BIGINT) AS stop
  FROM hit),
tested AS (
  SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
         substr(text, greatest(stop - n - {context}, 0) + 1, least(stop - n, {context})) AS b,
         substr(text, stop + 1, {context}) AS a
  FROM placed WHERE kind <> 'iban'),
started AS (
  SELECT row, k, kind, stop - 4 AS start, substr(text, stop - 3, {ahead}) AS near,
         regexp_extract(substr(text, stop - 3, {ahead}), '^(?:\\x20?[A-Z0-9]+)+') AS run
  FROM placed WHERE kind = 'iban'),
cut AS (
  SELECT row, k, kind, start,
         CASE WHEN regexp_matches(substr(near, length(run) + 1, 1), '[a-z]') THEN string_split(run, ' ')[:-2]
              ELSE string_split(run, ' ') END AS parts
  FROM started WHERE regexp_matches(near, '^[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11}}')),
ended AS (
  SELECT row, k, kind, start, j, array_to_string(parts[1:j], '') AS plain
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS j FROM cut)),
whole AS (
  SELECT row, k, kind, start, start + length(plain) + j - 1 AS stop
  FROM (SELECT * FROM ended WHERE length(plain) BETWEEN 15 AND 34) e
  LEFT JOIN (VALUES {usual}) u(country, size) ON country = left(plain, 2) AND size = length(plain)
  WHERE {mod97}
  QUALIFY row_number() OVER (PARTITION BY row, start ORDER BY size IS NULL, length(plain) DESC, j DESC) = 1),
iban AS (  -- from the left, none inside an earlier one
  SELECT row, k, kind, unnest(list_reduce(spans, lambda a, x:
           CASE WHEN x[1].start < a[len(a)].stop THEN a ELSE a || x END)) AS s
  FROM (SELECT row, k, kind, list([{{'start': start, 'stop': stop}}] ORDER BY start) AS spans FROM whole GROUP BY ALL)),
kept AS (
  SELECT row, k, kind, CAST(stop - n AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM tested
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_max([CAST(x AS HUGEINT) FOR x IN string_split(hit, '.')]) <= 255
    WHEN 'card' THEN CASE WHEN length(digits) BETWEEN 13 AND 19 THEN {luhn} ELSE false END
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    ELSE NOT regexp_matches(b, '[0-9+-]$') AND NOT regexp_matches(a, '^[0-9-]')
         AND (regexp_matches(b, words) OR regexp_matches(a, words)) END
  UNION ALL
  SELECT row, k, kind, s.start, s.stop FROM iban),
spans AS (
  SELECT * FROM kept m WHERE k < 4 OR NOT EXISTS (
    SELECT 1 FROM kept o WHERE o.row = m.row AND o.k < 4 AND o.start < m.stop AND m.start < o.stop)),
listed AS (
  SELECT row, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip,
         count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (k < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans
  FROM spans GROUP BY row)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc d LEFT JOIN listed l USING (row)
"""

OP3_SQL = f"""
WITH v AS (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
         FROM v q JOIN v c ON q.vec_id <> c.vec_id
         WHERE q.vec_id % {QUERY_EVERY} = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
                  vec_id, score FROM pair)
SELECT * FROM ranked WHERE rank <= {TOP}
"""


OP11_SQL = f"""
WITH tab AS (SELECT list(list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x:
               CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
word AS (SELECT 'd' AS side, doc_id, rowid AS place, unnest(regexp_extract_all({_LOW.format("text")},
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
         FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
         UNION ALL
         SELECT 'b', NULL, NULL, unnest(regexp_extract_all({_LOW.format("text")},
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
byte AS (SELECT w, [CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS UBIGINT) FOR i IN range(CAST(length(h) // 2 AS BIGINT))] AS b
         FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM word))),
known AS (SELECT w, xor(list_reduce([CAST(4294967295 AS UBIGINT)] || b, lambda a, x:
                 xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1])), 4294967295) % {BUCKETS} AS bucket
          FROM byte, tab),
feature AS (SELECT side, doc_id, place, bucket FROM word JOIN known USING (w)),
total AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM feature GROUP BY bucket),
size AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM total),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS})))) AS BIGINT) AS g
         FROM total, size),
weighed AS (SELECT place, CAST(count(*) AS BIGINT) AS n, CAST(sum(g) AS BIGINT) AS weight
            FROM feature JOIN gain USING (bucket) WHERE side = 'd' GROUP BY place),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{DRAW_SEED}:' || doc_id), 1, 8) AS BIGINT)
                    + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
           FROM (SELECT doc_id, row_number() OVER () AS place FROM documents) LEFT JOIN weighed USING (place)),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n_all
           FROM scored WHERE n_features >= {DRAW_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n_all * {DRAW_PERCENT} // 100 THEN r END AS rank FROM ranked
UNION ALL
SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {DRAW_WORDS}
"""

OP13_SQL = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                    sha256('{FIM_SEED}:' || doc_id) AS h FROM documents),
drawn AS (SELECT doc_id, text, n, [CAST('0x' || substr(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT) FOR i IN range(4)] AS h FROM doc),
formed AS (SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                            OR h[3] % 100 >= {PLAIN_FROM} THEN 'plain'
                       WHEN h[4] % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT *, array_slice(text, 1, a) AS p, array_slice(text, a + 1, b) AS m, array_slice(text, b + 1, n) AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


QUERIES = {
    "op1_pii": op1_pii,
    "op2_katz": op2_katz,
    "op3_topk": op3_topk,
    "op4_quality": op4_quality,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_resampling": op11_resampling,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_fim": op13_fim,
}

ORACLE = {
    "op1_pii": _op1_sql(),
    "op3_topk": OP3_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_resampling": OP11_SQL,
    "op13_fim": OP13_SQL,
}
