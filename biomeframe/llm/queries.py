"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biomeframe.llm import (
    chat, decontaminate, htmltext, langid, lmscore, packing, periodic, quality, simhash, tokenfiles, toxicity, warc,
    whitening,
)
from biomeframe.llm.common import table, words
from biomeframe.session import stored


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    pairs = decontaminate.contained_items(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return pairs.groupBy("doc_id", "item_id").agg(
        F.max(F.col("n_found").cast("long")).alias("n_found"),
        F.max(F.col("n_shingles").cast("long")).alias("n_shingles"),
        F.max("containment").alias("containment"),
    )


def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def op3_simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents")).drop("fp", "text_hash")


def op4_chat_format(spark: SparkSession, d: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(rows.unionByName(extra))
    return chat.digests(stored(formatted, "chat"))


def op5_token_files(spark: SparkSession, d: str) -> DataFrame:
    # This tokenizer drops white space and never looks across it.
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, d, "documents")
    return tokenfiles.tokenised(docs, path, end_id=1, by_word=True)


def op6_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archived(table(spark, d, "pages")).drop("payload", "url")


def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.train(docs.filter(~held_out))
    return langid.predict(docs, model, extra=held_out).withColumnRenamed("extra", "held_out")


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_report(table(spark, d, "documents")).drop("c1", "c2")


def op9_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lmscore.pseudo_likelihood(table(spark, d, "documents"))


def op10_html_text(spark: SparkSession, d: str) -> DataFrame:
    return htmltext.extract_text(table(spark, d, "pages"))


def op11_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.train(docs, labels.filter(~held_out))
    return toxicity.score(docs, model, extra=held_out).withColumnRenamed("extra", "held_out")


def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"))


def _repetitive(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents the words from a place on repeat the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    some = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    n = F.size("w")
    g = F.floor(F.col("h") / 10)
    placed = some.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn(
        "p", (F.floor((n - F.col("a")) / (3 + g % 8)) + 1).cast("int")
    )
    left = n - F.col("a")
    unit = F.slice("w", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    whole = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(n > 0, whole).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    found = periodic.periodic_runs(_repetitive(table(spark, d, "documents")))
    # The longest run; of several the first, then that of the smallest period.
    best = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    length, start, period = -best["col1"], best["start"], best["period"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_token_files": op5_token_files,
    "op6_warc": op6_warc,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_score": op9_lm_score,
    "op10_html_text": op10_html_text,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_LEADS = " || ' ' || ".join(f"lead(x, {k}) OVER (PARTITION BY r ORDER BY i)" for k in range(1, 5))

_OP1 = f"""
WITH item_words AS (
  SELECT row_number() OVER () AS r, item_id, {_WORDS.format("lower(text)")} AS w
  FROM benchmark WHERE text IS NOT NULL
), item AS (
  SELECT DISTINCT item_id, x || ' ' || {_LEADS} AS s
  FROM (SELECT r, item_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM item_words)
  QUALIFY s IS NOT NULL
  UNION SELECT item_id, array_to_string(w, ' ') FROM item_words WHERE len(w) BETWEEN 1 AND 4
), sizes AS (
  SELECT item_id, count(*) AS n FROM item GROUP BY item_id
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("lower(text)")} AS w
  FROM documents WHERE text IS NOT NULL
), doc AS (
  SELECT DISTINCT doc_id, x || ' ' || {_LEADS} AS s
  FROM (SELECT r, doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM doc_words)
), hit AS (
  SELECT doc_id, item_id, count(*) AS n_found FROM doc JOIN item USING (s) GROUP BY ALL
)
SELECT doc_id, item_id, n_found, n AS n_shingles, n_found / n AS containment
FROM hit JOIN sizes USING (item_id) WHERE 5 * n_found >= 4 * n
"""

_STEP = """d{k} AS (
  SELECT b.i AS j, min((a.cost + b.len * (b.upto - a.upto)) * 4096 + a.i) AS key,
    min(a.cost + b.len * (b.upto - a.upto)) AS cost, any_value(b.len) AS len,
    any_value(b.upto) AS upto
  FROM (SELECT j AS i, cost, upto FROM d{p}) a JOIN cell b ON a.i < b.i GROUP BY b.i
  UNION ALL SELECT 0, 0, 0, 0, 0
)"""
_BACK = """SELECT {k} AS step, c.len AS bound, c.key % 4096 AS prev
  FROM d{k} c JOIN b{n} ON c.j = b{n}.prev WHERE c.j > 0"""


def _op2() -> str:
    """The dynamic programme unrolled: one CTE for each number of buckets."""
    k = packing.BUCKETS
    steps = ", ".join(_STEP.format(k=i, p=i - 1) for i in range(1, k + 1))
    back = f"b{k + 1} AS (SELECT max(i) AS prev FROM cell)"
    for i in range(k, 0, -1):
        back += f", b{i} AS ({_BACK.format(k=i, n=i + 1)})"
    union = " UNION ALL ".join(f"SELECT bound, prev FROM b{i}" for i in range(1, k + 1))
    return f"""
WITH n AS (
  SELECT doc_id, len({_WORDS.format("coalesce(text, '')")}) AS n FROM documents
), piece AS (
  SELECT doc_id, piece, least(n - piece * {packing.MAX_TOKENS}, {packing.MAX_TOKENS}) AS n_tokens
  FROM (SELECT *, unnest(range(greatest((n + {packing.MAX_TOKENS - 1}) // {packing.MAX_TOKENS}, 1)))
    AS piece FROM n)
), cell AS (
  SELECT row_number() OVER (ORDER BY n_tokens) AS i, n_tokens AS len,
    sum(count(*)) OVER (ORDER BY n_tokens) AS upto
  FROM piece WHERE n_tokens > 0 GROUP BY n_tokens
), d0 AS (SELECT 0 AS j, 0 AS key, 0 AS cost, 0 AS len, 0 AS upto),
{steps}, {back}, bucket AS (
  SELECT DISTINCT bound FROM ({union})
), placed AS (
  SELECT doc_id, piece, n_tokens,
    (SELECT min(bound) FROM bucket WHERE bound >= n_tokens) AS bound
  FROM piece WHERE n_tokens > 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bound ORDER BY doc_id, piece, n_tokens) - 1 AS r,
    greatest({packing.BATCH_TOKENS} // bound, 1) AS slots FROM placed
)
SELECT doc_id, piece, n_tokens, CAST(bound AS BIGINT) AS bucket_len,
  CAST(r // slots AS BIGINT) AS batch, CAST(r % slots AS BIGINT) AS slot FROM numbered
UNION ALL SELECT doc_id, piece, n_tokens, NULL, NULL, NULL FROM piece WHERE n_tokens = 0
"""


_OP8 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), pos AS (
  SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM doc
), gram AS (
  SELECT a.r, a.i, a.x || ' ' || b.x || ' ' || c.x AS g
  FROM pos a JOIN pos b ON b.r = a.r AND b.i = a.i + 1 JOIN pos c ON c.r = a.r AND c.i = a.i + 2
), twice AS (
  SELECT r, i FROM gram QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), line AS (
  SELECT r, host, text, l, regexp_replace(regexp_replace(
    trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')), '[\x20\x09-\x0D]+', ' ', 'g'),
    '\d+', '0', 'g') AS norm
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM line GROUP BY r
), hosts AS (
  SELECT host, count(DISTINCT text) AS host_docs FROM doc GROUP BY host
), frequent AS (
  SELECT host, norm FROM line JOIN hosts USING (host) GROUP BY host, norm, host_docs
  HAVING count(DISTINCT text) > {quality.MAX_DOCS}
    AND count(DISTINCT text) > host_docs * CAST({quality.MAX_SHARE} AS DOUBLE)
), gone AS (
  SELECT r, sum(length(norm) - length(replace(norm, ' ', '')) + 1) AS n
  FROM line JOIN frequent USING (host, norm) GROUP BY r
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM doc LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (removed_words > 0 AND (
    n_words - removed_words < n_words * CAST({quality.MIN_KEPT_SHARE} AS DOUBLE)
    OR n_words - removed_words < {quality.MIN_KEPT_WORDS})) AS kept
FROM measured
"""

_OP4 = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, length(text) + length(text) - length(translate(text, '[<' || chr(92), '')) + CASE role
    WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 8
    ELSE 20 + length(coalesce(role, '')) END AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_BASE32 = " || ".join(
    f"substr('{warc.BASE32}', CAST((('0x' || substr(h, {5 * k + 1}, 5))::INT >> {s}) & 31 AS INT) + 1, 1)"
    for k in range(8) for s in (15, 10, 5, 0)
)
_OP6 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), o AS (SELECT html, max(page_id) AS owner FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM p JOIN o USING (html)
"""

# CRC-32 of a column's decimal digits: each byte is mixed in, then eight steps of one bit (marked -1).
_CRC = """xor(list_reduce(flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
    FOR c IN string_split(CAST({} AS VARCHAR), '')]), lambda acc, x:
    CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END, 4294967295), 4294967295)"""

_GRAM = " || ' ' || ".join(f"w[i + {k}]" for k in range(5))

# Places at a distance p with the same five words: a stretch of n such places is a run of n + 4 + p words.
_OP13 = f"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, {_CRC.format("doc_id")} AS h,
    {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), place AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM raw
), doc AS (
  SELECT r, doc_id, CASE WHEN a < len(w) THEN w[1 : a] || list_transform(range(len(w) - a), lambda k:
    w[a + 1 + k % (1 + (len(w) - a) // (3 + (h // 10) % 8))]) ELSE w END AS w FROM place
), gram AS (
  SELECT r, i - 1 AS i, {_GRAM} AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) > 5)
), repeated AS (
  SELECT * FROM gram QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), pair AS (
  SELECT x.r, x.i, y.i - x.i AS p,
    x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS island
  FROM repeated x JOIN repeated y ON x.r = y.r AND x.g = y.g AND x.i < y.i
), stretch AS (
  SELECT r, min(i) AS start, count(*) + 4 + p AS length, p FROM pair GROUP BY r, p, island
), run AS (
  SELECT r, start, length, min(p) AS period FROM stretch
  WHERE length >= 6 AND length >= 4 * p GROUP BY r, start, length
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run
), gone_list AS (
  SELECT r, list(i) AS gone FROM gone GROUP BY r
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS text FROM (
    SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM doc JOIN gone_list USING (r)
  ) ANTI JOIN gone USING (r, i) GROUP BY r
), digest AS (
  SELECT r, count(*) AS n_runs, min(struct_pack(l := -length, s := start, p := period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.p AS period,
  1000 * -best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN digest.r IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.text, '') END) AS collapsed_sha256
FROM doc LEFT JOIN digest USING (r) LEFT JOIN kept USING (r)
"""

ORACLES = {"op1_decontamination": _OP1, "op2_packing": _op2(), "op4_chat_format": _OP4, "op6_warc": _OP6,
           "op8_quality_rules": _OP8, "op13_periodic_runs": _OP13}
