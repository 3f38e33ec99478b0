"""One query for each operator, over whole tables and with production parameters, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import automaton, fingerprints, grid_join, licences, lines, mixing, ngram_join, sharding, spelling, token_counts, toxicity, turns, urls

WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.join(_table(spark, sf_dir, "embeddings"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), keep_ids=False)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lines.judge(docs, lines.fit(docs, _table(spark, sf_dir, "labels")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_embedding_join, op2_document_fingerprints, op3_license_scan, op4_url_filter, op5_toxicity, op6_bpe_encoding,
                            op7_ngram_join, op8_token_counts, op9_mixing, op10_sharding, op11_spelling_variants,
                            op12_quality_rules, op13_conversation_repair)
}


def _op4_sql() -> str:
    fits = []
    for verdict, host, path in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
        fits.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
                    f"THEN {{'rule': '{host}{path}', 'verdict': '{verdict}'}}")
    terms = ", ".join(f"'{t}'" for t in urls.SOFT)
    strict = ", ".join(f"'{t}'" for t in urls.STRICT)
    return f"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded
  FROM pages),
cut AS (
  SELECT page_id, regexp_split_to_array(folded, '[^a-z0-9]') AS words,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
judged AS (
  SELECT *, CASE {' '.join(fits)} END AS found,
    len(list_filter(words, lambda w: w IN ({strict}))) AS strict_hits,
    len(list_distinct(list_filter(words, lambda w: w IN ({terms})))) AS soft_terms
  FROM cut)
SELECT page_id, host, path, found.rule AS rule,
  coalesce(found.verdict, CASE WHEN strict_hits > 0 OR soft_terms >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  strict_hits, soft_terms
FROM judged"""


def _op9_sql() -> str:
    """The same plan; the exponent by plain bisection, a step for each row of a recursive table."""
    t = mixing.Target()
    key = "md5(concat_ws('|', '{seed}', coalesce(source, ''), {epoch}::VARCHAR, {what}))"
    block_key = key.format(seed=t.seed, epoch="epochs", what="block::VARCHAR")
    doc_key = key.format(seed=t.seed, epoch="epochs", what="doc_id::VARCHAR")
    return f"""
WITH RECURSIVE light AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+')) AS n_tokens FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS n_tokens FROM light GROUP BY source HAVING sum(n_tokens) > 0),
whole AS (SELECT sum(n_tokens)::BIGINT AS n FROM totals),
shares AS (SELECT list(n_tokens / n::DOUBLE) AS p FROM totals, whole),
ends AS (SELECT ln(len(p)) AS most, -list_sum(list_transform(p, lambda x: x * ln(x))) AS own FROM shares),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN entropy < own + {t.entropy} * (most - own) THEN low ELSE middle END,
    CASE WHEN entropy < own + {t.entropy} * (most - own) THEN middle ELSE high END
  FROM (SELECT step, low, high, (low + high) / 2 AS middle, most, own,
      ln(list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))))
      - (low + high) / 2 * list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2) * ln(x)))
        / list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) AS entropy
    FROM bisect, shares, ends WHERE step < 45)),
power AS (SELECT round(CASE WHEN most <= own THEN 1 ELSE high END, 9) AS x FROM bisect, ends WHERE step = 45),
sources AS (
  SELECT source, n_tokens, weight, floor(weight * n)::BIGINT AS part, ceil(n_tokens / {t.block})::BIGINT AS n_blocks,
    floor(floor(weight * n) / n_tokens)::BIGINT AS epochs,
    floor(weight * n)::BIGINT - floor(floor(weight * n) / n_tokens)::BIGINT * n_tokens AS rest
  FROM (SELECT source, n_tokens, n, round(pow(n_tokens / n::DOUBLE, x) / sum(pow(n_tokens / n::DOUBLE, x)) OVER (), 9) AS weight
    FROM totals, whole, power)),
placed AS (
  SELECT l.doc_id, l.source, l.n_tokens, weight, n_blocks, epochs, rest,
    ('0x' || substr(md5(l.doc_id::VARCHAR), 1, 15))::BIGINT % n_blocks AS block
  FROM light l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source),
keyed AS (SELECT *, {block_key} AS cut_key, {doc_key} AS doc_key FROM placed),
blocks AS (
  SELECT source, cut_key, rest, size, sum(size) OVER (PARTITION BY source ORDER BY cut_key) AS upto
  FROM (SELECT source, cut_key, rest, sum(n_tokens) AS size FROM keyed WHERE rest > 0 GROUP BY ALL)),
cuts AS (
  SELECT source, min(cut_key) AS cut_block, arg_min(rest - upto + size, cut_key) AS remaining
  FROM blocks WHERE upto >= rest AND upto - size < rest GROUP BY source),
doc_cuts AS (
  SELECT source, min(doc_key) AS cut_doc FROM (
    SELECT k.source, doc_key, remaining, sum(n_tokens) OVER (PARTITION BY k.source ORDER BY doc_key) AS upto
    FROM keyed k JOIN cuts c ON k.source IS NOT DISTINCT FROM c.source AND k.cut_key = c.cut_block)
  WHERE upto >= remaining GROUP BY source),
lasts AS (
  SELECT k.*, CASE WHEN cut_key < cut_block OR (cut_key = cut_block AND doc_key <= cut_doc) THEN epochs ELSE epochs - 1 END AS last
  FROM keyed k LEFT JOIN cuts c ON k.source IS NOT DISTINCT FROM c.source
  LEFT JOIN doc_cuts d ON k.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, weight, epoch, block,
  {key.format(seed=t.seed, epoch="epoch", what="block::VARCHAR")} AS block_key
FROM (SELECT *, unnest(range(0, last + 1))::BIGINT AS epoch FROM lasts)"""


_REACH = """
reach(node, other) AS (
  SELECT rep, rep FROM reps UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
classes AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""


def _op1_sql() -> str:
    return f"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
reps AS (SELECT vec_id AS rep, v FROM good),
both_ways AS (
  SELECT x.rep AS a, y.rep AS b FROM reps x JOIN reps y ON x.rep <> y.rep
  WHERE list_cosine_similarity(x.v, y.v) >= {grid_join.COSINE}),
{_REACH},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id,
  coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN classes ON node = e.vec_id LEFT JOIN counts ON a = e.vec_id"""


def _op7_sql() -> str:
    n = ngram_join.WORDS
    return f"""
WITH RECURSIVE texts AS (
  SELECT coalesce(text, '') AS text, min(doc_id) AS rep, count(*) AS copies FROM documents GROUP BY 1),
reps AS (
  SELECT rep, copies, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS words FROM texts),
grams AS (
  SELECT DISTINCT rep, array_to_string(words[i:i + {n} - 1], ' ') AS gram
  FROM (SELECT rep, words, unnest(range(1, greatest(len(words) - {n} + 2, 2))) AS i FROM reps WHERE len(words) > 0)),
sizes AS (SELECT rep, count(*) AS size FROM grams GROUP BY rep),
shared AS (
  SELECT x.rep AS a, y.rep AS b, count(*) AS common FROM grams x JOIN grams y ON x.gram = y.gram AND x.rep <> y.rep GROUP BY ALL),
both_ways AS (
  SELECT a, b FROM shared JOIN sizes p ON p.rep = a JOIN sizes q ON q.rep = b
  WHERE common >= {ngram_join.THRESHOLD} * (p.size + q.size - common) - 1e-9),
{_REACH},
counts AS (SELECT a, sum(copies) AS n FROM both_ways JOIN reps ON rep = b GROUP BY a)
SELECT d.doc_id, component AS class_id, (copies - 1 + coalesce(n, 0))::BIGINT AS n_links, component = d.doc_id AS kept
FROM documents d JOIN texts t ON t.text = coalesce(d.text, '') JOIN classes ON node = t.rep LEFT JOIN counts ON a = t.rep"""


def _op11_sql() -> str:
    """crc32 over the UTF-8 bytes by its table; near words by deleting one code point from each."""
    table = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.SHORTEST} GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 | (ord(c) >> 6))::BIGINT, (128 | (ord(c) & 63))::BIGINT] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, ({table}::BIGINT[])[xor(c & 255, x) + 1]), 4294967295::BIGINT),
    4294967295::BIGINT) AS h FROM bytes),
damaged AS (
  SELECT n, CASE WHEN h % {spelling.DAMAGE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n AS n FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.rest = y.word),
best AS (SELECT a, count(*) AS n_near, min((-n, b)) AS first FROM pairs GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -first[1] >= {spelling.TIMES} * n THEN first[2] END AS form,
    CASE WHEN -first[1] >= {spelling.TIMES} * n THEN -first[1] END AS form_n
  FROM words LEFT JOIN best ON a = word),
chain AS (
  SELECT word, word AS root, form FROM forms
  UNION ALL SELECT c.word, c.form, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT word, f.form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, root FROM chain WHERE form IS NULL) USING (word)"""


ORACLE: dict[str, str] = {"op11_spelling_variants": _op11_sql(), "op1_embedding_join": _op1_sql(), "op7_ngram_join": _op7_sql(),
                          "op4_url_filter": _op4_sql(), "op9_mixing": _op9_sql()}
