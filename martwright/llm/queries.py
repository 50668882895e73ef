"""The registered queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_file
from pyspark.sql import DataFrame, SparkSession

from martwright.llm import bpe, collocations, decontaminate, exact_dedup, licences, line_dedup, pii, quality, sharding, simhash, token_counts, token_store, vector_codes
from martwright.llm.common import documents, on_workers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# XXH64, CRC-32, tokenizers and fitted models are beyond the SQL engine; tests/llm has plain loops for
# the operators without SQL.
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = on_workers(run)
    return run


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder), words=3, bits=3)


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), tokenizer_file("word_bpe_49k.json"))


@query
def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.crcs(documents(spark, folder), tokenizer_file("byte_bpe_50k.json"), end_id=2)


@query
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


@query
def op6_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(documents(spark, folder), shards=8)


@query
def op7_quality_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return quality.scores(docs, quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(documents(spark, folder))


@query
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query
def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return licences.report(docs, licences.fit(docs))


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(documents(spark, folder))


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compressed(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


@query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), tokenizer_file("piece_bpe_32k.model"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE["op9_decontaminate"] = f"""WITH
doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(ws)) AS n, list_slice(ws, p, p + least(13, len(ws)) - 1) AS win
  FROM item, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) t(p) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, p, n, list_slice(ws, p, p + n - 1) AS win
  FROM doc, sizes, unnest(range(1, len(ws) - n + 2)) t(p) WHERE len(ws) >= n),
hits AS (SELECT doc_id, p, n, item FROM places JOIN windows USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hits, unnest(range(0, n)) t(k) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
ORACLE["op10_exact_dedup"] = """SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM (SELECT *, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
      FROM documents WINDOW same AS (PARTITION BY coalesce(text, '')))"""

_PIECES = r"""string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"""
ORACLE["op12_collocations"] = f"""WITH
piece AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents),
line AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM piece),
total AS (SELECT lang, sum(len(ws)) AS n FROM line GROUP BY lang),
gram AS (SELECT lang, list_slice(ws, p, p + m - 1) AS ws, m FROM line, unnest(range(1, 5)) s(m), unnest(range(1, len(ws) - m + 2)) t(p)),
freq AS (SELECT lang, m, array_to_string(ws, ' ') AS phrase, ws, count(*) AS f FROM gram GROUP BY lang, m, ws HAVING count(*) >= 30),
cut AS (SELECT c.lang, c.m, c.phrase, c.f AS a, k, a.f AS l, b.f AS r,
    (2000000 * CAST(c.f AS HUGEINT)) // (CAST(a.f AS HUGEINT) + b.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM freq WHERE m > 1) c
  JOIN freq a ON a.lang = c.lang AND a.ws = list_slice(c.ws, 1, k)
  JOIN freq b ON b.lang = c.lang AND b.ws = list_slice(c.ws, k + 1, c.m)),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(list_slice(ws, p, p + q - 1), ' ') AS phrase, max(f) AS longer
  FROM freq, unnest(range(2, 4)) s(q), unnest(range(1, m - q + 2)) t(p) WHERE q < m GROUP BY ALL),
ranked AS (SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


def _nearest(name: str, book: str) -> str:
    """Each part's nearest entry of a codebook, the lower of equal ones."""
    return f"""{name} AS (SELECT vec_id, label, p, any_value(v) AS v, min(o).e AS e, min(o).d AS d FROM (
  SELECT part.*, {{'d': list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(part.v, b.v)]), 'e': b.e}} AS o
  FROM part JOIN {book} b USING (p)) GROUP BY vec_id, label, p)"""


def _means(name: str, book: str, chosen: str) -> str:
    """The codebook after a round: floored means, entries that nobody chose as before."""
    return f"""{name} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT p, e, i, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {chosen}) GROUP BY p, e, i)
  GROUP BY p, e) m USING (p, e))"""


ORACLE["op11_vector_codes"] = f"""WITH
kept AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
part AS (SELECT vec_id, label, p, list_slice(q, p * len(q) // 16 + 1, (p + 1) * len(q) // 16) AS v FROM kept, unnest(range(0, 16)) t(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
book0 AS (SELECT p, e, v FROM part JOIN first USING (vec_id)),
{_nearest("chosen0", "book0")}, {_means("book1", "book0", "chosen0")},
{_nearest("chosen1", "book1")}, {_means("book2", "book1", "chosen1")},
{_nearest("chosen2", "book2")},
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
coded AS (SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM chosen2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, sha"""
