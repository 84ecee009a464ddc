"""Queries of the operators of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, exact_dedup, html_crf, language, minmax, ngram_join, ogg, packing, pii, prefix_trie, runs, substring_dedup, token_files
from riskloom.llm.common import Scratch, table
from riskloom.session import ship

def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; it is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"), html_crf.train())


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.keyed_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), spark, Scratch(spark))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), Scratch(spark))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"), Scratch(spark))


SQL["op8_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) = 1 AS kept, text_sha256
FROM d
"""


@query
def op9_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.features(ogg.column(table(spark, sf_dir, "documents")))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op11_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.link(table(spark, sf_dir, "documents"), Scratch(spark))


def _shingle_links(percent: int, more: str = "") -> str:
    """SQL of documents, their shingle sets' sizes and components of links of ``percent`` or more."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM both_ways UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
root AS (SELECT doc_id, min(other) AS root FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id{more}
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN root ON root.doc_id = d.doc_id
"""


SQL["op3_ngram_jaccard_join"] = _shingle_links(75)
SQL["op11_minmax_near_dedup"] = _shingle_links(85, ", coalesce(root, d.doc_id) = d.doc_id AS kept")


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(table(spark, sf_dir, "documents"), tail=True)


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"), Scratch(spark))


#: Unsigned crc32 of the decimal conv_id: bytes in order, eight steps of the reflected polynomial each.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""
SQL["op13_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, k, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t),
c AS (SELECT conv_id, n, {_CRC32} % 9 AS h FROM (SELECT conv_id, count(*) AS n FROM o GROUP BY 1)),
p AS (SELECT c.conv_id, c.n, h, least(h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN (SELECT conv_id AS base, n FROM c) b ON b.base = c.conv_id - c.conv_id % 5),
r AS (
  SELECT p.conv_id, o.pos, k, bytes FROM p JOIN o ON o.conv_id = p.conv_id - p.conv_id % 5 AND o.pos <= p.h
  UNION ALL SELECT p.conv_id, o.pos - h + taken, k, bytes FROM p JOIN o ON o.conv_id = p.conv_id AND o.pos > h),
m AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM c
  UNION ALL SELECT conv_id, pos, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY pos), bytes FROM r),
l AS (SELECT conv_id, taken + greatest(n - h, 0) AS length FROM p),
nodes AS (
  SELECT path, any_value(m.depth) AS depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own,
         sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (m.depth = length), '')) AS ends_sha256
  FROM m JOIN l USING (conv_id) GROUP BY path),
kids AS (SELECT left(path, -64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
up AS (SELECT left(x.path, 64 * d) AS path, x.own, coalesce(kids.n, 0) = 0 AS leaf FROM nodes x LEFT JOIN kids ON kids.path = x.path, unnest(range(0, x.depth + 1)) u(d)),
sub AS (SELECT path, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, x.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
FROM nodes x JOIN sub ON sub.path = x.path LEFT JOIN kids ON kids.path = x.path LEFT JOIN nodes parent ON x.depth > 0 AND parent.path = left(x.path, -64)
"""
