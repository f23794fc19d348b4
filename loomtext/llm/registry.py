"""The queries of this subpackage, one per operator, over whole tables; and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.curve_packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), size=2048, end_id=1)


def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.simhash_trie import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_digest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.digest_merge import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op4_langid_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.ordinal_quality import rate

    return rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from loomtext.llm.byte_bpe import encoded

    return encoded(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op7_simhash_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.simhash_votes import edited_likeness

    code = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    out = edited_likeness(table(spark, sf_dir, "documents"), asked=F.col("doc_id") % 20 == 0)
    return out.select("doc_id", "n_chars", "edited_sha256", code("fp").alias("fingerprint"), code("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "near_docs", "near_low")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.surrogates import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", "pii_entities")


def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.secret_forest import scan, train

    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(spark, docs=docs, path="source"), path="source")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.warc import archived

    return archived(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.token_alignment import aligned

    return aligned(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.line_runs import without_common_lines

    out = without_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_blockmax_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtext.llm.blockmax_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_curve_packing, op2_simhash_trie, op3_digest_merge, op4_langid_ftrl, op5_ordinal_quality,
            op6_byte_bpe, op7_simhash_votes, op8_surrogates, op9_secret_forest, op10_warc, op11_token_alignment, op12_line_runs, op13_blockmax_search,
        )
    }


#: Rows of op3: the largest doc_id of texts equal after lower-casing A-Z.
OP3_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

#: Rows of op10: the first of equal payloads of at least 100 bytes is the response, the others revisit it.
OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


#: Rows of op12: keys of lines that ten documents hold lose all their lines.
OP12_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS doc, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS common FROM k LEFT JOIN c ON k.key = c.key),
t AS (SELECT doc, count(*) AS n_lines, count(*) FILTER (WHERE common) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT common), '') AS kept FROM m GROUP BY doc)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM t JOIN d ON t.doc = d.doc
"""

#: Rows of op13: the ten best documents of every item, in whole numbers.
OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
n AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
g AS (SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, g GROUP BY term),
p AS (
  SELECT tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n.n * total) // length))) AS part
  FROM tf JOIN w ON tf.term = w.term JOIN n ON tf.doc_id = n.doc_id, g),
s AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM p JOIN q ON p.term = q.term GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_line_runs": OP12_SQL, "op13_blockmax_search": OP13_SQL, "op3_digest_merge": OP3_SQL, "op10_warc": OP10_SQL}
