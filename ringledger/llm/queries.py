"""The registered query of every operator, over its whole table, and expected SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import hmm, langid, warc
from ringledger.llm.bagminhash import near_duplicates
from ringledger.llm.collocations import collocations
from ringledger.llm.common import crc32_mod, prepared, stored, table
from ringledger.llm.decontaminate import find_leaks
from ringledger.llm.lines import line_report
from ringledger.llm.ngram_join import ngram_components
from ringledger.llm.packing import pack_documents
from ringledger.llm.pii import BASE_KINDS, find_pii
from ringledger.llm.quality import judged
from ringledger.llm.secrets import BlobLedger
from ringledger.llm.spelling import spelling_variants
from ringledger.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(prepared(spark), sf_dir)
    return run


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _base_digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.sha2(_listed(F.filter(spans, lambda s: s["kind"].isin(*kinds))), 256)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc32_mod(F.col("doc_id"), 4) == 2
    pieces = vocabulary("byte_bpe_multi_50k.tiktoken")
    langs, p = langid.fit(docs.where(~held_out), pieces)
    found = langid.predict(docs, pieces, langs, p)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 4096 tokens."""
    prepared(spark, times=4)  # the more text in a batch, the fewer words are looked up
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op3_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood of every document, learned from six sevenths of them."""
    prepared(spark, times=4)  # the forward recursion takes as many steps per batch as its longest text has tokens
    held_out = crc32_mod(F.col("doc_id"), 7) == 2
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (~held_out).alias("learn"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return hmm.score(docs).select("doc_id", (~F.col("learn")).alias("held_out"), *names)


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; each document is a path of the ledger, which starts empty."""
    ledger = BlobLedger(spark, scratch_dir(spark, "blob-ledger"))
    found = ledger.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("findings")
    kinds = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[_count(spans, kind).alias(f"n_{kind}") for kind in kinds],
        _base_digest(spans, kinds).alias("base_sha256"),
        _listed(spans).alias("spans"),
        "blob",
    )


@query
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document, with its edit distance."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and the trusted-to-raw ratio of every document."""
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*names, "base_failed", "kept", "score")


@query
def op8_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, read back and assembled into captures."""
    folder = scratch_dir(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = stored(warc.read_archives(spark, folder, with_payload=False), "records")
    captures = warc.resolved(stored(warc.assemble(records), "captures"))
    return captures.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


#: SHA-1 as eight groups of five hex signs, each four base32 signs.
EXPECTED["op8_warc_captures"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, n, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(g * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * k AS BIGINT)) & 31 AS INTEGER), 1)
  ), 'string_agg', '')), 'string_agg', '') AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op9_duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that repeat an earlier line of any document."""
    return line_report(table(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    spans = F.col("spans")
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[_count(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        _base_digest(spans, BASE_KINDS).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The foremost collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))


EXPECTED["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0
), words AS (
  SELECT lang, w[i] AS phrase, count(*) AS f FROM placed GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM words GROUP BY lang
), pairs AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS a FROM placed WHERE i < len(w) GROUP BY ALL HAVING count(*) >= 10
), triples AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS a
  FROM placed WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10
), around AS (
  SELECT lang, w1, w2, max(a) AS longer FROM (
    SELECT lang, w1, w2, a FROM triples UNION ALL SELECT lang, w2, w3, a FROM triples) GROUP BY ALL
), cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.a, 1 AS k, x.f AS l, y.f AS r
  FROM pairs p JOIN words x ON x.lang = p.lang AND x.phrase = p.w1 JOIN words y ON y.lang = p.lang AND y.phrase = p.w2
  LEFT JOIN around z ON z.lang = p.lang AND z.w1 = p.w1 AND z.w2 = p.w2
  WHERE z.longer IS NULL OR 100 * z.longer < 50 * p.a
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, x.f, p.a
  FROM triples t JOIN words x ON x.lang = t.lang AND x.phrase = t.w1
  JOIN pairs p ON p.lang = t.lang AND p.w1 = t.w2 AND p.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, p.a, x.f
  FROM triples t JOIN words x ON x.lang = t.lang AND x.phrase = t.w3
  JOIN pairs p ON p.lang = t.lang AND p.w1 = t.w1 AND p.w2 = t.w2
), scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), cut AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM cut
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of documents with nearly the same three-word shingles, for every document."""
    return ngram_components(table(spark, sf_dir, "documents"))


EXPECTED["op12_ngram_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2]) END) AS shingles
  FROM worded
), shingles AS MATERIALIZED (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS k
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND a.n * 10 >= b.n * 9 AND b.n * 10 >= a.n * 9
  GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT x, y FROM common WHERE 100 * k >= 90 * (nx + ny - k)
), both_ways AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT e.y, r.root FROM reached r JOIN both_ways e ON e.x = r.doc_id WHERE r.root < e.y
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.root AS component_id
FROM sets s JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) m USING (doc_id)
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every longer word with its usual form."""
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The checksum is taken letter by letter: a bigger letter than ASCII has two bytes.
EXPECTED["op13_spelling_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM range(256) r(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run
  FROM documents WHERE text IS NOT NULL
), counted AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS MATERIALIZED (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(named, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h
  FROM counted, crc_table
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 <> 0 THEN run ELSE substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) END AS word
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM words, unnest(range(1, length(word) + 1)) u(i)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.less
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.less
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, m FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains(word, root) AS (
  SELECT word, form FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT c.word, c.root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed LEFT JOIN roots USING (word)
"""
