"""Quality rules: per-text rules, and a log-likelihood ratio of hashed n-grams between trusted and raw text.

Everything is DataFrame expressions; the only exchange is that of one row per hash bucket.

Two multinomials over ``BUCKETS`` hash buckets of word unigrams and bigrams are counted: one over trusted
documents, one over all, scaled to the same total. Both have ``PSEUDO`` added to every bucket, so n-grams too rare
to tell weigh little. A document's score is the mean of log p(trusted) - log p(raw) over its n-grams, so length
cancels out. Junk makes its n-grams more common in the raw corpus than in trusted text and scores below
zero; clean text scores near or above it. Every document whose score is at least ``THRESHOLD`` is kept.

Defined results: a null or empty text has no words, scores 0 and fails the rule on words. Without any trusted
document the ratio says nothing: every score is 0. Rows are independent: repeated rows get equal results, a
null id too. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import SPACE, let

BUCKETS = 1 << 14
#: Natural-log units per n-gram.
THRESHOLD = -0.2
PSEUDO = 10.0
#: Trusted documents the target multinomial is fitted on, at most; the raw one covers every document.
MAX_TRUSTED = 50_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Words and runs of other signs, as n-gram units.
_UNITS = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more in the text.

    Where no two windows have the same 64-bit hash, there is none. Else windows are sorted by half of it, packed with their
    place into one number, and those with an equal neighbour by all of it. So equal windows become neighbours, and
    neighbours count as equal only if their words are.
    """

    def of_sorted(ws: Column, windows: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            equal = a["h"] == b["h"]
            for k in range(3):
                equal = equal & (F.get(ws, a["i"] + k) == F.get(ws, b["i"] + k))
            return F.coalesce(equal, F.lit(False))

        hits = F.transform(
            F.filter(windows, lambda x, n: same(x, F.get(windows, n - 1)) | same(x, F.get(windows, n + 1))), lambda x: x["i"]
        )
        return let(
            F.sort_array(hits),
            lambda at: F.aggregate(
                F.transform(at, lambda p, n: F.least(F.lit(3), F.coalesce(F.get(at, n + 1) - p, F.lit(3)))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, 31) == F.shiftright(y, 31), F.lit(False))

    def of_windows(ws: Column, hashes: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.shiftleft(h, 31).bitwiseOR(i.cast("long")))
        often = let(F.sort_array(marked), lambda m: F.filter(m, lambda x, n: alike(x, F.get(m, n - 1)) | alike(x, F.get(m, n + 1))))
        places = F.transform(often, lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
        placed = F.transform(places, lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i")))
        found = let(F.sort_array(placed), lambda windows: of_sorted(ws, windows))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)

    def of_hashes(ws: Column, hashes: Column) -> Column:
        first = F.slice(hashes, F.lit(1), F.size(hashes) - 2)
        windows = F.transform(first, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))
        return let(windows, lambda found: of_windows(ws, found))

    def of_words(ws: Column) -> Column:
        hashes = F.transform(ws, lambda w: F.xxhash64(w))
        return let(hashes, lambda h: F.when(F.size(ws) < 4, F.lit(0).cast("long")).otherwise(of_hashes(ws, h)))

    return let(words, of_words)


def rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed instead of its text."""
    body = F.coalesce(F.col(text), F.lit(""))
    measured = docs.withColumn(
        "_rules",
        let(
            words_of(body),
            lambda ws: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.length(F.concat_ws("", ws)).cast("long").alias("word_chars"),
                repeated_words(ws).alias("n_repeat_words"),
            ),
        ),
    ).withColumns(
        {
            "n_symbols": F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": let(
                F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]")),
                lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            ),
        }
    )
    counts = measured.withColumns({name: F.col(f"_rules.{name}") for name in ("n_words", "word_chars", "n_repeat_words")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counts.withColumn("base_failed", failed).drop("_rules")


def buckets_of(text: Column) -> Column:
    """Hash buckets of a text's lower-cased unigrams and bigrams."""
    units = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_UNITS), F.lit(0))

    def bucket(value: Column) -> Column:
        return value.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")

    def grams(h: Column) -> Column:
        ones = F.transform(h, bucket)
        first = F.slice(h, F.lit(1), F.size(h) - 1)
        twos = F.transform(first, lambda x, i: bucket(F.xxhash64(x, F.get(h, i + 1))))
        return F.when(F.size(h) < 2, ones).otherwise(F.concat(ones, twos))

    return let(F.transform(units, lambda u: F.xxhash64(u)), grams)


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents: good and not toxic; at most ``limit``, chosen by the hash of the id."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit_ratio(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRUSTED) -> list[float]:
    """log p(trusted) - log p(raw) per bucket.

    What comes to the driver is one row per bucket, a fixed number.
    """
    trusted = F.broadcast(trusted_ids(labels, limit).select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted")))
    grams = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(trusted, "_id", "left")
        .select(F.coalesce("_trusted", F.lit(0)).alias("_trusted"), F.explode(buckets_of(F.col("_text"))).alias("_bucket"))
    )
    counted = grams.groupBy("_bucket").agg(F.count("*").alias("raw"), F.sum("_trusted").alias("target")).collect()
    scale = sum(row["target"] for row in counted) / max(1, sum(row["raw"] for row in counted))
    ratio = [0.0] * BUCKETS
    for row in counted:
        ratio[row["_bucket"]] = math.log(row["target"] + PSEUDO) - math.log(row["raw"] * scale + PSEUDO)
    return ratio


def scored(docs: DataFrame, ratio: list[float], text: str = "text") -> DataFrame:
    """The table with ``score``: the mean log ratio of the text's n-grams, 0 if it has none."""
    weights = F.from_json(F.lit(json.dumps(ratio)), "array<double>")

    def mean(grams: Column) -> Column:
        total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
        return F.when(F.size(grams) == 0, F.lit(0.0)).otherwise(total / F.size(grams))

    return docs.withColumn("score", let(buckets_of(F.col(text)), mean))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, measures, ``score``, and ``kept``: no base rule failed and score >= threshold."""
    ratio = fit_ratio(docs, labels)
    slim = docs.select("doc_id", "text")
    found = rules(scored(slim, ratio)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return found.drop("text")


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns as they were."""
    ratio = fit_ratio(docs, labels)
    names = docs.columns
    inner = F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row")
    found = rules(scored(docs.select(inner, F.col("text").alias("_text")), ratio, "_text"), "_text")
    return found.where(~F.col("base_failed") & (F.col("score") >= threshold)).select(
        *[F.col(f"_row.`{n}`").alias(n) for n in names]
    )
