"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary of byte strings. A word's probability
in a language is the sum, over all ways to cut it into pieces, of the product of their probabilities; the forward
algorithm gives it without listing segmentations. A text's score is the sum over its words, and the language with
the largest score wins. The piece probabilities are fitted by expectation maximisation: forward-backward gives the
expected count of each piece over all segmentations, counts are summed across partitions, and so on for
``ROUNDS`` rounds. A word is a run of letters, in lower case, with a space before it; every single byte is a piece,
so each word has a segmentation.

The fit may read a bounded sample of the labelled rows: about ``TRAIN_DOCS`` per language, chosen by the hash of
the id. Its words are counted by Spark and stay distributed; the driver sees one number per piece and language.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0; so is every text if
nothing could be learned. Ties go to the language that sorts first. Repeated rows and null ids get results of
their own. More than ``MAX_LANGUAGES`` different languages are an error. Very long words are scored whole, with rescaling. Only the id, text and lang columns are read, and lang
only in training.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.common import stored

TRAIN_DOCS = 20_000
ROUNDS = 3
#: A model has a number per piece and language, so its size is bounded by this; more are refused.
MAX_LANGUAGES = 200
#: Added to every expected count.
PRIOR = 0.1
#: Pieces of more bytes are not used.
MAX_PIECE = 12
#: Words of more bytes are scored one by one with rescaling; in training they are cut at this length.
MAX_WORD = 40
#: Numbers a worker keeps for words it has scored, at most.
MAX_KNOWN = 1_600_000
UNKNOWN = "und"

#: A rolling hash of bytes: where it starts, what it is multiplied by per byte and at the end, and the bits it is looked up by.
HASH_START, HASH_STEP, HASH_LAST, HASH_BITS = 0xCBF29CE484222325, 0x100000001B3, 0x9E3779B97F4A7C15, 18

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def spelled(word: str) -> bytes:
    """The bytes to segment; none if no character is a letter (some numerals look like one to the expression)."""
    if not word.isalpha():
        word = "".join(c for c in word if c.isalpha())
    return b" " + word.encode() if word else b""


class Pieces:
    """The vocabulary, and the edges of the segmentation lattice of words."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            known = sorted(p for p in (base64.b64decode(line.split()[0]) for line in lines) if len(p) <= MAX_PIECE)
        # Bytes that are no pieces of the file (there are none in a byte-level one) would leave words without a cut.
        self.ids = {p: i for i, p in enumerate(dict.fromkeys([*known, *(bytes([b]) for b in range(256))]))}
        self.size = len(self.ids)
        # Pieces by a 64-bit hash, and for its first bits where those that begin with them are.
        hashes = np.array([self._hash(p) for p in self.ids], np.uint64)
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have the same hash")
        first_bits = self.hashes >> np.uint64(64 - HASH_BITS)
        self.starts = np.searchsorted(first_bits, np.arange((1 << HASH_BITS) + 1, dtype=np.uint64)).astype(np.int32)

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = HASH_START
        for byte in piece:
            h = ((h ^ byte) * HASH_STEP) & 0xFFFFFFFFFFFFFFFF
        return (h * HASH_LAST) & 0xFFFFFFFFFFFFFFFF

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by their hashes, ``size`` where there is none."""
        first_bits = (hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        at, end = self.starts[first_bits], self.starts[first_bits + 1]
        found = np.full(len(hashes), self.size, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = self.hashes[here] == hashes[left]
            found[left[hit]] = self.order[here[hit]]
            at[left] += 1
            left = left[~hit & (at[left] < end[left])]
        return found

    @staticmethod
    @cache
    def at(path: str) -> Pieces:
        return Pieces(path)

    @staticmethod
    @cache
    def spans(n: int) -> list[tuple[int, int]]:
        return [(i, j) for i in range(n) for j in range(i + 1, min(n, i + MAX_PIECE) + 1)]

    def edges(self, words: list[bytes]) -> np.ndarray:
        """Piece id of each span of equally long words; ``size`` where the span is no piece."""
        n = len(words[0])
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).T.astype(np.uint64)
        hashes = np.empty((len(self.spans(n)), len(words)), np.uint64)
        for s, (i, j) in enumerate(self.spans(n)):
            h = (h if j > i + 1 else np.uint64(HASH_START)) ^ letters[j - 1]
            h *= np.uint64(HASH_STEP)
            hashes[s] = h
        hashes *= np.uint64(HASH_LAST)
        return self._find(hashes.ravel()).reshape(hashes.shape).T

    def forward(self, edges: np.ndarray, n: int, p: np.ndarray) -> list[np.ndarray]:
        """alpha[j]: sum over segmentations of the first j bytes, per word and language; p has a last row of zeros."""
        alpha = [np.ones((len(edges), p.shape[1]))] + [np.zeros((len(edges), p.shape[1])) for _ in range(n)]
        for s, (i, j) in enumerate(self.spans(n)):
            alpha[j] += alpha[i] * p[edges[:, s]]
        return alpha

    def expected(self, words: list[bytes], n_of: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of pieces over the segmentations of equally long words, each seen ``n_of`` times; p is one column."""
        n, edges = len(words[0]), self.edges(words)
        alpha = [a[:, 0] for a in self.forward(edges, n, p[:, None])]
        beta = [np.zeros(len(words)) for _ in range(n)] + [np.ones(len(words))]
        weight = np.empty(edges.shape)
        scale = n_of / alpha[n]
        spans = self.spans(n)
        for s in range(len(spans) - 1, -1, -1):
            i, j = spans[s]
            through = p[edges[:, s]] * beta[j]
            weight[:, s] = through * alpha[i] * scale
            beta[i] += through
        return np.bincount(edges.ravel(), weight.ravel(), self.size + 1)[: self.size]

    def long_word(self, word: bytes, p: np.ndarray) -> np.ndarray:
        """Log probability per language, with the last alphas rescaled at every byte."""
        get, none = self.ids.get, self.size
        alpha, log = [np.ones(p.shape[1])], np.zeros(p.shape[1])
        for j in range(1, len(word) + 1):
            back = len(alpha)
            here = sum(alpha[back - k] * p[get(word[j - k : j], none)] for k in range(1, min(back, MAX_PIECE) + 1))
            log += np.log(here)
            alpha = [a / here for a in alpha[-(MAX_PIECE - 1) :]] + [np.ones(p.shape[1])]
        return log

    def log_probabilities(self, words: list[bytes], p: np.ndarray) -> np.ndarray:
        """One row per word, one column per language; a word without letters is 0."""
        out, by_length = np.zeros((len(words), p.shape[1])), defaultdict(list)
        for at, word in enumerate(words):
            by_length[len(word)].append(at)
        by_length.pop(0, None)
        for n, where in by_length.items():
            if n > MAX_WORD:
                for at in where:
                    out[at] = self.long_word(words[at], p)
                continue
            for k in range(0, len(where), 5000):
                part = where[k : k + 5000]
                out[part] = np.log(self.forward(self.edges([words[at] for at in part]), n, p)[n])
        return out


def count_words(labelled: DataFrame) -> DataFrame:
    """lang, word, n over all rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                    names=["lang", "word", "n"],
                )
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[lang].update(words_of(text))
            if sum(map(len, seen.values())) > 300_000:
                yield from rows()
        yield from rows()

    each = labelled.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected_counts(words: DataFrame, vocabulary: str, langs: list[str], p: np.ndarray) -> np.ndarray:
    """One round's expected counts, summed over all partitions: pieces x languages."""
    shared = words.sparkSession.sparkContext.broadcast(p)
    number = {lang: k for k, lang in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, p = Pieces.at(vocabulary), shared.value
        total = np.zeros((pieces.size, len(langs)))

        def add(rows: Iterable[tuple[str, str, int]]) -> None:
            groups = defaultdict(list)
            for lang, word, n in rows:
                word = spelled(word)
                for at in range(0, len(word), MAX_WORD):
                    part = word[at : at + MAX_WORD]
                    groups[number[lang], len(part)].append((part, n))
            for (k, _), found in groups.items():
                for at in range(0, len(found), 5000):
                    part = found[at : at + 5000]
                    total[:, k] += pieces.expected([w for w, _ in part], np.array([n for _, n in part], float), p[:, k])

        held: list = []
        for batch in batches:
            held += zip(batch["lang"], batch["word"], batch["n"], strict=True)
            if len(held) > 40_000:
                add(held)
                held = []
        add(held)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "weight": total[piece, lang]})

    summed = (
        words.mapInPandas(count, "piece long, lang long, weight double").groupBy("piece", "lang").agg(F.sum("weight").alias("weight"))
    ).toPandas()
    out = np.zeros((len(p) - 1, len(langs)))
    out[summed["piece"], summed["lang"]] = summed["weight"]
    return out


def fit(labelled: DataFrame, vocabulary: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages, and piece probabilities per language with a last row of zeros, from rows of (doc_id, lang, text)."""
    counted = labelled.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1)
    sizes = {r["lang"]: r["n"] for r in counted.collect()}
    langs = sorted(sizes)
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: a model would not fit into the workers")
    if not langs:
        return [], np.zeros((Pieces.at(vocabulary).size + 1, 0))
    steps = 1_000_000
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(steps, max(1, steps * train_docs // n)))])
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < share[F.col("lang")])
    words = stored(count_words(sample), "language-words")
    pieces = Pieces.at(vocabulary)
    p = np.full((pieces.size + 1, len(langs)), 1 / pieces.size)
    p[-1] = 0
    for _ in range(rounds):
        counts = _expected_counts(words, vocabulary, langs, p) + PRIOR
        p[:-1] = counts / counts.sum(axis=0)
    return langs, p


def predict(docs: DataFrame, vocabulary: str, langs: list[str], p: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score (the probability of that language among the learned ones) of every text."""
    slim = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(p)
    room = MAX_KNOWN // max(1, len(langs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, p = Pieces.at(vocabulary), shared.value
        index: dict[str, int] = {}
        logs = np.zeros((0, len(langs)))
        letters = np.zeros(0, bool)
        for batch in batches:
            texts = [words_of(text) for text in batch.column(1).to_pylist()]
            if len(index) > room:
                index, logs, letters = {}, logs[:0], letters[:0]
            new = list(set().union(*texts).difference(index))
            raw = [spelled(word) for word in new]
            index.update(zip(new, range(len(index), len(index) + len(new)), strict=True))
            logs = np.concatenate([logs, pieces.log_probabilities(raw, p)])
            letters = np.concatenate([letters, np.array([bool(w) for w in raw], bool)])
            names, scores = [], []
            for words in texts:
                rows = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                if not langs or not letters[rows].any():
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = logs[rows].sum(axis=0)
                best = int(np.argmax(total))
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names
            )

    return slim.mapInArrow(score, schema)
