"""Packing into fixed-length sequences as vector bin packing.

An example needs tokens, segments and loss-bearing tokens; a sequence has a limit on each. Within a shard one
sequence is open at a time and takes, again and again, the fitting example whose demand has the largest dot
product with what the sequence has left, each dimension weighted by its mean demand; when nothing fits it is
closed. Examples with equal demand form one type, so a choice costs one pass over types, not examples.

Shards are drawn by the hash of a row number, so neither copies nor a hot id gather in one; their number follows
the number of examples, so each stays at about ``SHARD_EXAMPLES``. Documents are cut beforehand: every full
sequence's worth of tokens is a sequence by itself, the rest is an example. Only sizes travel, never token ids.

Defined results: a null or empty text is the end token alone; repeated rows and null ids are examples of their
own; an empty table gives no rows; only the named columns are read. An example that exceeds a limit by itself
gets a sequence of its own. Long texts are tokenized whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.common import stored

SHARD_EXAMPLES = 2000
#: Words a worker remembers the ids of, at most.
MAX_KNOWN = 700_000
END_ID = 2
#: ASCII and Latin-1 letters, and signs that no token joins with them.
_LETTERS, _MARKS = "a-zÀ-ÖØ-öø-ÿ", "#*$%&|,.!?;:()"
_SIGNS = rf"([{_LETTERS}])([{_MARKS}]+)([ \t\n\x0b\x0c\r]|$)"
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[#*$%&|,.!?;:()]+")


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss_tokens: int = 4096


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes, for a tokenizer that drops white space.

    No token of such a tokenizer reaches over white space, so a text's ids are its words' ids in a row. It must
    also ignore the case of letters and never join letters and signs in one token.
    """

    _open: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._keep(pa.array([""]), np.zeros(0, "<u4"), np.zeros(1, np.int64))

    @classmethod
    def at(cls, path: str) -> WordTokenizer:
        """One per worker process and file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _keep(self, words: pa.Array, ids: np.ndarray, count: np.ndarray) -> None:
        """What is known: words, the ids of all of them one after another, and how many ids each has."""
        self.words, self.ids, self.count, self.begin = words, ids, count, np.cumsum(count) - count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin; the last bound is the end.

        Words are told apart once per batch, so of each different one the ids are looked up once and then gathered.
        """
        if len(self.words) > MAX_KNOWN:
            some = self.recent
            ids, _ = _gathered(self.ids, self.begin[some], self.count[some])
            self._keep(self.words.take(pa.array(some)), ids, self.count[some])
        # A run of letters and the signs after it are tokens of their own: words then differ by their letters alone.
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts.view(pa.string())), _SIGNS, r"\1 \2\3")
        words = pc.ascii_split_whitespace(spaced)
        different = words.flatten().dictionary_encode()
        place = pc.index_in(different.dictionary, value_set=self.words)
        if place.null_count:
            new = different.dictionary.filter(place.is_null())
            learned = self._learned(new.view(pa.binary()).to_pylist())
            place = np.where(place.is_valid(), place.fill_null(0), len(self.words) + np.cumsum(place.is_null()) - 1)
            count = np.fromiter(map(len, learned), np.int64, len(learned)) // 4
            ids = np.concatenate([self.ids, np.frombuffer(b"".join(learned), "<u4")])
            self._keep(pa.concat_arrays([self.words, new]), ids, np.concatenate([self.count, count]))
        self.recent = np.append(0, place)
        which = np.asarray(place)[different.indices.to_numpy()]
        ids, bounds = _gathered(self.ids, self.begin[which], self.count[which])
        return ids, bounds[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def _learned(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words, as bytes. Runs of letters or of signs are coded many at a time, as each ends with its only
        end-of-word id."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        found: dict[bytes, bytes] = {}
        for at in range(0, len(plain), 20_000):
            part = plain[at : at + 20_000]
            lines = [b" ".join(part[k : k + 200]).decode() for k in range(0, len(part), 200)]
            coded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(c.ids, "<u4") for c in coded])
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(part):
                flat = ids.tobytes()
                found.update(zip(part, (flat[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        rest = [w for w in words if w not in found]
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            found.update((w, np.array(c.ids, "<u4").tobytes()) for w, c in zip(part, coded, strict=True))
        return [found[w] for w in words]


def _gathered(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat`` one after another, and their bounds."""
    bounds = np.append(0, np.cumsum(count))
    return flat[np.repeat(begin - bounds[:-1], count) + np.arange(bounds[-1])], bounds


def document_pieces(docs: DataFrame, tokenizer: str, limits: Limits = Limits()) -> DataFrame:
    """Documents cut at every ``limits.tokens`` ids, the end id included.

    One row per piece: ``piece`` (a unique number), doc_id, start, length, ids_crc32, doc_tokens, and
    ``loss_tokens``: all ids but the first, which nothing before it predicts.
    """
    size, end = 4 * limits.tokens, np.array([END_ID], "<u4").tobytes()
    slim = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))
    numbers = ("piece", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens")
    schema = T.StructType([slim.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in numbers]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, piece = WordTokenizer.at(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            owner, rows = [], []
            flat, bounds = coder.encode(batch.column(1))
            for at in range(len(batch)):
                ids = memoryview(flat[bounds[at] : bounds[at + 1]].tobytes() + end)
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    n = len(part) // 4
                    rows.append((piece, start // 4, n, zlib.crc32(part), len(ids) // 4, n - 1))
                    owner.append(at)
                    piece += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
            ids_of = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_of, *columns], names=schema.names)

    return slim.mapInArrow(cut, schema)


def conversation_examples(conversations: DataFrame, tokenizer: str, loss_role: str = "assistant") -> DataFrame:
    """One example per conversation: conv_id, tokens (an end id after each turn), segments, loss_tokens."""
    slim = conversations.select(
        F.col("conv_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"), (F.col("role") == loss_role).alias("bears")
    )
    schema = T.StructType([slim.schema["conv_id"], T.StructField("n", T.LongType()), T.StructField("bears", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordTokenizer.at(tokenizer)
        for batch in batches:
            n = pa.array(np.diff(coder.encode(batch.column(1))[1]) + 1, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, batch.column(2)], names=schema.names)

    return (
        slim.mapInArrow(count, schema)
        .groupBy("conv_id")
        .agg(
            F.sum("n").alias("tokens"),
            F.lit(1).cast("long").alias("segments"),
            F.coalesce(F.sum(F.when(F.col("bears"), F.col("n"))), F.lit(0)).alias("loss_tokens"),
        )
    )


def fill(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place within the bin (0, 1, ...) of each row of ``demand``, by the dot-product heuristic."""
    if not len(demand):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    types, kind = np.unique(demand, axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    members = np.split(np.argsort(kind, kind="stable"), np.cumsum(np.bincount(kind))[:-1])
    left = np.array([len(m) for m in members])
    share = types / limits
    weighted = share * share[kind].mean(axis=0)
    bins, places = np.empty(len(demand), np.int64), np.empty(len(demand), np.int64)
    current, room, place = 0, np.ones(len(limits)), 0
    for _ in range(len(demand)):
        fits = (left > 0) & (share <= room + 1e-9).all(axis=1)
        if not fits.any():
            if place:
                current, room, place = current + 1, np.ones(len(limits)), 0
                fits = (left > 0) & (share <= room + 1e-9).all(axis=1)
            if not fits.any():  # larger than a whole bin
                fits = left > 0
        best = int(np.argmax(np.where(fits, weighted @ room, -1.0)))
        left[best] -= 1
        row = members[best][left[best]]
        bins[row], places[row] = current, place
        room, place = room - share[best], place + 1
    return bins, places


def packed(examples: DataFrame, limits: Limits = Limits(), number: str = "piece") -> DataFrame:
    """The examples with ``sequence_id`` and ``offset``.

    ``examples`` has tokens, segments, loss_tokens and a unique ``number`` per row, and comes from a stored
    table, as it is counted first.
    """
    shards = max(1, -(-examples.count() // SHARD_EXAMPLES))
    sizes = examples.select(
        F.pmod(F.xxhash64(number), F.lit(shards)).alias("shard"), F.col(number).alias("number"), "tokens", "segments", "loss_tokens"
    )
    top = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)

    def place(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("number", ignore_index=True)
        bins, places = fill(shard[["tokens", "segments", "loss_tokens"]].to_numpy(float), top)
        shard["sequence_id"] = (int(key[0]) << 32) + bins
        shard = shard.iloc[np.lexsort((places, bins))]
        shard["offset"] = shard.groupby("sequence_id")["tokens"].cumsum() - shard["tokens"]
        return shard[["number", "sequence_id", "offset"]]

    where = sizes.groupBy("shard").applyInPandas(place, "number long, sequence_id long, offset long")
    return examples.join(where.withColumnRenamed("number", number), number)


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = stored(document_pieces(docs, tokenizer, limits), "pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # Odd numbers are full pieces, even ones are packed.
    full = pieces.where(F.col("length") == limits.tokens).withColumns(
        {"sequence_id": 2 * F.col("piece") + 1, "offset": F.lit(0).cast("long")}
    )
    rest = pieces.where(F.col("length") < limits.tokens).withColumns(
        {"tokens": F.col("length"), "segments": F.lit(1).cast("long")}
    )
    return full.select(names).unionByName(
        packed(rest, limits).withColumn("sequence_id", 2 * F.col("sequence_id")).select(names)
    )
