"""Document likelihoods under a hidden Markov language model.

Tokens are words (lower case for A-Z) and one end token per document. Each token belongs to a class: each of the
``CLASSES`` most frequent tokens is a class of its own, all others share classes by the hash of their last bytes. The
model is a hidden Markov chain of ``STATES`` states that emit classes, times the probability of a token within its
class:

    P(tokens) = sum over state paths of  start(s1) emit(c1|s1) step(s2|s1) emit(c2|s2) ...  x  prod P(token | class)

The chain is trained by Baum-Welch: every round passes over all training documents in windows of ``WINDOW``
tokens, expected counts are summed within each partition and then across them, and the driver sees only the
model, whose size is fixed. States start from the clusters of the most frequent tokens by their neighbours, so a
few rounds are enough. Scoring runs the scaled forward recursion over the whole document, so its likelihood is
exact. P(token | class) is the token's count over the class's, with room for unseen tokens in proportion to the
tokens the class has shown once. The count table of all tokens stays distributed: rare tokens of a document meet
it in a join, already summed per document and token.

Defined results: a null or empty text is the end token alone; repeated rows and null ids get results of their
own. Without training documents every score equals the base score, which is that of a uniform token. Only id and
text are read. Texts of any length are scored whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored

CLASSES = 20_000
SHARED = 1024
STATES = 8
WINDOW = 128
ROUNDS = 3
#: Tokens whose neighbours tell the first states.
SEEDS = 1000
#: The end of a document; no word equals it, as words have no white space.
END = b"\n"


def tokens_of(text: bytes | None) -> list[bytes]:
    """bytes.split() splits at exactly the ASCII white space of the contract; bytes.lower() changes A-Z only."""
    return [*(text.lower().split() if text else ()), END]


def shared_class(token: bytes) -> int:
    return zlib.crc32(token[-3:]) % SHARED


def count_tokens(docs: DataFrame) -> DataFrame:
    """token (binary), n over all rows of a binary column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"]
            )
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens_of(text))
            if len(seen) > 400_000:
                yield rows()
        yield rows()

    return docs.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """All of it is of a size that does not depend on the corpus."""

    classes: dict[bytes, int]  # frequent token -> class
    log_within: np.ndarray  # log10 of 1 for frequent classes; of 1 / (count + once) for shared ones
    once: np.ndarray  # per class, the mass of one unseen token
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # classes x states

    @property
    def size(self) -> int:
        return len(self.emit)


def _classes(docs: DataFrame, model: Model) -> DataFrame:
    """Every document as its tokens' classes, with a number of its own and its rare tokens counted."""
    shared = docs.sparkSession.sparkContext.broadcast(model.classes)
    schema = "row long, doc_id {}, learn boolean, classes array<int>, rare array<struct<token:binary,n:long>>".format(
        docs.schema["doc_id"].dataType.simpleString()
    )
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            each = [tokens_of(text) for text in batch.column("text").to_pylist()]
            tokens, sizes, n = list(chain.from_iterable(each)), np.array([len(t) for t in each], np.int64), len(each)
            found = np.fromiter(map(classes.get, tokens, repeat(-1)), np.int32, len(tokens))
            # Rare tokens are told apart once per batch, then counted per document.
            unknown = np.flatnonzero(found < 0)
            rare = pa.array([tokens[at] for at in unknown], pa.binary()).dictionary_encode()
            different = rare.dictionary.to_pylist()
            code = rare.indices.to_numpy().astype(np.int64)
            found[unknown] = len(classes) + np.array([shared_class(t) for t in different], np.int32)[code] if len(code) else 0
            owner = np.repeat(np.arange(n), sizes)[unknown]
            pairs, times = np.unique(owner * max(1, len(different)) + code, return_counts=True)
            which = pa.array(pairs % max(1, len(different)))
            counted = pa.StructArray.from_arrays([rare.dictionary.take(which), pa.array(times, pa.int64())], ["token", "n"])
            begins = np.searchsorted(pairs, np.arange(n + 1) * max(1, len(different)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + n), pa.int64()),
                    batch.column("doc_id"),
                    batch.column("learn"),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(found)),
                    pa.ListArray.from_arrays(pa.array(begins, pa.int32()), counted),
                ],
                names=["row", "doc_id", "learn", "classes", "rare"],
            )
            row += n

    return docs.select("doc_id", "learn", "text").mapInArrow(read, schema)


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's sequences cut into windows: a matrix filled up with -1, window lengths, and which begin a document."""
    lists = batch.column("classes")
    flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    lengths = np.diff(offsets)
    pieces = -(-lengths // WINDOW)
    first = np.repeat(offsets[:-1], pieces)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = first + nth * WINDOW
    size = np.minimum(WINDOW, np.repeat(offsets[1:], pieces) - begin)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    matrix = np.where(inside, flat[np.minimum(at, max(0, len(flat) - 1))], -1) if len(flat) else np.zeros((0, WINDOW), int)
    order = np.argsort(-size, kind="stable")
    return matrix[order], size[order], (nth == 0)[order]


def expected_counts(
    matrix: np.ndarray, size: np.ndarray, begins: np.ndarray, model: Model
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, steps and emissions of windows sorted by falling length, and their log likelihood."""
    states, (rows, width) = len(model.start), matrix.shape
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(width)]  # windows longer than t
    rest = model.start @ np.linalg.matrix_power(model.step, 64)
    alpha, emitted, scale = [], [], []
    ahead = np.where(begins[:, None], model.start, rest)
    log = 0.0
    for t in range(width):
        n = live[t]
        if not n:
            break
        e = model.emit[matrix[:n, t]]
        a = ahead[:n] * e
        c = a.sum(axis=1, keepdims=True)
        a /= c
        log += float(np.log(c).sum())
        alpha.append(a)
        emitted.append(e)
        scale.append(c)
        ahead = a @ model.step
    starts, steps = np.zeros(states), np.zeros((states, states))
    gamma = [None] * len(alpha)
    beta = np.ones((live[len(alpha) - 1], states)) if alpha else None
    for t in range(len(alpha) - 1, -1, -1):
        if t < len(alpha) - 1:
            n = live[t + 1]
            carried = emitted[t + 1] * beta / scale[t + 1]
            steps += (alpha[t][:n].T @ carried) * model.step
            beta = np.concatenate([carried @ model.step.T, np.ones((live[t] - n, states))])
        gamma[t] = alpha[t] * beta
    if alpha:
        starts = gamma[0][begins].sum(axis=0)
    tokens = np.concatenate([matrix[: live[t], t] for t in range(len(alpha))]) if alpha else np.zeros(0, int)
    weights = np.concatenate(gamma) if alpha else np.zeros((0, states))
    emissions = np.stack([np.bincount(tokens, weights[:, k], model.size) for k in range(states)], axis=1)
    return starts, steps, emissions, log


def _round(sequences: DataFrame, model: Model) -> tuple[Model, float]:
    """One round of Baum-Welch over all training sequences."""
    states, size = len(model.start), model.size
    shared = sequences.sparkSession.sparkContext.broadcast((model.start, model.step, model.emit))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        start, step, emit = shared.value
        here = Model({}, np.zeros(0), np.zeros(0), start, step, emit)
        total, log = np.zeros((1 + states + size, states)), 0.0
        for batch in batches:
            matrix, lengths, begins = _windows(batch)
            for at in range(0, len(matrix), 2048):
                cut = slice(at, at + 2048)
                starts, steps, emissions, more = expected_counts(matrix[cut], lengths[cut], begins[cut], here)
                total[0] += starts
                total[1 : 1 + states] += steps
                total[1 + states :] += emissions
                log += more
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(np.append(used, -1)), *(pa.array(np.append(total[used, k], log)) for k in range(states))]
        yield pa.RecordBatch.from_arrays(columns, names=["at", *(f"s{k}" for k in range(states))])

    schema = "at long, " + ", ".join(f"s{k} double" for k in range(states))
    found = (
        sequences.where("learn").select("classes").mapInArrow(count, schema).groupBy("at").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)])
    ).toPandas()
    table = np.zeros((1 + states + size, states))
    rows, values = found["at"].to_numpy(), found.drop(columns="at").to_numpy()
    table[rows[rows >= 0]] = values[rows >= 0]
    log = float(values[rows < 0][0, 0]) if (rows < 0).any() else 0.0
    start, step, emit = table[0] + 1, table[1 : 1 + states] + 1, table[1 + states :] + 0.5 / states
    return (
        Model(
            model.classes, model.log_within, model.once, start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        ),
        log,
    )


def _neighbours(sequences: DataFrame, top: int) -> np.ndarray:
    """How often each of the ``top`` classes follows each, over all training sequences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(top * top, np.int64)
        for batch in batches:
            matrix, _, _ = _windows(batch)
            a, b = matrix[:, :-1].ravel(), matrix[:, 1:].ravel()
            keep = (a >= 0) & (b >= 0) & (a < top) & (b < top)
            total += np.bincount(a[keep] * top + b[keep], minlength=top * top)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["at", "n"])

    found = sequences.where("learn").select("classes").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(top * top)
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return out.reshape(top, top)


def clusters(pairs: np.ndarray, k: int) -> np.ndarray:
    """Cluster of each token by the tokens before and after it: k-means over the leading singular directions."""
    near = np.concatenate([pairs, pairs.T], axis=1)
    near = np.sqrt(near / np.maximum(near.sum(axis=1, keepdims=True), 1))
    points = np.linalg.svd(near, full_matrices=False)[0][:, : 2 * k] if len(near) else near
    points = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    centres = points[[0]] if len(points) else points
    while 0 < len(centres) < min(k, len(points)):  # farthest first
        distance = ((points[:, None] - centres) ** 2).sum(axis=2).min(axis=1)
        centres = np.concatenate([centres, points[[int(np.argmax(distance))]]])
    label = np.zeros(len(points), int)
    for _ in range(20 if len(points) else 0):
        label = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([points[label == c].mean(axis=0) if (label == c).any() else centres[c] for c in range(len(centres))])
    return label


def fit(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame, int, int, list[int]]:
    """Train on the rows of ``docs`` (doc_id, learn, text as binary) that have ``learn``.

    Returns the model, the counts of all training tokens, all documents as classes, the numbers of training tokens and
    of distinct ones, and the counts of the frequent tokens in the order of their classes.
    """
    counts = stored(count_tokens(docs.where("learn")), "token-counts")
    n_tokens, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = [(bytes(r["token"]), r["n"]) for r in counts.orderBy(F.desc("n"), "token").limit(CLASSES).collect()]
    classes = {token: at for at, (token, _) in enumerate(top)}
    size = len(classes) + SHARED

    # Counts of the shared classes, over all tokens that are not classes of their own.
    def shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, once = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
        for batch in batches:
            for token, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if token not in known.value:
                    at = shared_class(token)
                    n[at] += found
                    once[at] += found == 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHARED)), pa.array(n), pa.array(once)], names=["at", "n", "once"])

    known = docs.sparkSession.sparkContext.broadcast(frozenset(classes))
    rest = counts.mapInArrow(shared_counts, "at long, n long, once long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("once").alias("once"))
    shared_n, shared_once = np.zeros(SHARED), np.zeros(SHARED)
    for r in rest.collect():
        shared_n[r["at"]], shared_once[r["at"]] = r["n"], r["once"]
    once = np.concatenate([np.zeros(len(classes)), shared_once + 1])
    log_within = np.concatenate([np.zeros(len(classes)), -np.log10(shared_n + shared_once + 1)])

    unigram = np.concatenate([[n for _, n in top], shared_n]).astype(float) + 0.5
    model = Model(classes, log_within, once, np.full(STATES, 1 / STATES), np.full((STATES, STATES), 1 / STATES), np.empty((size, STATES)))
    sequences = stored(_classes(docs, model), "classes")
    seeds = min(SEEDS, len(classes))
    label = clusters(_neighbours(sequences, seeds), STATES)
    # A seed is mostly emitted by its cluster's state, anything else by all; a fixed ripple tells states apart.
    emit = np.repeat(unigram[:, None], STATES, axis=1) * (1 + 0.1 * np.sin(np.outer(np.arange(1, size + 1), np.arange(1, STATES + 1))))
    for at, c in enumerate(label):
        emit[at] *= 0.05
        emit[at, c] *= 20 * STATES
    model.emit = emit / emit.sum(axis=0)
    for _ in range(ROUNDS):
        model, _ = _round(sequences, model)
    return model, counts, sequences, n_tokens, n_distinct, [n for _, n in top]


def forward(lists: list[np.ndarray], model: Model) -> np.ndarray:
    """Log10 likelihood of each whole sequence of classes by the scaled forward recursion."""
    sizes = np.array([len(x) for x in lists])
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(len(lists))
    if not len(lists):
        return out
    flat, begin = np.concatenate([lists[at] for at in order]), np.concatenate([[0], np.cumsum(sizes[order])])[:-1]
    falling = -sizes[order]
    ahead, log = np.repeat(model.start[None], len(lists), axis=0), np.zeros(len(lists))
    product, since = np.ones(len(lists)), 0
    for t in range(int(sizes.max())):
        n = int(np.searchsorted(falling, -t, side="left"))
        a = ahead[:n] * model.emit[flat[begin[:n] + t]]
        c = a.sum(axis=1)
        product[:n] *= c
        since += 1
        if since == 16:  # before the product of scales can underflow
            log += np.log10(product)
            product, since = np.ones(len(lists)), 0
        ahead = (a / c[:, None]) @ model.step
    out[order] = log + np.log10(product)
    return out


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, learn, n_tokens, n_known, train_tokens, base_score, score."""
    model, counts, sequences, total, distinct, frequent = fit(docs)
    spark = docs.sparkSession
    n_of = np.concatenate([np.array(frequent, float), np.zeros(SHARED)])
    shared = spark.sparkContext.broadcast((model, n_of))
    floor = float(np.log10(1.0 / (total + distinct + 1)))
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, n_of = shared.value
        top = len(model.classes)
        base_of = np.log10(n_of + 1) + floor
        for batch in batches:
            lists = batch.column("classes")
            flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            parts = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            whole = forward(parts, model)
            own = [p[p < top] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("learn"),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([len(p) for p in own], pa.int64()),
                    pa.array([float(base_of[p].sum()) for p in own], pa.float64()),
                    pa.array([float(c + model.log_within[p].sum()) for c, p in zip(whole, parts, strict=True)], pa.float64()),
                ],
                names=["row", "doc_id", "learn", "n_tokens", "n_own", "base_own", "chain"],
            )

    schema = f"row long, doc_id {doc_type}, learn boolean, n_tokens long, n_own long, base_own double, chain double"
    chains = sequences.select("row", "doc_id", "learn", "classes").mapInArrow(run, schema)

    # Rare tokens, summed per document, meet their counts in a join; the end token is frequent.
    once = F.from_json(F.lit(str([float(x) for x in model.once[len(model.classes) :]])), "array<double>")
    place = F.pmod(F.crc32(F.substring("token", -3, 3)), F.lit(SHARED)).cast("int")
    rare = sequences.select("row", F.explode("rare").alias("r")).select("row", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    known = counts.select("token", F.col("n").alias("seen"))
    met = rare.join(known, "token", "left")
    seen = F.coalesce("seen", F.lit(0))
    within = F.log10(F.when(seen > 0, seen.cast("double")).otherwise(F.get(once, place)))
    per_row = met.groupBy("row").agg(
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("known_rare"),
        F.sum(F.col("times") * (F.log10(seen + 1.0) + floor)).alias("base_rare"),
        F.sum(F.col("times") * within).alias("within_rare"),
    )
    nothing = F.lit(0.0)
    joined = chains.join(per_row, "row", "left")
    base = F.col("base_own") + F.coalesce("base_rare", nothing)
    exact = F.col("chain") + F.coalesce("within_rare", nothing)
    return joined.select(
        "doc_id",
        "learn",
        "n_tokens",
        (F.col("n_own") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base if not total else exact).alias("score"),
    )
