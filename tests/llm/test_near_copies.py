from __future__ import annotations

import random

import numpy as np
import pytest

from ringledger.llm import bagminhash, banding
from ringledger.llm.bagminhash import near_duplicates, one_of_each
from ringledger.llm.common import stored
from ringledger.llm.components import components
from tests.llm import brute


def random_text(rng, n=120):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def classes_of(docs):
    return {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    one, two = [], []
    for _ in range(40):
        n = int(rng.integers(1, 80))
        part = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        first = rng.integers(1, 12, n)
        second = np.where(rng.random(n) < 0.6, first, rng.integers(1, 12, n))
        a, b = rng.random(n) < 0.9, rng.random(n) < 0.9
        a[0] = b[0] = True
        one.append((part[a], first[a]))
        two.append((part[b], second[b]))
    agree = (bagminhash.signatures(one, 4000) == bagminhash.signatures(two, 4000)).mean(axis=1)
    exact = np.array([bagminhash.weighted_jaccard(a, b) for a, b in zip(one, two, strict=True)])
    assert np.abs(agree - exact).max() < 0.04 and abs((agree - exact).mean()) < 0.004


def test_signature_of_a_heavy_multiset():
    part = np.array([1, 2], np.uint64)
    heavy, same, more = ((part, np.array([100_000, n])) for n in (1, 1, 100_000))
    signs = bagminhash.signatures([heavy, same, more], 2000)
    assert (signs[0] == signs[1]).all()
    assert (signs[0] == signs[2]).mean() == pytest.approx(0.5, abs=0.05)


def test_given_documents(small):
    df, texts = small
    sets = {i: brute.shingles(t) for i, t in sorted(texts.items())}
    assert classes_of(df) == brute.classes(sets)


def test_a_group_around_a_text_that_is_neither_first_nor_last(documents, monkeypatch):
    """Copies at many distances, chains of copies, and strangers that share a passage."""
    monkeypatch.setattr(bagminhash, "LEAST_AGREEING", 60)
    rng = random.Random(7)
    middle = random_text(rng)
    texts = [edited(rng, middle, n % 9) for n in range(60)] + [middle]
    for n in range(40):
        texts.append(edited(rng, rng.choice(texts), n % 3))
    passage = random_text(rng, 60)
    texts += [f"{random_text(rng, 25)} {passage} {random_text(rng, 5)}" for _ in range(25)]
    rng.shuffle(texts)
    docs = documents(*enumerate(texts))
    assert classes_of(docs) == brute.classes({n: brute.shingles(t) for n, t in enumerate(texts)})


def test_last_step_finds_links_that_no_centre_shows(spark):
    """Two texts that are both far from the centre and near each other through what they alone share."""
    sets = {0: "abcdefghij", 1: "abcdefghik", 2: "abcdefghil", 3: "abcdefwxyz", 4: "abcdefwxyzv", 5: "abcdefghijm", 6: "abcdepqrst"}
    sets |= {n: "abcdefgh" + chr(200 + n) * 1 + chr(300 + n) for n in range(7, 15)}
    parts = spark.createDataFrame([(k, ord(c)) for k, s in sets.items() for c in s], "key bigint, part bigint")
    members = spark.createDataFrame([(k, 1) for k in sets], "key bigint, band bigint")
    contents = parts.groupBy("key").agg(banding.F.collect_set("part").alias("set"))

    def near(pairs, _):
        found = [(r["a"], r["b"]) for r in pairs.collect() if jaccard(sets[r["a"]], sets[r["b"]]) >= 0.8]
        return spark.createDataFrame(found, "a bigint, b bigint")

    def against(pairs, _):
        rows = [
            (r["key"], len(set(sets[r["key"]]) & set(sets[r["centre"]])), [(ord(c), 1) for c in set(sets[r["key"]]) - set(sets[r["centre"]])])
            for r in pairs.collect()
        ]
        return spark.createDataFrame(rows, "key bigint, shared bigint, rest array<struct<part:bigint,excess:bigint>>")

    found = banding.linked(
        members,
        lambda keys: contents.join(keys, "key"),
        near,
        lambda kept: kept.select("key", banding.F.explode("set").alias("part")).withColumn("weight", banding.F.lit(1)),
        against,
        0.8,
    )
    roots = {r["node"]: r["root"] for r in found.collect()}
    wanted = brute.classes({k: brute.Counter(s) for k, s in sets.items()})
    assert {k: roots.get(k, k) for k in sets} == wanted and wanted[4] == 3


def test_last_step_sees_a_pair_from_its_rarest_part(spark):
    """Parts with the same holders once pruned, of which the one with the least hash is not the rarest."""
    names = iter(range(1000, 100_000))

    def own(n):
        return {next(names) for _ in range(n)}

    middle = list(range(500, 585))
    q, p, r, s, t = {1}, set(range(2, 10)), set(range(20, 28)), set(range(30, 33)), set(range(40, 43))
    sets = {1: {*middle, *own(10)}}
    sets[2] = {*middle[:80], *p, *q, *r, *own(3)}
    sets[3] = {*middle, *p, *q, *s, *own(3)}
    sets[4] = {*middle[:78], *q, *t, *own(18)}
    sets[5] = {*middle[:78], *t, *own(19)}
    sets |= {n: {*middle[:78], *r, *s, *own(11)} for n in (6, 7, 8)}
    sets |= {n: {*middle, *own(25)} for n in (-3, -2, -1, 0, *range(9, 15))}
    assert len(sets[2]) == len(sets[3]) == 100 and len(sets[2] & sets[3]) == 89

    contents = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "key bigint, set array<bigint>")
    members = spark.createDataFrame([(k, 1) for k in sets], "key bigint, band bigint")

    def near(pairs, _):
        found = [(r["a"], r["b"]) for r in pairs.collect() if jaccard(sets[r["a"]], sets[r["b"]]) >= 0.8]
        return spark.createDataFrame(found, "a bigint, b bigint")

    def against(pairs, _):
        rows = [
            (r["key"], len(sets[r["key"]] & sets[r["centre"]]), [(part, 1) for part in sets[r["key"]] - sets[r["centre"]]])
            for r in pairs.collect()
        ]
        return spark.createDataFrame(rows, "key bigint, shared bigint, rest array<struct<part:bigint,excess:bigint>>")

    found = banding.linked(
        members,
        lambda keys: contents.join(keys, "key"),
        near,
        lambda kept: kept.select("key", banding.F.explode("set").alias("part")).withColumn("weight", banding.F.lit(1)),
        against,
        0.8,
    )
    roots = {r["node"]: r["root"] for r in found.collect()}
    wanted = brute.classes({k: brute.Counter(v) for k, v in sorted(sets.items())})
    assert wanted[3] == 2 and {k: roots.get(k, k) for k in sets} == wanted


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


def test_rows_of_all_kinds(documents):
    rng = random.Random(2)
    long = " ".join(f"v{n}" for n in range(30_000))
    text = random_text(rng)
    docs = documents(
        (5, text), (3, text), (3, text), (None, text), (7, None), (8, None), (9, ""), (10, " \n"),
        (11, "two words"), (12, "Two  words"), (13, long), (14, long + " end"), (15, "a " * 500), (16, "a " * 900),
    )
    found = sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in near_duplicates(docs).collect()), key=repr)
    # 500 and 900 words "a": one shingle, 496 and 896 times.
    assert found == sorted(
        [
            (5, 3, 4), (3, 3, 4), (3, 3, 4), (None, 3, 4), (7, 7, 1), (8, 8, 1), (9, 9, 1), (10, 10, 1),
            (11, 11, 2), (12, 11, 2), (13, 13, 2), (14, 13, 2), (15, 15, 1), (16, 16, 1),
        ],
        key=repr,
    )
    kept = one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 9, 10, 11, 13, 15, 16]


def test_empty_table(documents):
    empty = documents((1, "x")).where("false")
    assert near_duplicates(empty).count() == 0 and one_of_each(empty).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(40)] + [(100 + n, 100) for n in range(1, 30)] + [(200, 200), (300, 301), (301, 300)]
    edges += [(a := rng.randrange(400, 500), rng.randrange(a, 500)) for _ in range(70)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    alone = {n for n in parent if all(a == b for a, b in edges if n in (a, b))}
    assert found == {n: root(n) for n in parent if n not in alone}


def test_components_thin_the_edges_of_a_group(spark, monkeypatch):
    """A group whose members are all linked to the same sixty has an edge or two per member, not sixty, in every round."""
    rows = {}

    def counted(df, label):
        out = stored(df, label)
        rows.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr("ringledger.llm.components.stored", counted)
    edges = [(end, 1000 + key) for end in range(60) for key in range(500)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys([*range(60), *range(1000, 1500)], 0)
    assert rows["edges"] == [30_000] and all(n <= 1200 for label, ns in rows.items() if label != "edges" for n in ns)
