from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from ringledger.llm.common import DOCUMENT_COLUMNS, stored
from ringledger.llm.decontaminate import normalised
from tests.llm import brute
from tests.llm.test_packing import check, ids_of


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The documents, and what each stage made of them."""
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], sf_dir), f"test-{name}"))
    return tables


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_all_but_the_last_stage_return_documents(steps):
    assert [df.columns for df in steps[1:5]] == [list(DOCUMENT_COLUMNS)] * 4
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "copies", "leaks", "packing"]


def test_quality(steps):
    before, after = texts_of(steps[0]), texts_of(steps[1])
    assert after.items() <= before.items()
    for doc, text in before.items():
        words, _, symbols, _, repeated = brute.rules(text)
        failed = words < 50 or 2 * repeated > words
        # The junk of the given documents is full of signs, their clean text has next to none.
        assert (doc in after) == (not failed and symbols < 0.2 * words and "!! " not in text)


def test_lines(steps):
    before, after = texts_of(steps[1]), texts_of(steps[2])
    bodies = {b: brute.line_shingles(b) for t in before.values() for _, b in brute.document_lines(t)}
    classes = brute.classes(bodies)
    left = [classes[body] for text in after.values() for _, body in brute.document_lines(text)]
    assert len(left) == len(set(left)) and set(left) == set(classes.values())
    for doc, text in after.items():
        lines = iter(before[doc].split("\n"))
        assert text.strip() and all(line in lines for line in text.split("\n"))
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect() if r["text"] != before[r["doc_id"]])


def test_copies(steps):
    before, after = texts_of(steps[2]), texts_of(steps[3])
    classes = brute.classes({d: brute.shingles(before[d]) for d in sorted(before)})
    assert after == {d: before[d] for d in before if classes[d] == d}


def test_leaks(spark, sf_dir, steps):
    before, after = texts_of(steps[3]), texts_of(steps[4])
    items = [normalised(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def leaks(text):
        return any(item in text or brute.edit_distance_to_any_part(item, text) <= len(item) // 20 for item in items)

    gone = before.keys() - after.keys()
    assert after.items() <= before.items() and all(leaks(normalised(before[d])) for d in gone)
    assert not any(item in normalised(text) for text in after.values() for item in items)


def test_packing(steps):
    texts = texts_of(steps[4])
    check(steps[5].collect(), dict(zip(texts, ids_of(texts.values()), strict=True)), corpus_pipeline_limits())


def corpus_pipeline_limits():
    from ringledger.llm.packing import Limits

    return Limits()


def test_run_is_the_stages_one_after_another(spark, sf_dir, steps):
    found = entry_points.queries()["pipeline"](spark, sf_dir)
    assert found.count() == steps[5].count()
    assert sorted(map(tuple, found.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, steps[5].select("doc_id", "start", "length", "ids_crc32").collect())
    )


def test_eleven_queries_are_registered():
    names = entry_points.queries().keys()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 11)) and "pipeline" in names
