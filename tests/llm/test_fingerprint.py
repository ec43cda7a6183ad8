from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewarden.llm import fingerprint as fp


def shingles(text: str) -> set:
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def texts(docs):
    return sorted(map(tuple, docs.select("doc_id", "text").collect()))


@pytest.mark.parametrize("k", [128, 1 << 16])
def test_edits_and_likeness(docs, texts, k):
    """A sketch that holds every shingle is exact; the usual one is near."""
    got = sorted(fp.fingerprint_edits(docs, k=k).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in got] == [i for i, _ in texts]
    errors = []
    for n, r in enumerate(got):
        text, following = texts[n][1], texts[(n + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, after = shingles(text), shingles(edited), shingles(following)
        errors.append(abs(r["near_edited"] - jaccard(own, changed)))
        errors.append(abs(r["near_next"] - jaccard(own, after)))
        if k > 128:
            assert r["distinct_shingles"] == len(own)
    assert max(errors) < (1e-9 if k > 128 else 0.2)
    assert sum(errors) / len(errors) < (1e-9 if k > 128 else 0.02)
    by_text = {}
    for (_, text), r in zip(texts, got):
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]


@pytest.mark.parametrize("ids", [[5], [-(2**62), 0, 1, 2, 2**62], list(range(0, 100_000, 700)) + [2**60]])
def test_next_by_any_ids(spark, ids):
    rows = [(i, f"{i} " * 9) for i in ids]
    got = {r["doc_id"]: r["edited_sha256"] for r in fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for n, (i, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(n + 1) % len(rows)][1][:half]
        assert got[i] == hashlib.sha256(edited.encode()).hexdigest()


def test_parts_merge_to_the_whole(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words[a : a + 500 + 4])) for a in range(0, 3000, 500)] + [(2, "")]
    parts = fp.with_sketch(spark.createDataFrame(rows, "part bigint, text string"), "text", "sketch", 64)
    merged = {r["part"]: r["sketch"] for r in fp.merge_parts(parts, "part", "sketch", 64).collect()}
    whole = fp.with_sketch(spark.createDataFrame([(" ".join(words),)], "text string"), "text", "sketch", 64).first()["sketch"]
    assert merged == {1: whole, 2: []}
    known = spark.createDataFrame([(whole,)], "s array<bigint>").select(fp.distinct_shingles(F.col("s"), 64)).first()[0]
    assert abs(known / 2996 - 1) < 0.4


def test_odd_rows_and_empty_input(odd, empty):
    got = fp.fingerprint_edits(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[3]["n_chars"] == by_id[4]["n_chars"] == 0
    assert by_id[3]["fingerprint"] == by_id[5]["fingerprint"] == ""
    assert by_id[3]["near_next"] == 1.0
    ones = [r for r in got if r["doc_id"] == 1]
    assert len(ones) == 2 and {r["near_next"] for r in ones} == {1.0}
    assert all(r["near_next"] is None for r in got if r["doc_id"] is None)
    assert fp.fingerprint_edits(empty).count() == 0
