from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewarden.llm.columns import ROW
from tidewarden.llm.components import components
from tidewarden.llm.simhash import keep_first, near_duplicates, simhash
from tidewarden.sources.shared import new_steps


def plain_simhash(text: str) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


def plain_components(prints: list[int], ids: list[int | None]) -> list[int | None]:
    fp = np.array(prints, dtype=np.uint64)
    root = list(range(len(fp)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 2):
            root[find(int(j))] = find(i)
    groups: dict[int, list[int]] = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    least = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


@given(st.text(alphabet="aB Ä\n\x0b\x1c日", max_size=60))
@settings(max_examples=100, deadline=None)
def test_fingerprint_bits(text):
    assert simhash(text) & (2**64 - 1) == plain_simhash(text)


@pytest.mark.parametrize("crowded", [128, 1])
def test_components_equal_all_pairs(docs, crowded):
    got = near_duplicates(docs, crowded=crowded).toPandas()
    prints = [int(x, 16) for x in got["fingerprint"]]
    assert list(got["component_id"]) == plain_components(prints, list(got["doc_id"]))
    texts = dict(docs.select("doc_id", "text").collect())
    assert all(plain_simhash(texts[i]) == p for i, p in zip(got["doc_id"], prints))


def test_crowded_halves_lose_no_link(spark):
    """A family of fingerprints one to three bits apart, told apart by brute force."""
    from tidewarden.llm.simhash import links

    rng = np.random.default_rng(3)
    base = int(rng.integers(1, 1 << 62))
    family = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))}
    prints = sorted(family | {int(x) for x in rng.integers(1, 1 << 62, 40)})
    for crowded in (1000, 4):
        step = new_steps(spark)
        table = step(spark.createDataFrame([(p,) for p in prints], "fp bigint"), "prints")
        pairs = links(table, step, crowded)
        roots = dict(components(pairs, step).collect())
        assert all(bin(r["a"] ^ r["b"]).count("1") <= 2 for r in pairs.collect())
        want = plain_components(prints, prints)
        assert [roots.get(p, p) for p in prints] == want


def test_long_chain_is_one_component(spark):
    step = new_steps(spark)
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1001)], "a bigint, b bigint")
    roots = dict(components(pairs, step).collect())
    assert {roots[i] for i in range(301)} == {0} and roots[1001] == 1000


def test_odd_rows_and_empty_input(odd, empty):
    got = near_duplicates(odd).collect()
    assert len(got) == odd.count()
    same = {r["component_id"] for r in got if r["doc_id"] in (1, 2)}
    assert same == {1}
    zero = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {3}
    assert near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(odd, empty, docs):
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7]
    assert keep_first(empty).count() == 0
    groups = near_duplicates(docs).toPandas()
    assert sorted(r["doc_id"] for r in keep_first(docs).collect()) == sorted(set(groups["component_id"]))


def test_rows_that_share_64_bits_are_told_apart(spark, monkeypatch):
    """The first hash of all rows is the same: no row goes for another."""
    from tidewarden.llm import simhash as module

    plain = module.row_key
    monkeypatch.setattr(module, "row_key", lambda df: [F.lit(0).cast("bigint").alias(ROW[0]), plain(df)[1]])
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "seven eight nine ten eleven")]
    kept = keep_first(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
