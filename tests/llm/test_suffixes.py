from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewarden.llm.suffixes import COVER, LENGTH, PERIOD, Buckets, Group, fingerprints, repeated_passages


def plain(rows: list[tuple], length: int = LENGTH) -> list[tuple]:
    """Every string of so many bytes, looked up among all that start earlier."""
    seen: set[bytes] = set()
    out = []
    for id_, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        runs = sum(bool(g) and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((str(id_), len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def got(df) -> list[tuple]:
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_every_difference_is_covered():
    assert sorted((a - b) % PERIOD for a in COVER for b in COVER if a != b) == list(range(1, PERIOD))


def test_whole_small_table(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = plain(rows)
    assert sum(r[2] for r in want) > 10_000
    for group in (1 << 20, 1 << 13):
        found = repeated_passages(docs, group=group, bucket=4096, passes=3)
        assert found.columns == "doc_id n_bytes n_removed n_spans kept_sha256".split()
        assert got(found) == want


def test_odd_rows_and_empty_input(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(repeated_passages(odd)) == plain(rows)
    assert got(repeated_passages(empty)) == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert got(repeated_passages(nothing)) == plain([(1, None), (2, "")])


def test_shifted_overlapping_and_crossing_passages(spark):
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    passage, common = word(400), word(130)
    rows = [(i, word(int(rng.integers(0, 60))) + passage[int(a) : int(a) + int(n)] + word(20)) for i, (a, n) in enumerate(rng.integers(1, 300, (40, 2)))]
    rows += [(100 + i, word(i % 37) + common + word(i % 11)) for i in range(60)]
    rows += [(200, "ab" * 300), (201, "ab" * 300 + "c"), (202, common[:70]), (203, common[70:]), (204, "z" * 99), (205, "z" * 99), (206, "z" * 100), (207, "z" * 101)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert got(repeated_passages(df, group=700, bucket=64)) == plain(rows)
    assert got(repeated_passages(df, length=62, group=700, bucket=64)) == plain(rows, 62)
    with pytest.raises(ValueError):
        repeated_passages(df, length=40)


@given(st.lists(st.integers(0, 2), min_size=1, max_size=400), st.integers(62, 70))
@settings(max_examples=60, deadline=None)
def test_one_group_by_brute_force(symbols, length):
    text = "".join("abc"[s] for s in symbols) + "".join("abc"[s] for s in symbols[5:])
    group = Group(np.frombuffer(text.encode(), dtype=np.uint8), np.array([len(text)]), length)
    any_ = Buckets(10, 1, 10)
    assert [("1", *t) for t in group.told(any_, [], any_, [])] == plain([(1, text)], length)


def test_fingerprints_over_several_segments(monkeypatch):
    from tidewarden.llm import suffixes

    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    at = np.arange(0, 4900, 7)
    whole = fingerprints(data, at, 100)
    monkeypatch.setattr(suffixes, "SEGMENT", 256)
    suffixes._tables.cache_clear()
    assert (fingerprints(data, at, 100) == whole).all()
    suffixes._tables.cache_clear()
