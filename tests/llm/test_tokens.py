"""Byte-level BPE, edit-aware counts and packing."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tidewarden.llm import bytebpe, counttree
from tidewarden.llm.packing import _open, _packer, best_fit, dff_bound, pack_documents, sequences
from tidewarden.llm.wordbpe import WordTokenizer

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "'s", " ", "  ", "\n", " ", " " * 300, "é", "12", "!", "'", "\t", "日本", "\x1c", "word", "ing"]


def merged(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Byte pairs merged one by one, lowest rank first."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


@pytest.fixture(scope="module")
def enc():
    return bytebpe.encoding(RANKS, PATTERN)


def some_text(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_ids_equal_merging_by_hand(enc):
    ranks = enc._mergeable_ranks
    rng = random.Random(2)
    for _ in range(30):
        text = some_text(rng, 40)
        want = [i for m in regex.findall(PATTERN, text) for i in merged(ranks, m.encode())]
        assert bytebpe.encode_text(enc, text) == want


def test_splits_change_no_token(enc):
    rng = random.Random(3)
    for _ in range(100):
        text = some_text(rng, 300)
        parts = bytebpe.safe_parts(text, long=20)
        assert "".join(parts) == text
        assert sum((enc.encode_ordinary(p) for p in parts), []) == enc.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000 + "a", "\n" * 300_000, "x 　" * 100_000])
def test_very_long_runs(enc, text):
    assert enc.decode_bytes(bytebpe.encode_text(enc, text)).decode() == text


def test_digests_and_bytes_that_are_not_text(spark, docs, odd, empty, enc):
    for r, text in zip(bytebpe.token_digests(docs, RANKS, PATTERN).collect(), (r["text"] for r in docs.collect())):
        ids = enc.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    got = bytebpe.decode(bytebpe.encode(odd, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert [bytes(r["decoded"]).decode() for r in got] == [r["text"] or "" for r in odd.collect()]
    assert bytebpe.token_digests(empty, RANKS, PATTERN).count() == 0
    part = spark.createDataFrame([(1, [enc.encode_single_token(b"\xe6")]), (2, None)], "doc_id bigint, ids array<int>")
    assert [r["decoded"] for r in bytebpe.decode(part, RANKS, PATTERN).collect()] == [bytearray(b"\xe6"), None]


def test_edits_equal_counting_anew(enc, monkeypatch):
    count = lambda t: len(bytebpe.encode_text(enc, t))
    rng = random.Random(4)
    for n in range(60):
        monkeypatch.setattr(counttree, "LEAF", [4, 16, 64][n % 3])
        monkeypatch.setattr(counttree, "MOST", 4 * counttree.LEAF)
        text = some_text(rng, rng.randrange(200))
        tree = counttree.CountTree.build(count, text)
        for _ in range(10):
            start = rng.randrange(len(text) + 2)
            text = tree.edit(text, start, start + rng.choice([0, 1, 3, 400]), some_text(rng, rng.choice([0, 1, 60])))
            assert tree.total == count(text) and tree.chars[1] == len(text)


def test_an_edit_encodes_its_surroundings_only(enc):
    count = lambda t: len(bytebpe.encode_text(enc, t))
    text = "some words and more of them " * 20_000
    tree = counttree.CountTree.build(count, text)
    text = tree.edit(text, 300_000, 300_005, "XX")
    assert tree.recoded < 2_000 and tree.total == count(text)


def test_edited_tables(spark, odd, empty, enc):
    state = counttree.count_trees(odd, RANKS, PATTERN)
    edits = spark.createDataFrame([(6, 1, 5, 9, "new"), (6, 0, -3, 2, None), (7, 0, 10**6, 10**7, " end"), (99, 0, 0, 0, "x")], "id bigint, seq int, start bigint, stop bigint, text string")
    got = counttree.apply_edits(counttree.with_edits(state, edits), RANKS, PATTERN).collect()
    assert len(got) == odd.count()
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in got:
        assert r["n_tokens"] == len(bytebpe.encode_text(enc, r["text"]))
        assert r["n_before"] == len(bytebpe.encode_text(enc, texts[r["id"]])) if r["id"] is not None else True
    by_id = {r["id"]: r for r in got}
    cut = texts[6][2:]
    assert by_id[6]["text"] == cut[:5] + "new" + cut[9:] and by_id[7]["text"] == texts[7] + " end"
    assert by_id[2]["recoded"] == 0
    assert counttree.apply_edits(counttree.with_edits(counttree.count_trees(empty, RANKS, PATTERN), edits), RANKS, PATTERN).count() == 0


def test_word_by_word_ids_are_the_librarys(docs):
    plain, fast = Tokenizer.from_file(WORDS), WordTokenizer(WORDS)
    odd = ["it's  a''s x,y.z <|endoftext|>Foo", "", "  ", "́a b́ İstanbul ΑΣ ß ſt", "a b c d—e 12,345.67 x!!!?? (hi) 'tis don't", "don't, 's 're've!", "\x1cq\x1f w", "<|ENDOFTEXT|> a"]
    texts = [r["text"] for r in docs.collect()] + odd
    rng = random.Random(6)
    texts += [some_text(rng, 200) for _ in range(20)]
    for text, data in zip(texts, fast.encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    long = "many words " * 250_000
    assert fast.encode([long])[0] == fast.encode(["many words "])[0] * 250_000


def test_bounds_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets = best_fit(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100 and dff_bound(np.bincount(lengths, minlength=101)) <= len(fill)
        for b in range(len(fill)):
            mine = np.argsort(offsets[bins == b])
            assert (np.cumsum(lengths[bins == b][mine]) - lengths[bins == b][mine] == offsets[bins == b][mine]).all()
    assert dff_bound(np.bincount([51] * 10, minlength=101)) == 10
    assert dff_bound(np.bincount([34] * 10, minlength=101)) == 5
    assert dff_bound(np.bincount([], minlength=101).astype(int)) == 0


def check_packing(rows, ids, capacity=2048):
    by_doc: dict = {}
    by_sequence: dict = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["start"] == capacity * r["piece"]
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return by_doc, by_sequence


@pytest.mark.parametrize("per_partition", [8192, 60])
def test_packing_is_whole_and_near_the_bound(docs, per_partition):
    plain = Tokenizer.from_file(WORDS)
    ids = {r["doc_id"]: [*plain.encode(r["text"], add_special_tokens=False).ids, 0] for r in docs.collect()}
    packed = pack_documents(docs, WORDS, per_partition=per_partition)
    rows = packed.collect()
    by_doc, by_sequence = check_packing(rows, ids)
    assert by_doc == {i: len(v) for i, v in ids.items()}
    bound = dff_bound(np.bincount([r["length"] for r in rows], minlength=2049))
    assert {r["least_sequences"] for r in rows} == {bound}
    assert len(by_sequence) <= bound + (1 if per_partition > 1000 else 3)
    if per_partition > 1000:
        real = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sequences(docs, packed, WORDS).collect()}
        for r in rows:
            want = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert real[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tolist() == want


def test_certified_partitions_keep_their_sequences(spark):
    def packed(part, lengths):
        pdf = pd.DataFrame([(i, 0, 0, n, 0, part) for i, n in enumerate(lengths)], columns=["id", "piece", "start", "length", "ids_crc32", "part"])
        return _packer(10)(pdf)

    certified, gap = packed(0, [6, 6, 6, 4, 4, 3]), packed(1, [5, 4, 4, 3, 2, 2])
    assert (certified["bins"] == certified["bound"]).all() and (gap["bins"] > gap["bound"]).all()
    both = spark.createDataFrame(pd.concat([certified, gap]))
    again = {(r["part"], r["bin"]) for r in both.where(_open(10, False)).collect()}
    least = int(certified["least"].iloc[0])
    assert again == {(0, least)} | {(1, b) for b, f in zip(gap["bin"], gap["fill"]) if f < 10}
    assert {(r["part"], r["bin"]) for r in both.where(_open(10, True)).collect()} >= again


@pytest.mark.parametrize("rounds", [1, 2, 6])
def test_more_rounds_never_need_more_sequences(docs, rounds):
    packed = pack_documents(docs, WORDS, per_partition=25, rounds=rounds)
    n = packed.select("sequence_id").distinct().count()
    first = pack_documents(docs, WORDS, per_partition=25, rounds=1).select("sequence_id").distinct().count()
    assert packed.first()["least_sequences"] <= n <= first
    assert packed.count() == packed.select("doc_id", "piece").distinct().count()


def test_odd_rows_and_empty_input(odd, empty):
    rows = pack_documents(odd, WORDS).collect()
    assert sum(r["piece"] == 0 for r in rows) == odd.count()
    assert {r["length"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert sum(r["length"] for r in rows if r["doc_id"] == 6) == 60_001
    assert pack_documents(empty, WORDS).count() == 0
