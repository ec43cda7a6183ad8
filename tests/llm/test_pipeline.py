from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_linededup import plain
from tests.llm.test_simhash import plain_components, plain_simhash
from tests.llm.test_tokens import check_packing
from tidewarden.llm.pii import Pseudonyms
from tidewarden.llm.queries import KEY
from tidewarden.sources.shared import new_steps


def test_stages_one_by_one(spark, docs, sf):
    step = new_steps(spark)
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(step(stage(spark, seen[-1], sf), name))
    start, known, lines, near, private, packed = (sorted(df.collect(), key=lambda r: r["doc_id"]) for df in seen)
    assert all(df.columns == docs.columns for df in seen[:-1])
    assert known == start

    want = plain([(r["doc_id"], r["text"]) for r in known])
    assert {r["doc_id"]: r["text"] for r in lines} == {i: v[2] for i, v in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines)

    ids = [r["doc_id"] for r in lines]
    groups = plain_components([plain_simhash(r["text"]) for r in lines], ids)
    assert [r["doc_id"] for r in near] == sorted(set(groups)) and len(near) < len(lines)

    names = Pseudonyms(KEY)
    assert [r["text"] for r in private] == [names.text(r["text"])[0] for r in near]

    plainly = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r["doc_id"]: [*plainly.encode(r["text"], add_special_tokens=False).ids, 0] for r in private}
    by_doc, _ = check_packing(packed, tokens)
    assert by_doc == {i: len(v) for i, v in tokens.items()}


def test_empty_documents_and_odd_rows_pass_through(spark, docs, odd, sf):
    for df in (docs.limit(0), odd.select(*docs.columns)):
        step = new_steps(spark)
        for name, stage in corpus_pipeline.STAGES:
            df = step(stage(spark, df, sf), name)
        assert df.columns[0] == "doc_id"
