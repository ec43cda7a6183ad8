from __future__ import annotations

from collections import defaultdict

import pytest

from tidewarden.llm.linededup import LineRuns, dedup_lines, hashed_lines

BLANK = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=5, min_chars=40):
    """Rows of (id, text) in any order, ids distinct."""
    key = lambda line: line.strip(BLANK).translate(FOLD)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and i != max(held[key(x)]))]
        out[i] = (len(lines), len(lines) - len(stays), "\n".join(stays))
    return out


@pytest.mark.parametrize("batches, fanout", [(1, 4), (5, 2)])
def test_equals_brute_force(docs, batches, fanout):
    got = dedup_lines(docs, batches=batches, fanout=fanout).select("doc_id", "n_lines", "n_dropped", "text").collect()
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert {r[0]: tuple(r[1:]) for r in got} == want
    assert sum(v[1] for v in want.values()) > 0


def test_keys_ties_and_the_largest_id(spark):
    line = "Ein Satz mit Ärger, der länger ist als vierzig Zeichen"
    texts = [line, f"  {line.upper().replace('Ä', 'Ä')}\t", f"{line}\n\n{line}\nx", f"a\n{line}\r", line.lower(), line]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in dedup_lines(df).collect()}
    assert got == plain(rows)
    twice = spark.createDataFrame([(i, f"{line}\n{line}") for i in range(6)], "doc_id bigint, text string")
    assert [r["text"] for r in dedup_lines(twice).orderBy("doc_id").collect()] == [""] * 5 + [f"{line}\n{line}"]


def test_runs_are_levelled_and_tell_new_lines(spark, docs):
    runs = LineRuns(spark, fanout=2)
    lines = hashed_lines(docs, "doc_id", "text")
    parts = [lines.where(f"id % 5 = {n}") for n in range(5)]
    for part in parts:
        runs.add(part)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.unseen(parts[0]).count() == 0
    whole = LineRuns(spark)
    whole.add(lines)
    assert sorted(map(tuple, runs.common(3).collect())) == sorted(map(tuple, whole.common(3).collect()))


def test_each_hash_is_new_in_one_run(spark, docs):
    runs = LineRuns(spark, fanout=9)
    lines = hashed_lines(docs, "doc_id", "text")
    seen = set()
    for n in range(4):
        runs.add(lines.where(f"id % 4 = {n}"))
        run = runs.runs()[-1].bucketed.collect()
        assert {r["hash"] for r in run if not r["known"]}.isdisjoint(seen)
        assert {r["hash"] for r in run if r["known"]} <= seen
        seen |= {r["hash"] for r in run}
    assert any(r["known"] for r in run)


def test_runs_are_met_without_a_shuffle(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        runs = LineRuns(spark, fanout=9)
        lines = hashed_lines(docs, "doc_id", "text")
        for n in range(3):
            runs.add(lines.where(f"id % 3 = {n}"))
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
        batch = lines.selectExpr("explode(hashes) AS hash").groupBy("hash").count()
        assert exchanges(runs.told(batch)) == exchanges(batch) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_odd_rows_clashing_names_and_empty_input(odd, empty):
    got = dedup_lines(odd, min_docs=3, min_chars=10)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    by_id = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert got.count() == odd.count()
    assert by_id[1]["text"] == "" and by_id[2]["text"].startswith("the same text")
    assert by_id[3]["text"] == "" and by_id[3]["n_lines"] == 1
    assert by_id[1]["row"] == "x" and by_id[1]["hash"] == 1
    nulls = [r["text"] for r in got.where("doc_id IS NULL").collect()]
    assert nulls == ["", ""]
    assert dedup_lines(empty).count() == 0


def test_a_line_is_lowered_once_for_its_hash_and_not_for_its_length(spark):
    lines = hashed_lines(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), "doc_id", "text")
    plan = lines._jdf.queryExecution().analyzed().toString()
    assert plan.count("translate(") == 1
