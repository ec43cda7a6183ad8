from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewarden.llm import langid


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs, "text", "lang")


def as_rows(docs):
    return docs.select("doc_id", "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def brute_force(rows: list[dict], model) -> list[tuple[str, float]]:
    """Row by row, from counts over all rows."""
    langs = model.languages
    texts = [langid.text_evidence(model, r["text"]) for r in rows]
    first = [max(range(len(langs)), key=lambda i: (t[i], -i)) if any(t) else None for t in texts]
    overall = Counter(f for f in first if f is not None)
    share = [(overall[i] + 1) / (sum(overall.values()) + len(langs)) for i in range(len(langs))]
    by_host, by_parent = defaultdict(Counter), defaultdict(Counter)
    witness = {"declared": defaultdict(Counter), "suffix": defaultdict(Counter)}
    parent = lambda h: h.split(".", 1)[1] if "." in h else ""
    for r, f in zip(rows, first):
        host = (r["host"] or "").lower()
        by_host[host][f] += 1
        by_parent[parent(host)][f] += 1
        for w in witness:
            if r[w] is not None:
                witness[w][r[w]][f] += 1
    out = []
    for r, t, f in zip(rows, texts, first):
        host = (r["host"] or "").lower()
        counts, above = by_host[host], by_parent[parent(host)]
        known = lambda c: sum(v for k, v in c.items() if k is not None)
        scores = []
        for i in range(len(langs)):
            top = (above[i] + 20 * share[i]) / (known(above) + 20) if parent(host) else share[i]
            prior = (counts[i] - (f == i) + 20 * top) / (known(counts) - (f is not None) + 20)
            s = t[i] + math.log(prior)
            for w, table in witness.items():
                if r[w] is not None:
                    s += math.log((table[r[w]][i] + 1) / (sum(c[i] for c in table.values()) + len(table) + 1))
            scores.append(s)
        best = max(range(len(langs)), key=lambda i: (scores[i], -i))
        out.append((langs[best], 1 / sum(math.exp(s - scores[best]) for s in scores)))
    return out


def test_fusion_equals_brute_force(spark, docs, model):
    rows = [r.asDict() for r in as_rows(docs).collect()]
    hosts = ["a.example.com", "b.example.com", "solo", None]
    for n, r in enumerate(rows):
        r["host"], r["suffix"] = hosts[n % 4], ["de", "fr", None][n % 3]
        r["text"] = None if n % 7 == 0 else r["text"][: 5 * (n % 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, declared string, suffix string, host string")
    got = {r["doc_id"]: (r["lang"], r["posterior"]) for r in langid.identify(df, model).collect()}
    for r, (lang, posterior) in zip(rows, brute_force(rows, model)):
        assert got[r["doc_id"]][0] == lang
        assert got[r["doc_id"]][1] == pytest.approx(posterior, rel=1e-9)


def test_held_out_accuracy_of_the_text_alone(spark, sf):
    """Fitted on the smallest documents, told on those of the next size that are new."""
    small = spark.read.parquet(f"{sf}/documents.parquet")
    other = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 200")
    model = langid.fit(small, "text", "lang")
    rows = other.join(small.select("text"), "text", "left_anti").where("length(text) > 200").select("text", "lang").collect()
    index = {lang: i for i, lang in enumerate(model.languages)}
    right = 0
    for r in rows:
        scores = langid.text_evidence(model, r["text"])
        right += scores.index(max(scores)) == index[r["lang"]]
    assert len(rows) > 300 and right / len(rows) > 0.98


def test_pages(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = langid.identify(langid.page_rows(pages), model)
    said = pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("true"))
    both = got.join(said, "page_id").collect()
    assert len(both) == pages.count() and sum(r["lang"] == r["true"] for r in both) / len(both) > 0.95


def test_an_unknown_script_is_unknown(model):
    scores = langid.text_evidence(model, "これは日本語の文章です。とても長い文章ではありませんが、十分です。" * 3)
    assert model.languages[scores.index(max(scores))] == langid.UNKNOWN


def test_clean_documents_stay_and_unknown_ones_go(spark, docs):
    strange = "これは日本語の文章です。とても長い文章ではありませんが、十分です。" * 5
    more = spark.createDataFrame([(10_000, strange, None, None, len(strange))], docs.schema)
    kept = langid.keep_known(docs.unionAll(more))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_odd_rows_and_empty_input(odd, empty, model):
    rows = as_rows(odd).withColumn("lang", F.lit("x")).withColumn("first", F.lit(1))
    got = langid.identify(rows, model)
    assert got.count() == odd.count() and "first" in got.columns
    assert langid.identify(as_rows(empty), model).count() == 0
    nothing = langid.fit(empty, "text", "lang")
    assert nothing.languages == (langid.UNKNOWN,)
    assert langid.keep_known(empty).count() == 0


def test_a_rare_language_is_fitted_and_its_documents_stay(spark, docs):
    """Whatever the sample: two texts of a language among 400 others."""
    texts = [r["text"] for r in docs.select("text").distinct().collect()]
    rows = [(i, f"{i} {texts[i % len(texts)]}", "en", None, 1) for i in range(400)]
    rare = "これは日本語の文章です。とても長い文章ではありませんが、十分です。"
    rows += [(1000 + i, rare * (i + 1), "ja", None, 1) for i in range(2)]
    df = spark.createDataFrame(rows, docs.schema)
    assert langid.fit(df, "text", "lang", sample=10).languages == ("en", "ja", langid.UNKNOWN)
    kept = {r["doc_id"] for r in langid.keep_known(df, sample=10).select("doc_id").collect()}
    assert {1000, 1001} <= kept


def test_copies_do_not_shrink_the_sample(spark, docs):
    one = spark.createDataFrame([("eine Zeile, die sich sehr oft wiederholt", "de")], "text string, lang string")
    other = docs.select("text", F.lit("de").alias("lang")).distinct().limit(60).localCheckpoint()
    copies = one.crossJoin(spark.range(2000)).select("text", "lang")
    got, want = (langid.fit(df.unionAll(other), "text", "lang", sample=100) for df in (copies, one))
    assert got.languages == want.languages and (got.table == want.table).all()
