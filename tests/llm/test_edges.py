"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfscope.llm import archives, decontaminate, jaccard_join, langid, line_dedup, pieces, quality, rules, secrets, toxicity

LINE = "This line is long enough to be counted as a line key, A"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, key string, keys string, score double, at timestamp"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, LONG), (5, LONG), (6, "a b"), (7, "é ß 日本 \U0001f600"), (None, "no id"), (8, LINE + "\n" + LINE)]
    texts += [(20 + i, LINE.upper() + f" \n{i}") for i in range(4)]
    rows = [(d, t, None if i % 3 else "en", None, None if t is None else len(t), 1, "k", None, 0.5, dt.datetime(2024, 1, 1)) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, None, None), (4, 1, 0), (6, 0, 1), (None, 1, 1), (99, 0, 1), (20, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, None), (2, ""), (3, "too short"), (4, "word1 word2 word3 word4 word5 word6 word7"), (None, "x y z u v w")]
    return spark.createDataFrame(rows, "item_id long, text string")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def operators(labels, benchmark):
    true = F.lit(True)
    return {
        "toxicity": lambda d: toxicity.tag(d, toxicity.train(d, labels, true)),
        "pieces": pieces.encode,
        "jaccard": jaccard_join.joined,
        "rules": lambda d: rules.judged(d, rules.train(d, labels)),
        "lines": line_dedup.line_dedup,
        "language": lambda d: langid.identify(d, true),
        "secrets": secrets.scan_secrets,
        "quality": lambda d: quality.predict(d, quality.train(d, labels, true)),
    }


@pytest.mark.parametrize("name", ["toxicity", "pieces", "jaccard", "rules", "lines", "language", "secrets", "quality"])
def test_every_row_has_a_result(docs, labels, benchmark, name):
    out = operators(labels, benchmark)[name](docs)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    empty = operators(labels, benchmark)[name](docs.where("false"))
    assert empty.count() == 0 and empty.columns == out.columns


def test_defined_results(docs, labels, benchmark):
    ops = operators(labels, benchmark)
    rows = by_id(ops["pieces"](docs))
    assert rows[1][0]["ids"] is None and rows[2][0]["ids"] == [] and len(rows[5]) == 2
    back = by_id(pieces.decode(pieces.encode(docs)))
    assert [back[i][0]["text"] for i in (1, 2, 3, 7)] == [None, "", " \n\t", "é ß 日本 \U0001f600"]
    rows = by_id(ops["jaccard"](docs))
    assert [(rows[i][0]["n_shingles"], rows[i][0]["component_id"]) for i in (1, 2, 3, 5, 6)] == [(0, 1), (0, 2), (0, 3), (977, 4), (1, 6)]
    assert rows[None][0]["component_id"] is None
    rows = by_id(ops["lines"](docs))
    assert (rows[1][0]["n_lines"], rows[1][0]["kept_text"]) == (1, "")
    # Four upper-case copies and the document that holds it twice make five: all but the largest id lose it.
    assert (rows[8][0]["n_dropped"], rows[20][0]["n_dropped"], rows[23][0]["n_dropped"]) == (2, 1, 0)
    rows = by_id(ops["language"](docs))
    assert [rows[i][0]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and rows[4][0]["lang_pred"] == "en"
    rows = by_id(ops["rules"](docs))
    assert rows[1][0]["n_words"] == 0 and rows[1][0]["base_failed"] and not rows[1][0]["kept"]
    rows = by_id(ops["secrets"](docs))
    assert rows[1][0]["spans"] == "" and rows[1][0]["n_hex"] == 0
    found = by_id(decontaminate.contamination(docs, benchmark))
    assert set(found) == {4, 5} and found[4][0]["item_ids"] == [4]


def test_without_labels_or_benchmark(docs, labels, benchmark):
    none = labels.where("false")
    true = F.lit(True)
    assert max(r["score"] for r in toxicity.tag(docs, toxicity.train(docs, none, true)).collect()) < 1e-9
    assert {r["score"] for r in quality.predict(docs, quality.train(docs, none, true)).collect()} == {0.5}
    assert rules.train(docs, none) == []
    assert decontaminate.clean_only(docs, benchmark.where("false")).count() == docs.count()


def test_stages_keep_columns_and_null_rows(spark, docs, tmp_path, labels, benchmark):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert out.where("doc_id = 1 and text is null").count() == 1 and out.where("doc_id is null").count() == 1, name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_pages(spark):
    rows = [(3, "http://a b\n", "x"), (1, None, "x"), (1, "http://c", "x"), (2, "http://d", None), (5, "u", ""), (None, "v", "x"), (-4, "w", "é\r\n\r\nWARC/1.0\r\n"), (6, "z", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "key long, url string, html string")
    got = sorted((r["key"] is None, r["key"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in archives.through_archives(pages).collect())
    assert got == [(False, -4, 16, "response", None), (False, 1, 1, "response", None), (False, 1, 1, "response", None), (False, 2, 0, "response", None),
                   (False, 3, 1, "revisit", 1), (False, 5, 0, "revisit", 2), (False, 6, 300_000, "response", None), (True, 0, 1, "response", None)]
    assert archives.through_archives(pages.where("false")).count() == 0
    kept = archives.through_archives(pages, least=2).where("record_type = 'revisit'").count()
    assert kept == 0


def test_one_of_each_keeps_every_text_of_a_repeated_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, a), (5, a), (5, b), (9, b), (5, ""), (9, None), (7, b + " end"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(docs).collect()}
    assert kept == {(1, a), (5, b), (5, ""), (9, None), (None, a)}
    few = docs.where("doc_id <> 5 or text = '" + a + "'")
    assert {(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(few).collect()} == {(1, a), (7, b + " end"), (9, None), (None, a)}
