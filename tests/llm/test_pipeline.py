"""The pipeline, stage by stage, against what each stage's contract says."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from .tests_support import planted_documents


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    docs, labels, known = planted_documents(random.Random(4))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, known


def test_stages(spark, tables):
    folder, known = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/out_{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        ids[name] = Counter(x.doc_id for x in docs.select("doc_id").collect())
        if name != "packing":
            assert docs.columns == columns
        if name == "line_dedup":
            assert not docs.where("text like '%Subscribe to our letter%'").count()
    everything = set(known["clean"]) | set(known["toxic"]) | {i for g in known["near"] for i in g}
    gone = everything - set(ids["toxicity"])
    assert gone >= set(known["toxic"]) and not gone & set(known["clean"])
    assert set(ids["line_dedup"]) == set(ids["toxicity"])
    for group in known["near"]:
        assert set(group) & set(ids["ngram_jaccard_join"]) == {min(group)}
    assert set(known["clean"]) <= set(ids["ngram_jaccard_join"])
    assert set(ids["mixing"].values()) <= {1, 2} and set(ids["mixing"]) <= set(ids["ngram_jaccard_join"])
    assert set(ids["packing"]) == set(ids["mixing"])


def test_run(spark, tables):
    folder, _ = tables
    out = P.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    lengths = Counter()
    for x in out.collect():
        lengths[x.sequence_id] += x.length
    assert max(lengths.values()) <= 1024 and sum(1024 - n for n in lengths.values()) < 1024


def test_odd_rows(spark, tables):
    """Every stage on nulls, empty and very long texts, repeated rows and extra columns whose names clash."""
    folder, _ = tables
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", 0, "x", 1), (2, "", "en", "a", 0, "x", 2), (3, long, "en", None, len(long), "x", 3), (4, long + " more", "en", "b", 0, "x", 4), (None, long, "en", "b", 0, "x", 5), (None, None, None, None, None, None, 6),
        (5, "the same text of six words", None, "c", 5, "x", 7), (5, "the same text of six words", None, "c", 5, "x", 7), (5, "another text under the same id", "en", "c", 5, "x", 8), (6, "\n \n", "en", "c", 3, "x", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, a string, b int").toDF("doc_id", "text", "lang", "source", "n_chars", "TEXT", "__gone")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, folder)
        assert out.columns == df.columns, name
        ids = Counter(x.doc_id for x in out.collect())
        if name == "ngram_jaccard_join":
            assert ids == Counter([1, 2, 3, None, None, 5, 5, 5, 6])
        elif name == "mixing":
            assert set(ids) <= {None, 1, 2, 3, 4, 5, 6} and max(ids.values()) <= 6
        else:
            assert ids == Counter(x[0] for x in rows), name
        assert stage(spark, df.limit(0), folder).collect() == []
    pieces = P.pack_windows(spark, df, folder).collect()
    assert Counter(x.doc_id for x in pieces if x.start == 0) == Counter(x[0] for x in rows)
    assert P.pack_windows(spark, df.limit(0), folder).collect() == []


def test_entry():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is P.run and P.ORACLE_SQL is None
    assert all(any(k.startswith(f"op{n}_") for k in entry.queries()) for n in range(1, 11))
