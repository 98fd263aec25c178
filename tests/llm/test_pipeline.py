"""Every stage of the pipeline on a table with odd rows, each judged on its own input."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lodestar.llm import neardup, pieces, quality, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Good and bad texts, near copies, repeated rows with other columns, nulls and a very long text."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    good = [[rng.choice(words) for _ in range(rng.randint(40, 80))] for _ in range(70)]
    rows = [(i, " ".join(w), "en", f"src{i % 4}", len(" ".join(w))) for i, w in enumerate(good)]
    rows += [(100 + i, " ".join([*good[i][:-1], "changed"]), "en", "src0", 1) for i in range(8)]  # near copies
    rows += [(200 + i, " ".join(f"q{rng.randrange(10**6)}" for _ in range(50)), "en", "src1", 1) for i in range(8)]  # noise
    rows += [(3, rows[3][1], None, "other", None), (3, rows[3][1], "en", "a", None), rows[4], rows[4]]
    rows += [(300, None, "en", "src1", None), (301, "", "en", "src1", 0), (None, " ".join(good[60]), None, None, None), (302, " ".join(rng.choice(words) for _ in range(30_000)), "en", "src2", 1)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(70)] + [(200 + i, 0, 0) for i in range(8)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_follow_their_operators(spark, given, tmp_path):
    folder, rows = given
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "source mixing", "sentencepiece"]
    inputs = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, inputs[-1], folder).write.parquet(f"{tmp_path}/{n}")
        inputs.append(spark.read.parquet(f"{tmp_path}/{n}"))
    judged, single, mixed, encoded = inputs[1:]
    assert all(part.columns == docs.columns for part in (judged, single, mixed))
    # 1. what the classifier keeps, and clean documents among it
    kept = {r["doc_id"] for r in quality.classify(docs, queries.trusted_ids(spark, folder)).where("kept").collect()}
    assert rows_of(judged) == sorted((r for r in rows if r[0] in kept), key=str)
    ids = {r["doc_id"] for r in judged.collect()}
    assert len(set(range(70)) - ids) <= 2 and not ids & set(range(200, 208))
    # 2. one document of each group, the same row of repeated ones every time
    groups = {r["doc_id"]: r["kept"] for r in neardup.near_duplicate_groups(judged).collect() if r["doc_id"] is not None}
    left = rows_of(single)
    assert sorted(r[0] for r in left if r[0] is not None) == sorted(i for i, k in groups.items() if k)
    assert not {r[0] for r in left} & set(range(100, 108))
    if 3 in groups:
        assert [r for r in left if r[0] == 3] == [min((r for r in rows if r[0] == 3), key=lambda r: tuple((v is not None, v) for v in r))]
    # 3. rows of the second stage, none from elsewhere
    assert set(rows_of(mixed)) <= set(left) and mixed.count() > 0
    # 4. ids that decode to the text
    v = pieces.load_vocabulary(queries.PIECES_MODEL)
    assert encoded.count() == mixed.count() and encoded.where("NOT identical").count() == 0
    texts = sorted(((r["doc_id"], r["text"]) for r in mixed.collect()), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in pieces.decode_documents(encoded, v).collect()), key=str) == texts


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_kept_ids_are_not_broadcast(spark, given, monkeypatch):
    docs = spark.read.parquet(f"{given[0]}/documents.parquet")
    monkeypatch.setattr(neardup, "near_duplicate_groups", lambda docs: docs.select("doc_id", F.lit(True).alias("kept")))
    plan = corpus_pipeline.drop_near_duplicates(spark, docs, given[0])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
