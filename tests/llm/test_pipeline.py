"""The pipeline on planted cases, and every registered query on the smallest tables."""

import os

import pytest
from texts import frame, prose

import corpus_pipeline
from seismerge.llm.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


def test_stages_on_planted_cases(spark, tmp_path):
    rng = {"en": [f"the{k} and of" for k in range(40)], "fr": [f"les{k} et une" for k in range(40)]}
    bench = prose(90, 30)
    clean = [" ".join(rng[g][(k * 7 + i) % 40] + f" x{k}y{i}" for i in range(60)) for g in rng for k in range(30)]
    near = clean[0].split()
    near[100] = "other"
    texts = clean + [clean[1], clean[1], " ".join(near), prose(91, 40) + " " + bench, None, "", "123 ...", clean[2] + " "]
    langs = ["en"] * 30 + ["fr"] * 30 + ["en"] * (len(texts) - 60)
    folder = str(tmp_path)
    frame(spark, texts, langs=langs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, folder)
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns
            path = f"{folder}/{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    n = len(texts)
    junk = {n - 4, n - 3, n - 2}
    assert left[0] == set(range(n)) - junk
    assert left[1] == left[0] - {1, 60}  # of equal texts the largest id stays
    assert left[2] == left[1] - {62, n - 1}  # of near copies the smallest
    assert left[3] == left[2] - {63}
    assert left[4] == left[3]


def test_near_stage_drops_copies_from_four_fifths_on(spark, tmp_path):
    """Copies cut off at a similarity of 0.79, 0.80, 0.82 and 0.84, as short and as long sets."""
    texts = []
    for n in (100, 500, 600):
        for percent in (79, 80, 82, 84):
            words = [f"w{n}p{percent}i{i}" for i in range(n + 4)]
            texts += [" ".join(words), " ".join(words[:n * percent // 100 + 4])]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, str(tmp_path)).select("doc_id").collect()}
    # At 600 shingles the pair at the threshold itself is confirmed on full sets.
    assert left == set(range(len(texts))) - {k for k in range(1, len(texts), 2) if k % 8 != 1}


def test_language_stage_without_labels(spark, tmp_path):
    """Without a language to learn, only texts without a letter go."""
    texts = [prose(k, 20) for k in range(6)] + [None, "", "123 ...", "日本語", "é"]
    frame(spark, texts, langs=[None] * len(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert left == set(range(len(texts))) - {6, 7, 8}


def test_pipeline_without_documents(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_runs_stage_by_stage(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "exact dedup", "near dedup", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, SMALL).count() > 0


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_oracle(spark, name):
    import duckdb
    fn, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    got = fn(spark, SMALL)
    want = con.sql(sql)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(
        repr(tuple(r[k] for k in order)) for r in want.fetchall())


def test_every_operator_is_registered():
    assert sorted({n.split("_")[0] for n in REGISTRY} - {"pipeline"}, key=lambda s: int(s[2:])) == [f"op{k}" for k in range(1, 14)]
