"""The pipeline's stages, each on its own input, and the registered queries' oracle SQL."""

import duckdb
import pytest

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    from strideway.llm import decontamination, near_dup

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns
        seen[name] = out.count()
        docs, before = out, docs
    n = [seen[name] for name, _ in pipeline.STAGES]
    assert n[0] >= n[2] >= n[3] > 0 and n[0] == n[1]
    assert {r.doc_id for r in before.select("doc_id").collect()} == {r.doc_id for r in out.select("doc_id").collect()}
    left = near_dup.near_duplicates(before)
    assert left.where("not kept").count() == 0
    assert decontamination.decontaminate(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0


def test_run_is_its_stages(spark):
    assert [name for name, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", ["op1_exact_top_k", "op2_decontamination", "op5_minhash_near_dedup", "op7_line_dedup", "op10_warc"])
def test_queries_match_their_sql(spark, name):
    from strideway.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.select(*[f'"{c}"' for c in columns]).fetchall()))


ODD = "doc_id long, text string, lang string, source string, n_chars int, kept string, d string, score string, w string, node long"
ROWS = [(1, None), (2, ""), (3, "one line"), (3, "one line"), (None, "no id"), (None, None), (4, "a b c d e f g\nh i j k\nl m n o p q"), (5, "a b c d e f g\nh i j k\nl m n o p q"), (6, "word " * 60_000), (7, "x" * 200_000)]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, None, "k", None, "s", "w", None) for i, t in rows], ODD)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) <= {i for i, _ in rows}, name
        if name in ("minhash_near_dedup", "benchmark_decontamination"):
            assert ids.count(None) == sum(i is None for i, _ in rows), name
        if name == "minhash_near_dedup" and rows:
            assert sorted(i for i in ids if i) == [1, 2, 3, 3, 4, 6, 7]
        if name == "line_dedup" and rows:
            assert {r.doc_id: r.text for r in out.where("doc_id in (4, 5)").collect()} == {4: ROWS[6][1], 5: ""}
    packed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted({str(r.doc_id) for r in packed}) == sorted({str(i) for i, _ in rows})


def test_stages_decide_by_document_not_by_id(spark):
    words = lambda tag, n=40: " ".join(f"{tag}{k}" for k in range(n))
    docs = spark.createDataFrame([(1, words("a")), (5, words("a")), (5, words("b")), (None, words("a")), (None, words("c")), (None, words("c")), (7, words("d"))], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text[:2]) for r in pipeline.near_dedup_stage(spark, docs, SF).collect())
    assert [x for _, x in kept].count("a0") == 1 and (5, "b0") in kept and (7, "d0") in kept and (0, "c0") in kept
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("size(split(text, ' ')) > 12").first().text
    docs = spark.createDataFrame([(1, item), (1, words("a")), (None, item), (None, words("b")), (2, item), (3, words("c"))], "doc_id long, text string")
    left = sorted((r.doc_id or 0, r.text[:2]) for r in pipeline.decontamination_stage(spark, docs, SF).collect())
    assert left == [(0, "b0"), (1, "a0"), (3, "c0")]
