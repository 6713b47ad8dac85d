"""The registered queries against their SQL, and the pipeline's frame, at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from llm_rows import docs  # noqa: F401  a fixture
from planekit.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 1 + len(QUERIES)))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = lambda p: sorted(map(repr, p[cols].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, sizes = [n for n, _ in corpus_pipeline.STAGES], []
    assert names == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF))
        sizes.append(docs.count())
        assert before == columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert docs.where("not round_trip").count() == 0


def test_pipeline_decisions(spark, docs):
    copies = [(i, "a shared sentence that is quite long enough to count as a line\nown line %d" % i) for i in range(6)]
    rows = docs([(10, None), (11, "123 456"), *copies]).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.keep_known_languages(spark, rows, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5]
    lines = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, rows, SF).collect()}
    assert lines[5][0] == copies[5][1] and lines[4] == ("own line 4", 10) and lines[10] == ("", 0)
    same = docs([(3, "one two three four five"), (1, "ONE two three four five"), (2, "something else entirely here now"),
                 (None, "one two three four five")])
    left = corpus_pipeline.drop_near_duplicates(spark, same, SF)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]


def test_pipeline_near_dedup_counts_rows_not_ids(spark, docs):
    text, other = "one two three four five six", "a clean text of its own, with other words"
    rows = docs([(7, text), (1, text), (7, other), (9, other + " b"), (9, other + " b"), (None, "x y z"), (None, "x y z"),
                 (None, None), (8, "")])
    got = corpus_pipeline.drop_near_duplicates(spark, rows, SF)
    assert got.columns == rows.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    alone = other + " b" if (9, other + " b") in kept else None  # may be near the text it extends
    assert kept == sorted([(1, text), (7, other), (None, "x y z"), (8, "")] + ([(9, alone)] if alone else []), key=str)


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_on_an_empty_table_and_on_repeated_ids(spark, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    assert run(spark, docs([]).select(cols), SF).collect() == []
    rows = docs([(1, "the cat and the dog sat here"), (1, "le chat et le chien sont la"), (1, None), (None, ""),
                 (None, "the bird and the tree stood there")]).select(cols)
    assert {r.doc_id for r in run(spark, rows, SF).collect()} <= {1, None}


def test_pipeline_keeps_texts_of_learned_languages(spark, docs):
    import random
    from pyspark.sql import functions as F
    rng, clean = random.Random(2), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = [(-1, "1234567890" * 2000 + " a"), (-2, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan. " * 5),
               (-3, "人人生而自由,在尊严和权利上一律平等。" * 10),
               (-4, " ".join("".join(rng.choice("qxzjkvwbpf") for _ in range(9)) for _ in range(80)))]
    rows = docs(planted, lang=None).select(clean.columns).union(clean)
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, rows, SF).collect()}
    assert kept == {r.doc_id for r in clean.where(F.col("text").rlike("[A-Za-z]")).collect()}
    unlabelled = rows.withColumn("lang", F.lit(None).cast("string"))
    left = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, unlabelled, SF).collect()}
    assert left == kept | {-1, -2, -3, -4}
