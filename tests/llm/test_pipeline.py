"""Each stage of the pipeline against plain versions, on what its predecessor kept."""

import sentencepiece
import public_tokenizers
import pytest
from brute import benchmark_words, decontaminated, kept, near_duplicates, repeats, sha256
from conftest import MEDIUM

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline
from gatewatch.llm import queries


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{MEDIUM}/documents.parquet"), []
    out.append(docs)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, MEDIUM).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_and_columns(results):
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity", "simhash", "suffix_dedup", "decontamination", "sentencepiece"]
    for docs in results[1:-1]:
        assert docs.dtypes == results[0].dtypes
        for r in docs.select("text", "n_chars").collect():
            assert r["n_chars"] == len(r["text"])


def test_toxic_documents_go(spark, results):
    rejected = {r["doc_id"] for r in queries.op4_toxicity(spark, MEDIUM).collect()
                if r["predicted"]}
    before = texts(results[0])
    assert texts(results[1]) == {i: t for i, t in before.items() if i not in rejected}
    assert rejected


def test_one_document_of_each_group_stays(results):
    before = texts(results[1])
    groups = near_duplicates(list(before.items()))
    assert texts(results[2]) == {i: before[i] for i, _, least in groups if i == least}
    assert results[2].count() < results[1].count()


def test_repeated_passages_go(results):
    before = texts(results[2])
    covered = repeats(list(before.items()))
    assert texts(results[3]) == {
        i: kept(t, covered[i, t]).decode("utf-8", "ignore") for i, t in before.items()}
    assert any(map(any, covered.values()))


def test_benchmark_passages_go(spark, results):
    before = texts(results[3])
    items = [(str(r["item_id"]), r["text"])
             for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    found = dict(zip(before, decontaminated(list(before.values()), items)))
    after = texts(results[4])
    hit = {i for i, (_, h, _) in found.items() if h}
    assert hit and set(after) == {i for i, (n, h, _) in found.items() if len(h) <= n / 2}
    for i, text in after.items():
        if i not in hit:
            assert text == before[i]
        else:
            n, words, _ = found[i]
            assert benchmark_words(text) == [
                w for k, w in enumerate(benchmark_words(before[i])) if k not in words]


def test_ids_of_what_is_left(results):
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before = texts(results[4])
    rows = results[5].collect()
    assert {r["doc_id"] for r in rows} == set(before)
    for r in rows:
        ids = library.encode(before[r["doc_id"]], add_eos=True)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == sha256(library.decode(ids))


def test_run_is_the_stages(spark, results):
    got = entry_module.queries()["pipeline"](spark, MEDIUM)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, results[-1].collect()))
    assert pipeline.ORACLE_SQL is None and "pipeline" not in entry_module.oracle_sql()


def test_awkward_documents(spark, tmp_path):
    """Nulls and repeated rows go through all stages."""
    from brute import awkward
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{MEDIUM}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = awkward(spark, extra=False).selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source",
        "CAST(NULL AS BIGINT) AS n_chars")
    spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(0).unionByName(docs).write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 4, 5, 7, 8, 9, 10]


def test_short_benchmark_items_are_cut(spark, tmp_path):
    items = spark.createDataFrame([("i", "purple lighthouse sonata")],
                                  "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    words = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"{words} purple lighthouse sonata {words}", None, "s", 0)],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
    row, = pipeline.cut_benchmark(spark, docs, str(tmp_path)).collect()
    assert row["text"] == f"{words}  {words}" and row["n_chars"] == len(row["text"])


def test_empty_tables_and_extra_columns(spark, tmp_path):
    """Tables without rows give none; columns beyond those of documents do not come out."""
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
        if name == "documents":
            odd = table.limit(3).selectExpr(
                "doc_id + 1000000 AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source",
                "n_chars")
            table = table.unionByName(odd).selectExpr(
                "*", "'mine' AS _id", "1 AS _block", "'x' AS _kept", "'y' AS items",
                "'z' AS repeat_spans", "2.0 AS _score")
        table.write.parquet(f"{tmp_path}/wide/{name}.parquet")
    empty = pipeline.run(spark, f"{tmp_path}/empty")
    assert empty.collect() == []
    wide = pipeline.run(spark, f"{tmp_path}/wide")
    plain = pipeline.run(spark, "/root/testdata/sf0.001")
    assert wide.columns == plain.columns == empty.columns
    rows = {r["doc_id"]: r["ids_sha256"] for r in wide.collect()}
    # The null texts are near duplicates of each other (and of what has no words).
    assert {i: v for i, v in rows.items() if i < 1000000} == {
        r["doc_id"]: r["ids_sha256"] for r in plain.collect()}
    assert len([i for i in rows if i >= 1000000]) <= 1
