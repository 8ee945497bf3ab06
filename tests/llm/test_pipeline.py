"""The five stages over a small corpus with known faults."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.queries import queries, vocabulary

from .conftest import invented
from .test_encoding import check_packed


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    passage, base = invented(5, 70), invented(6, 300)
    near = base.split()
    near[7] = "changed"
    docs = [(i, invented(1000 + i, 60 + i) + (" you idiot scum" if i % 4 == 0 else "")) for i in range(200)]
    docs += [(300, base), (301, base), (302, " ".join(near)), (310, invented(7, 50) + " " + passage), (311, passage + " " + invented(8, 50))]
    docs += [(320, 'word token = "0123456789abcdef0123456789abcdef" word'), (330, None), (331, ""), (None, "no id at all")]
    frame = spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_each_stage_takes_effect(spark, corpus, folder):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, [{(r.doc_id, r.text) for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, corpus).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        seen.append({(r.doc_id, r.text) for r in docs.collect()})
        assert all(r.text is None or r.n_chars == len(r.text) for r in docs.collect())
    ids = [{d for d, _ in s} for s in seen]
    assert ids[0] - ids[1] == {i for i in range(200) if i % 4 == 0}
    assert ids[1] - ids[2] == {301, 302, 331} or ids[1] - ids[2] == {301, 302, 330}
    changed = {d for d, _ in seen[3] - seen[2]}
    assert changed == {311} and ids[3] == ids[2]
    assert dict(seen[3])[311].strip() == invented(8, 50)
    assert seen[4] - seen[3] == {(320, 'word token = "[SECRET]" word')}


def test_no_column_vanishes(spark, corpus, folder):
    """Columns with the names of helpers come out of every stage as they went in; so do none of an empty table."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id in (310, 311)"))  # repeated rows
    names = ["_text", "_doc", "_rest", "_id", "_hash", "_scores", "_clashing", "of", "key", "rest", "own", "doc", "text_of", "held", "Toxic", "risk"]
    docs = docs.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")) for n in names})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, corpus).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        rows = docs.collect()
        assert rows and all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in rows for n in names)
        if name != "toxicity":  # a model needs rows to be fitted on
            assert stage(spark, docs.where("false"), corpus).select(columns).count() == 0


def test_run_packs_what_is_left(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    ids = {r.doc_id for r in rows}
    assert None in ids and {300, 310, 311, 320} <= ids and not {0, 4, 301, 302} & ids
    assert max(r.doc_tokens for r in rows) < 2048


def test_packing_stage_by_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_return_a_row_per_document(spark, name):
    sf = "/root/testdata/sf0.001"
    got = queries()[name](spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    if name.startswith(("op2_", "op4_", "op6_", "op7_", "op8_", "op9_", "op10_")):
        assert got.count() == n
    elif name.startswith("op1_"):
        assert got.select("doc_id").distinct().count() == n
    else:
        assert got.count() > 0
