"""Every query over the small tables: against its SQL where there is one, or against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from tokenizers import Tokenizer

import corpus_pipeline
from llm import test_jaccard as jaccard_case
from llm import test_lm as lm_case
from llm import test_quality as quality_case
from llm import test_simhash as simhash_case
from llm import test_substring as substring_case
from tablewright.llm import bpe, packing, warc
from tablewright.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    found = duck.execute(ORACLES[name])
    columns = sorted(d[0] for d in found.description)
    assert columns == sorted(df.columns)
    kinds = {d[0]: str(d[1]) for d in found.description}
    names = {"bigint": "BIGINT", "boolean": "BOOLEAN", "int": "INTEGER", "string": "VARCHAR"}
    assert kinds == {c: names[t] for c, t in df.dtypes}
    order = [d[0] for d in found.description]
    expected = sorted(tuple(dict(zip(order, r))[c] for c in columns) for r in found.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == expected and expected


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in rows]


def test_simhash(spark, documents):
    out = QUERIES["op2_simhash"](spark, DATA).collect()
    rows = [(d, simhash_case.brute_print(t)) for d, t in documents]
    expected = [(d, f"{p:016x}", c) for d, p, c in simhash_case.brute_classes(rows)]
    assert sorted(map(tuple, out)) == sorted(expected)


def test_bpe(spark, documents):
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    expected = []
    for d, t in documents:
        ids = library.encode_ordinary(t or "")
        joined = " ".join(map(str, ids)).encode()
        expected.append(
            (d, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        )
    assert sorted(map(tuple, QUERIES["op4_byte_bpe"](spark, DATA).collect())) == sorted(expected)


def test_language_model(spark, documents):
    out = QUERIES["op6_maxent_lm"](spark, DATA).collect()
    assert sorted(r.doc_id for r in out) == sorted(d for d, _ in documents)
    assert all(r.n_tokens == len(lm_case.plain(dict(documents)[r.doc_id])) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_toxicity_query(spark, documents):
    out = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, DATA).collect()}
    assert out.keys() == {d for d, _ in documents}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in out]
    assert all(out[r.doc_id].held_out for r in held)
    assert sum(out[r.doc_id].predicted == r.toxic for r in held) / len(held) > 0.95


def test_recompression(spark, documents):
    out = QUERIES["op10_recompression"](spark, DATA).collect()
    assert sorted(map(tuple, out), key=repr) == substring_case.brute(documents)


def test_set_relation_join(spark, documents):
    out = QUERIES["op12_set_relation_join"](spark, DATA).collect()
    assert sorted(map(tuple, out), key=repr) == jaccard_case.brute(documents)


def test_packing(spark, documents):
    out = QUERIES["op7_best_fit_packing"](spark, DATA).collect()
    total = sum(r.length for r in out)
    assert {r.doc_id for r in out} == {d for d, _ in documents}
    found = len({r.sequence_id for r in out})
    assert found <= -(-total // 1024) * 1.02 + 1
    # As few as one best-fit pass over all pieces finds.
    _, room = packing.best_fit_decreasing(np.array([r.length for r in out]), 1024)
    assert {r.bound for r in out} == {r.bound for r in out if r.bound <= found <= len(room)}


def test_warc_and_order(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").count()
    assert QUERIES["op1_warc_derivatives"](spark, DATA).count() == 2 * pages
    out = QUERIES["op8_training_order"](spark, DATA).collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").count()
    assert len({(r.conv_id, r.turn) for r in out}) == turns


def test_order_of_all_documents(spark, documents):
    out = QUERIES["op8_document_order"](spark, DATA).collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for d, t in documents:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 50256]
        for k in range(0, len(ids), 128):
            part = np.array(ids[k : k + 128], "<u2")
            expected.append((-1 if d is None else d, k // 128, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id, r.piece, r.used, r.ids_crc32) for r in out) == sorted(expected)


def test_derived_records_have_their_blocks(spark):
    out = QUERIES["op1_warc_derivatives"](spark, DATA).collect()
    assert {r.type for r in out} == {"metadata", "conversion"}
    for r in out:
        data = r.block.encode()
        assert len(data) == r.content_length and warc.digest(data) == r.block_digest
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    texts = [(r.page_id, r.block) for r in out if r.type == "conversion"]
    assert all(t == warc.plain_text(pages[p] or "") for p, t in texts) and len(texts) == len(pages)


def brute_pipeline(spark, docs):
    """What the middle stages keep of (id, text) rows, by plain Python."""
    docs = [(d, t) for d, t in docs if quality_case.verdict(quality_case.brute(t))[2]]
    classes = simhash_case.brute_classes([(d, simhash_case.brute_print(t)) for d, t in docs])
    stay = {d for d, _, c in classes if d is None or d == c}
    return [(d, t) for d, t in docs if d in stay]


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == names
        kept.append(docs)
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    first = {r.doc_id for r in kept[0].collect()}
    every = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    gone = [labels[d][1] for d in every - first if d in labels]
    assert sum(gone) / max(1, len(gone)) > 0.95
    expected = brute_pipeline(spark, [(r.doc_id, r.text) for r in kept[0].collect()])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(d for d, _ in expected)
    clean = [d for d in first if labels.get(d, (0, 1)) == (1, 0)]
    judged = {r.doc_id for r in kept[1].collect()}
    assert sum(d in judged for d in clean) / len(clean) > 0.95
    cut = {r.doc_id: r.text for r in kept[3].collect()}
    words = {d: n - gone for d, n, gone, _ in substring_case.brute(expected)}
    assert {d: len(t.encode().split()) for d, t in cut.items()} == words
    assert {r.doc_id for r in docs.collect()} == cut.keys()


def test_dedup_keeps_a_row_of_each_class_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(80)) for p in "abc")
    rows = [(5, a), (5, b), (9, a), (3, b), (3, b), (None, b), (7, c), (7, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    out = corpus_pipeline.STAGES[2][1](spark, docs, DATA)
    assert out.schema == docs.schema
    expected = [(3, b), (3, b), (5, a), (None, b), (7, c), (7, None)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_stages_take_awkward_tables(spark, made_documents):
    docs = made_documents(1).withColumnRenamed("block", "score")
    spare = docs.select("doc_id", "text", "lang", "source", "n_chars", "score")
    for rows in (spare, spare.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, rows, DATA)
            assert out.columns == rows.columns, name
            out.collect()
        corpus_pipeline.STAGES[4][1](spark, rows, DATA).collect()
