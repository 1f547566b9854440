"""The permutation is one, and shards read back as written, from any slot."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm import ordering
from tablewright.llm.vocabulary import ChunkTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4096, 4097])
def test_permutation(n):
    slots = ordering.permuted(np.arange(n), n, 7)
    assert sorted(slots) == list(range(n))
    assert (ordering.numbers_of(slots, n, 7) == np.arange(n)).all()
    if n > 100:
        assert (slots != ordering.permuted(np.arange(n), n, 8)).any()
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.2


def test_shards(spark, made_documents, tmp_path):
    docs = made_documents(4)
    layout = ordering.Layout(length=16, per_shard=50)
    found = ordering.sequences(docs, PATH, layout, ("doc_id", "block"))
    folder = str(tmp_path / "shards")
    rows = ordering.materialised(found, folder, 5, layout).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 50256]
        for k in range(0, len(ids), 16):
            crc = zlib.crc32(np.array(ids[k : k + 16], "<u2").tobytes())
            key = (-1 if r.doc_id is None else r.doc_id, r.block)
            expected.append((*key, k // 16, len(ids[k : k + 16]), crc))
    expected.sort()
    assert sorted((r.a, r.b, r.piece, r.used, r.ids_crc32) for r in rows) == expected
    n = len(expected)
    order = {(a, b, p): i for i, (a, b, p, _, _) in enumerate(expected)}
    slots = ordering.permuted(np.arange(n), n, 5)
    for r in rows:
        assert r.slot == slots[order[r.a, r.b, r.piece]]
        assert (r.shard, r.offset) == (r.slot // 50, r.slot % 50 * layout.kind.itemsize)
    later = ordering.read(spark, folder, layout, start=70).collect()
    assert sorted(r.slot for r in later) == list(range(70, n))
    again = ordering.materialised(found.repartition(3), str(tmp_path / "again"), 5, layout).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_empty_table(spark, made_documents, tmp_path):
    found = ordering.sequences(made_documents().filter("false"), PATH, keys=("doc_id", "block"))
    assert ordering.materialised(found, str(tmp_path / "none"), 1).collect() == []


@pytest.fixture
def many_parts(spark):
    """Ranges are not put together."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_repeated_keys_over_many_parts(spark, made_documents, tmp_path, many_parts):
    """NULL keys, one with copies: texts keep their sequences together, in the order of their hashes."""
    layout = ordering.Layout(length=16, per_shard=20)
    docs = made_documents(5).selectExpr("CASE WHEN block % 3 > 0 THEN doc_id END AS doc_id", "text")
    docs = docs.union(docs.filter("doc_id IS NULL")).selectExpr("doc_id", "0 AS part", "text", "xxhash64(text) AS h")
    found = ordering.sequences(docs, PATH, layout, ("doc_id", "part"))
    assert found.select("part").distinct().count() > 2
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    rows = [(-1 if r.doc_id is None else r.doc_id, r.h, r.text) for r in docs.collect()]
    for d, _, text in sorted(rows, key=lambda r: r[:2]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 50256]
        for k in range(0, len(ids), 16):
            expected.append((d, k // 16, len(ids[k : k + 16]), zlib.crc32(np.array(ids[k : k + 16], "<u2").tobytes())))
    slots = ordering.permuted(np.arange(len(expected)), len(expected), 9)
    out = ordering.materialised(found, str(tmp_path / "shards"), 9, layout).collect()
    assert [(r.a, r.piece, r.used, r.ids_crc32) for r in sorted(out, key=lambda r: r.slot)] == [
        expected[i] for i in np.argsort(slots)
    ]
    plain = ordering.unpacked(found).collect()
    assert sorted((r.a, r.piece, r.used, zlib.crc32(bytes(r.ids)[: 2 * r.used])) for r in plain) == sorted(expected)


def test_disk_does_not_hold_sequences_twice(spark, made_documents, tmp_path):
    """The copy that is numbered is compressed, and no shuffle outlives its step."""
    docs = made_documents(6, n=300, unique=True)
    found = ordering.sequences(docs, PATH, keys=("doc_id", "block"))
    packed = found.selectExpr("sum(n) AS n", "sum(length(z)) AS size").first()
    assert packed.size < 0.7 * 256 * packed.n
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {p for f in folders for p in glob.glob(f"{f.getPath()}/*/shuffle_*")}

    before = shuffles()
    rows = ordering.materialised(found, str(tmp_path / "shards"), 1, ordering.Layout(per_shard=100))
    assert not shuffles() - before
    assert rows.count() == packed.n


def test_texts_encoded_at_once():
    tokenizer, library = ChunkTokenizer.of(PATH), Tokenizer.from_file(PATH)
    texts = ["", " ", "it's we'll  x\n\n y \t z ", "été \x1c\x85　 中文 ½ 😀‍", "a<|endoftext|> b", " " * 1_200_000 + "a"]
    for text in [*texts, "w" * 30_000, " ".join(f"x{i}" for i in range(40_000))]:
        assert tokenizer.encode_at_once(text).tolist() == library.encode(text, add_special_tokens=False).ids
