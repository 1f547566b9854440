"""Ids against the library, and the way back."""

import base64
import hashlib
import random
import time

import public_tokenizers
import tiktoken

from tablewright.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_documents(spark, made_documents):
    rng = random.Random(4)
    pieces = [" ", "  ", "\n", "a", "Über", "don't", "'ll", "12", "!!", " ", "\x1c", "日本", "é",
              "<|endoftext|>", "word", "\r\n", "\x85", "🙂", "½", "x" * 300, "antidisestablishment"]
    extra = [
        (5000 + i, "".join(rng.choice(pieces) for _ in range(rng.randrange(12))), "", f"e{i}", 0, 0)
        for i in range(200)
    ]
    docs = made_documents(7)
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={}
    )
    out = bpe.encoded(docs, PATH, public_tokenizers.PATTERN, blocks=4).collect()
    found = sorted(((r.doc_id, r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out), key=repr)
    expected = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        joined = " ".join(map(str, ids)).encode()
        expected.append(
            (r.doc_id, ids, len(ids), hashlib.sha256(joined).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest())
        )
    assert found == sorted(expected, key=repr)


def test_long_words(spark):
    """Runs of letters, ideographs and encoded bytes, around the longest that is folded and far beyond."""
    rng = random.Random(8)
    letters, signs = "etaoinshrdlu", "的一是不了人我在有他这中大来上国个到说们"
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={}
    )
    texts = ["".join(rng.choices(letters, k=n)) for n in (255, 256, 257, 300, 100_000)]
    texts += ["".join(rng.choices(signs, k=n)) for n in (85, 86, 50_000)]
    texts += ["a" * 5000, "ab" * 3000, "=-" * 700, base64.b64encode(rng.randbytes(3000)).decode()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    begin = time.perf_counter()
    out = {r.doc_id: r.ids for r in bpe.encoded(docs, PATH, public_tokenizers.PATTERN, blocks=4).collect()}
    assert time.perf_counter() - begin < 60
    for i, t in enumerate(texts):
        assert out[i] == library.encode_ordinary(t)


def test_queue_and_library_agree():
    rng = random.Random(9)
    of = bpe.ranks(PATH)
    longest = max(map(len, of))
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=of, special_tokens={})
    for _ in range(300):
        word = "".join(rng.choices("aeinst theé日-", k=rng.randrange(1, 80)))
        assert bpe.merged(word.encode(), of, longest) == library.encode_ordinary(word)


def test_fold_and_library_agree():
    rng = random.Random(10)
    of = bpe.ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=of, special_tokens={})
    for _ in range(2000):
        word = "".join(rng.choices("aeinst theé日-=", k=rng.randrange(1, 60)))
        assert bpe.folded(word.encode(), of) == library.encode_ordinary(word)


def test_words_are_encoded_where_they_are_gathered(spark, made_documents):
    """No interpreted functions over each distinct word, and no rows of words: asked and answered in one step."""
    plan = bpe.encoded(made_documents(), PATH, public_tokenizers.PATTERN, blocks=4, ids=False)
    told = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in told and "aggregate(" not in told
    assert told.count("FlatMapGroupsInArrow") == 2


def test_ranks_are_those_of_the_file():
    of = bpe.ranks(PATH)
    with open(PATH, "rb") as file:
        first = file.readline().split()
    assert of[base64.b64decode(first[0])] == int(first[1])


def test_empty_table(made_documents):
    docs = made_documents().filter("false")
    assert bpe.encoded(docs, PATH, public_tokenizers.PATTERN).collect() == []
