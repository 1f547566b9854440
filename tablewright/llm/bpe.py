"""Byte-level BPE with a file of ranks: encoding by merges over distinct words, and decoding.

Texts are cut into words by the vocabulary's pattern. Documents lie in blocks. A block asks for its
distinct words, packed by ranges of a hash; each distinct word of the corpus is encoded once, where
its range lies, and the answers come back to the block, so neither the vocabulary of the corpus nor
any document's words are ever rows of a join. A block asks in order, since sorted words compress.

A word's pieces are folded: each step merges the leftmost pair of least rank and looks up the two new
pairs only. As a step also goes over all pairs, the fold takes time that grows with the square of a
word's length; the rare words of more than ``LONG`` bytes (runs of letters without blanks, as of some
scripts or of encoded data) take the same merges from a queue instead. Decoding concatenates the
pieces of the ids; as that goes id by id, it is done for each distinct word, and texts are put
together from their words.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tablewright.llm.common import (
    block_count,
    dealt,
    freeing,
    packed_list,
    plain_texts,
    unpacked_list,
)
from tablewright.llm.vocabulary import Remembered, chunks, compiled, words_of

LONG = 256  # bytes of the longest word that is folded
NEVER = 2**31 - 1  # the rank of a pair that does not merge
MEMORY = 150_000  # chunks of a generation that a task remembers for a block


def ranks(path: str) -> dict[bytes, int]:
    """Rank of each piece of a file of base64 pieces and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def folded(word: bytes, of: dict[bytes, int]) -> list[int]:
    """Ids of a word: the pair of least rank, the leftmost of several, is merged until none is left."""
    if word in of:
        return [of[word]]
    rank = of.get
    pieces = [word[i : i + 1] for i in range(len(word))]
    pairs = [rank(a + b, NEVER) for a, b in zip(pieces, pieces[1:])]
    while pairs and (least := min(pairs)) != NEVER:
        i = pairs.index(least)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = rank(pieces[i - 1] + pieces[i], NEVER)
        if i < len(pairs):
            pairs[i] = rank(pieces[i] + pieces[i + 1], NEVER)
    return [of[p] for p in pieces]


def merged(word: bytes, of: dict[bytes, int], longest: int) -> list[int]:
    """As ``folded``. Pairs wait in a queue; those that no longer exist when their turn comes are passed over."""
    if word in of:
        return [of[word]]
    n = len(word)
    after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []

    def wait(begin: int, end: int) -> None:
        if end - begin <= longest and (rank := of.get(word[begin:end])) is not None:
            heapq.heappush(queue, (rank, begin, end))

    for i in range(n - 1):
        wait(i, i + 2)
    while queue:
        _, begin, end = heapq.heappop(queue)
        right = after[begin]
        if right >= n or ends[right] != end:
            continue
        ends[begin], after[begin] = end, after[right]
        after[right] = n  # the right piece begins nothing any more
        if after[begin] < n:
            before[after[begin]] = begin
            wait(begin, ends[after[begin]])
        if before[begin] >= 0:
            wait(before[begin], end)
    ids, at = [], 0
    while at < n:
        ids.append(of[word[at : ends[at]]])
        at = ends[at]
    return ids


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    blocks: int | None = None,
    ids: bool = True,
) -> DataFrame:
    """One row for each document: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined
    by one space), ``decoded_sha256`` (of the bytes the ids decode to) and, unless switched off,
    ``ids``. A NULL text is empty; repeated rows are encoded each. Time grows with a text's length, also
    where it is one word."""
    n = blocks or block_count(docs.sparkSession)
    of = ranks(path)
    packed = dealt(docs, n, doc_id, text)
    by_block = packed.groupBy("block")
    asked = by_block.applyInArrow(
        lambda t: _asked(t, pattern, n), "bucket int, block int, words binary"
    )
    answers = asked.groupBy("bucket").applyInArrow(
        lambda t: _answers(t, of), "block int, words binary, ids binary, decoded binary"
    )
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        lambda t, a: _encoded_block(t, a, pattern, ids),
        schema + (", ids array<int>" if ids else ""),
    )


@freeing
def _asked(packed: pa.Table, pattern: str, buckets: int) -> pa.Table:
    find = compiled(pattern).findall
    parts, words = set(), set()
    for data in plain_texts(packed):
        text = (data or b"").decode()
        cut = chunks(text)
        if cut is None:
            words.update(find(text))
        else:
            words.update(find(cut[0]))
            parts.update(cut[1:])
    for part in parts:
        words.update(words_of(part, find))
    lists: dict[int, list[bytes]] = {}
    for data in sorted(map(str.encode, words)):
        lists.setdefault(xxhash.xxh64_intdigest(data) % buckets, []).append(data)
    block = packed.column("block")[0].as_py()
    return pa.table(
        {
            "bucket": pa.array(list(lists), pa.int32()),
            "block": pa.array([block] * len(lists), pa.int32()),
            "words": pa.array(list(map(packed_list, lists.values())), pa.binary()),
        }
    )


@freeing
def _answers(rows: pa.Table, of: dict[bytes, int]) -> pa.Table:
    """For every block that asks, its words of a bucket, their ids and what these decode to; words that
    several blocks ask for are encoded once."""
    longest, pieces = max(map(len, of)), {rank: piece for piece, rank in of.items()}
    known: dict[bytes, tuple[bytes, bytes]] = {}
    answers: list[tuple[bytes, bytes]] = []
    for batch in rows.select(["words"]).to_batches(1):
        found = []
        for word in unpacked_list(batch.column(0)[0].as_py()):
            one = known.get(word)
            if one is None:
                ids = folded(word, of) if len(word) <= LONG else merged(word, of, longest)
                one = " ".join(map(str, ids)).encode(), b"".join(map(pieces.__getitem__, ids))
                known[word] = one
            found.append(one)
        answers.append(tuple(packed_list(list(x)) for x in zip(*found)))
    ids, decoded = zip(*answers)
    return pa.table(
        {
            "block": rows.column("block"),
            "words": rows.column("words"),
            "ids": pa.array(ids, pa.binary()),
            "decoded": pa.array(decoded, pa.binary()),
        }
    )


@freeing
def _encoded_block(packed: pa.Table, answers: pa.Table, pattern: str, ids: bool) -> pa.Table:
    find = compiled(pattern).findall
    known: dict[str, tuple[str, bytes]] = {}
    for row in answers.to_batches(1):
        words, numbers, decoded = (
            unpacked_list(row.column(c)[0].as_py()) for c in ("words", "ids", "decoded")
        )
        known.update((w.decode(), (n.decode(), d)) for w, n, d in zip(words, numbers, decoded))

    def joined(words: list[str]) -> tuple[str, bytes]:
        if len(words) == 1:
            return known[words[0]]
        found = [known[w] for w in words]
        return " ".join([n for n, _ in found]), b"".join([d for _, d in found])

    remembered = Remembered(lambda chunk: joined(words_of(chunk, find)), MEMORY)
    columns: list[list] = [[], [], [], [], []]
    for doc, data in zip(packed.column("id").to_pylist(), plain_texts(packed)):
        text = (data or b"").decode()
        cut = chunks(text)
        if cut is None:
            numbers, decoded = joined(find(text))
        else:
            found = [remembered[c] for c in cut[1:]]
            if cut[0]:
                found.insert(0, joined(find(cut[0])))
            numbers, decoded = " ".join([n for n, _ in found]), b"".join([d for _, d in found])
        row = (
            doc,
            numbers.count(" ") + 1 if numbers else 0,
            hashlib.sha256(numbers.encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest(),
            list(map(int, numbers.split())) if ids else None,
        )
        for values, value in zip(columns, row):
            values.append(value)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
    taken = 5 if ids else 4
    return pa.table({n: pa.array(v, k) for n, v, k in zip(names[:taken], columns, kinds)})
