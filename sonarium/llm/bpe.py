"""Byte-level BPE encoding of a corpus with a public vocabulary.

Each task cuts its texts into words with the vocabulary's pattern and encodes each
distinct word once. A word is one array of part boundaries beside one of adjacent
ranks: scan for the least rank, delete a boundary, refresh the two ranks beside it.
Words too long for repeated scans take the same merges from a heap.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle, table

#: Fixed value: the public pattern that cuts text into words before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words of more bytes than this are merged with a heap.
SCAN_BYTES = 96
#: Encoded words that a worker remembers; it starts anew when they are more.
REMEMBERED = 400_000
NO_RANK = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_by_scan(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a short word."""
    bounds = list(range(len(word) + 1))
    near = [ranks.get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while near and (least := min(near)) != NO_RANK:
        i = near.index(least)
        del bounds[i + 1], near[i]
        if i < len(near):
            near[i] = ranks.get(word[bounds[i] : bounds[i + 2]], NO_RANK)
        if i:
            near[i - 1] = ranks.get(word[bounds[i - 1] : bounds[i + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word of any length, in time n log n: the same merges in the same order."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            end = after[after[i]]
            if (r := ranks.get(word[i:end])) is not None:
                heapq.heappush(heap, (r, i, end))

    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        gone = after[i]
        alive[gone] = False
        after[i] = end
        if end < n:
            before[end] = i
        offer(i)
        offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : after[i]]])
        i = after[i]
    return ids


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    if word in ranks:
        return [ranks[word]]
    return merge_by_scan(word, ranks) if len(word) <= SCAN_BYTES else merge_by_heap(word, ranks)


def encode_texts(texts: DataFrame, text: str, ranks: dict[bytes, int], pattern: str = WORDS) -> DataFrame:
    """``texts`` with ``ids``, the list of ids of the text as stored, without special tokens.

    A null text and an empty one both have an empty list. The vocabulary's ranks are
    broadcast: they are as many as it has tokens, whatever the corpus.
    """
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("the vocabulary must have all 256 bytes")
    shared = texts.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, find, known = shared.value, regex.compile(pattern).findall, {}
        for batch in batches:
            out = []
            for s in batch:
                row: list[int] = []
                for w in find(s) if s else ():
                    got = known.get(w)
                    if got is None:
                        got = known[w] = encode_word(w.encode("utf-8", "surrogatepass"), table)
                    row += got
                if len(known) > REMEMBERED:
                    known = {}
                out.append(row)
            yield pd.Series(out, index=batch.index, dtype=object)

    return texts.withColumn("ids", ids(F.col(text)))


def once(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` without repetitions: only those of a key that is there more than once are compared, the others stay where they are."""
    again = settle(rows.groupBy(key).count().where(F.col("count") > 1).select(key))
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"a.{key}"))
    single = rows.alias("r").join(again.alias("a"), same, "left_anti")
    return single.unionByName(rows.alias("r").join(again.alias("a"), same, "left_semi").distinct())


def default_vocabulary() -> str:
    """Where the public vocabulary byte_bpe_50k lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def p7_ids(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    ranks = load_ranks(vocabulary or default_vocabulary())
    return encode_texts(once(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), "text", ranks).select("doc_id", "ids")


QUERIES = {"p7_ids": p7_ids}
SQL: dict[str, str] = {}
