"""Evaluation texts in training texts, by winnowing.

Texts are compared as words without case, accents, punctuation, markup and invisible
characters. Every k-gram of the evaluation texts is a fingerprint; of a training text
the least hash of each window is kept. A shared span of ``window + k - 1`` words
therefore always shares a fingerprint. Shared fingerprints join the two sides, and
each hit is extended in the words of its text: to the longest run of equal words, and
to the share of the passage that stands, in order, in the words around the hit.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle, table

GRAM, WINDOW = 4, 4
#: Consecutive words in common that make a case; a fingerprint is sure from ``GRAM + WINDOW - 1`` on.
SPAN = 12
#: Diagonals of a band in which two fingerprints count as of one passage.
BAND = 32
#: Share of a passage's words, in order, that makes "nearly all" of it.
NEARLY_ALL = 0.8
#: Evaluation k-grams up to which they are sent to every task; a larger set is joined by shuffling.
BROADCAST_GRAMS = 1_000_000

_MARKUP = regex.compile(r"<!--.*?-->|</?[A-Za-z][^<>]{0,300}>", regex.S)
_DROPPED = regex.compile(r"[\p{M}\p{Cf}\x00-\x08\x0e-\x1b\x7f'’‘ʼ`´]+")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_ASCII_WORD = re.compile(r"[a-z0-9]+")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1b\x7f]")
#: Letters that compatibility decomposition leaves alone.
_PLAIN = str.maketrans({"ø": "o", "đ": "d", "ł": "l", "ı": "i", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ħ": "h"})


def plain_words(text: str | None) -> list[str]:
    """The words of a text as they count; a null, empty or blank text has none."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    if text.isascii():
        text = text.replace("'", "").replace("`", "").lower()
        return _ASCII_WORD.findall(text if text.isprintable() else _CONTROL.sub("", text))
    text = unicodedata.normalize("NFKD", text)
    return _WORD.findall(_DROPPED.sub("", text).casefold().translate(_PLAIN))


class _Hashed(dict):
    """Words to signed 64-bit numbers, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return value


def gram_hashes(words: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A hash of each run of ``k`` word numbers."""
    if len(words) < k:
        return np.empty(0, np.int64)
    h = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - k + 1 + j].view(np.uint64)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of each window; of equal ones the last. All of a shorter text's windows are one."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    at = np.arange(len(views)) + window - 1 - np.argmin(views, axis=1)  # never falls
    return at[np.append(True, at[1:] != at[:-1])]


def longest_common_order(item: list[int], text: list[int]) -> int:
    """How many words of ``item`` stand in ``text`` in the same order (bit-parallel)."""
    at: dict[int, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _item_grams(batches):
    hashed = _Hashed()
    for batch in batches:
        ids, fields, texts = (batch.column(i).to_pylist() for i in range(3))
        out: list[tuple] = []
        for item, field, text in zip(ids, fields, texts):
            words = np.array([hashed[w] for w in plain_words(text)], np.int64)
            if len(words):
                out.append((item, field, words.tobytes(), gram_hashes(words).tolist()))
        cols = list(zip(*out)) or [(), (), (), ()]
        types = (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["item_id", "field", "item_words", "grams"])


def _fingerprints(known):
    """Rows (doc_id, h, pos) of the fingerprints of texts, of those among the known ones if they are given."""

    def run(batches):
        hashed = _Hashed()
        grams = None if known is None else known.value
        if grams is not None and not len(grams):
            return
        for batch in batches:
            docs, at_all, h_all = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = gram_hashes(np.array([hashed[w] for w in plain_words(text)], np.int64))
                at = winnowed(hashes)
                if grams is not None and len(at):
                    place = np.minimum(np.searchsorted(grams, hashes[at]), len(grams) - 1)
                    at = at[grams[place] == hashes[at]]
                if len(at):
                    docs.append(np.full(len(at), doc, np.int64))
                    at_all.append(at)
                    h_all.append(hashes[at])
            join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(join(docs)), pa.array(join(h_all)), pa.array(join(at_all).astype(np.int32))], names=["doc_id", "h", "pos"])

    return run


def _numbered(batches):
    """Rows (doc_id, words) of texts, the words as numbers."""
    hashed = _Hashed()
    for batch in batches:
        words = [np.array([hashed[w] for w in plain_words(text)], np.int64).tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["doc_id", "words"])


def share_in_order(item: np.ndarray, text: np.ndarray, diagonals: list[int], least: float) -> float:
    """The most of the item's words that stand in the text in order, around a hit; 0 where it can't be ``least``."""
    share, slack, done = 0.0, 8 + len(item) // 6, None
    words = item.tolist()
    for d in sorted(set(diagonals)):
        if done is not None and d - done < slack // 2:
            continue
        done = d
        near = text[max(0, d - slack) : max(0, d + len(item) + slack)]
        if np.isin(item, near).sum() >= least * len(item):  # else not in order either
            share = max(share, longest_common_order(words, near.tolist()) / len(item))
    return share


def _extend(batches):
    items: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
    last, text, spans = None, np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        out = []
        for doc, item, field, words, item_words, diagonals in zip(*(cols[n] for n in ("doc_id", "item_id", "field", "words", "item_words", "diagonals"))):
            if words != last:
                last, text = words, np.frombuffer(words, np.int64)
                spans = gram_hashes(text, SPAN)
            if item_words not in items:
                if len(items) > 10_000:
                    items.clear()
                of_item = np.frombuffer(item_words, np.int64)
                items[item_words] = of_item, gram_hashes(of_item, SPAN)
            of_item, item_spans = items[item_words]
            run = bool(np.isin(item_spans, spans).any())
            share = share_in_order(of_item, text, diagonals, NEARLY_ALL)
            if run or share >= NEARLY_ALL:
                out.append((doc, item, field, run, share))
        rows = list(zip(*out)) or [(), (), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["doc_id", "item_id", "field", "run", "share"])


def shared_passages(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, field, run, share) of every text and evaluation text that have SPAN words in a row or NEARLY_ALL in common.

    ``documents`` has doc_id and text, ``items`` item_id, passage and question; other
    columns are ignored. ``run``: they share SPAN consecutive words. ``share``: the
    part of the item's words that stand in the text in order, around a hit, 0 where it
    can't be NEARLY_ALL. Null, empty and blank texts on either side share nothing;
    repeated rows count once. Spans of SPAN words are found for sure; of passages whose
    words are altered, those of which two fingerprints are left.
    """
    spark = documents.sparkSession
    sides = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("passage", "question"))))
    texts = items.select("item_id", sides.alias("t")).where("item_id is not null and t.text is not null").select("item_id", "t.field", "t.text").distinct()
    held = settle(texts.mapInArrow(_item_grams, "item_id bigint, field string, item_words binary, grams array<bigint>"))
    grams = held.select("item_id", "field", F.posexplode("grams").alias("ipos", "h")).distinct()
    small = held.agg(F.sum(F.size("grams"))).first()[0] or 0
    known = None
    if small <= BROADCAST_GRAMS:  # the fingerprints and items themselves are small, then
        numbers = grams.select("h").distinct().toArrow().column("h").to_numpy()
        known = spark.sparkContext.broadcast(np.sort(numbers))
        grams, held = F.broadcast(grams), F.broadcast(held)
    rows = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    prints = rows.mapInArrow(_fingerprints(known), "doc_id bigint, h bigint, pos int")
    # SPAN words in a row have more grams than a window twice, so at least two fingerprints on one diagonal; one alone is
    # chance. Bands of diagonals overlap by half, so that words left out or added in between part no hits.
    d = F.col("pos") - F.col("ipos")
    bands = F.explode(F.array(F.floor(d / BAND) * 2, F.floor(d / BAND + 0.5) * 2 + 1))
    met = prints.join(grams, "h").select("doc_id", "item_id", "field", "pos", d.alias("d"), bands.alias("band")).groupBy("doc_id", "item_id", "field", "band")
    near = met.agg(F.collect_set("d").alias("of"), F.min("pos").alias("low"), F.max("pos").alias("high")).where("low < high")
    pairs = settle(near.groupBy("doc_id", "item_id", "field").agg(F.array_distinct(F.flatten(F.collect_list("of"))).alias("diagonals")))
    hit = rows.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    words = hit.mapInArrow(_numbered, "doc_id bigint, words binary")  # of texts with a hit alone
    whole = pairs.join(words, "doc_id").join(held.select("item_id", "field", "item_words"), ["item_id", "field"])
    return whole.mapInArrow(_extend, "doc_id bigint, item_id bigint, field string, run boolean, share double")


def p8_found(spark, sf_dir: str) -> DataFrame:
    shared = shared_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    found = shared.where(F.col("run") | ((F.col("field") == "passage") & (F.col("share") >= NEARLY_ALL)))
    return found.select("doc_id", "item_id").distinct()


QUERIES = {"p8_found": p8_found}
SQL: dict[str, str] = {}
