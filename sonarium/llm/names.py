"""Variant spellings of one name, by a join over sharded tries.

A name is taken apart into plain words, and the distinct words of all names, by sound
and as typed, go into tries. A word stands in the shards of its first letters with at
most one of them left out, and in the shard of its last letters: two words within two
edits share a shard, for either at most one edit is in the first letters or none is in
the last. A Levenshtein automaton walks a shard's trie and enumerates the words within
a bounded distance. A name's neighbours are then its words, in any order, with some of
them replaced by near ones, and meet the names that have just these words, by a key
that knows no order. Joined words, short forms and nicknames are further keys of a
name. Names that meet are compared in full: their words, in any order, must pair off
within the same bound.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle, shuffle_width, table
from .spelling import distance, given_names, sound, tokens

#: Edits between two spellings, over all words.
BOUND = 2
#: For the longer of two words, up to this many letters: first letters of which one may be left out, last letters, and the least length of the other word.
SHARDS = [(3, 1, 0, 1), (5, 2, 1, 1), (7, 3, 2, 4), (9, 4, 3, 6), (None, 5, 4, 8)]
#: Words in one trie; a larger shard is spread over several.
TRIE_WORDS = 20_000
#: Rows whose shards are walked together.
WALK_ROWS = 100_000
_FREE = 99


def bound_for(length: int) -> int:
    """Edits allowed for a word of this length."""
    return 0 if length < 4 else 1 if length < 6 else BOUND


def code_of(word: str) -> str:
    """A word by its sound; one without any as typed."""
    return sound(word) or word


@lru_cache(500_000)
def _number(code: str) -> int:
    return xxhash.xxh64_intdigest(code)


class _Hashes(dict):
    """Words to the 64-bit numbers of their codes, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = _number(code_of(word))
        return value


def _signed(number: int) -> int:
    """The lowest 64 bits as a signed number."""
    number &= (1 << 64) - 1
    return number - (1 << 64) if number >> 63 else number


def _forms(batches):
    """Rows (name, form, id, words) of names: the form is the plain words in order, the id its hash.

    A long single word that begins with an article may be a whole name typed as one: it has a second form without.
    """
    for batch in batches:
        out = []
        for name in batch.column(0).to_pylist():
            words = tokens(name)
            spelt = [words, [words[0][3:]]] if len(words) == 1 and len(words[0]) > 9 and words[0].startswith("the") else [words]
            for w in spelt:
                form = " ".join(w)
                out.append((name, form, _signed(xxhash.xxh64_intdigest(form)), w))
        cols, types = list(zip(*out)) or [()] * 4, (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["name", "form", "id", "words"])


def _fulls(word: str) -> set[str]:
    """What a short form of this word would be typed as."""
    begins = {word[:k] for k in range(1, 5) if k < len(word) and (k == 1 or len(word) - k >= 3)}
    return begins | {g[:1] for g in given_names(word)}


def _keys(batches):
    """Rows (key, id, typed) of forms (id, words): the sum of the words' hashes, for the words as typed and in other ways.

    Typed count the words as they are, also with two neighbours, or all, as one. The other ways:
    one word as a short form, a nickname as the given name, two words or all but one as
    initials.
    """
    hashes = _Hashes()
    for batch in batches:
        keys: list[int] = []
        ids: list[int] = []
        typed: list[bool] = []
        for form, words in zip(*(batch.column(i).to_pylist() for i in range(2))):
            h = [hashes[w] for w in words]
            whole = sum(h)
            joined = {whole + hashes[a + b] - hashes[a] - hashes[b] for a, b in zip(words, words[1:])} | {whole, hashes["".join(words)]}
            found: set[int] = set()
            for w, x in zip(words, h):
                found |= {whole - x + hashes[g] for g in given_names(w)}
                if len(words) > 1:
                    found |= {whole - x + hashes[f] for f in _fulls(w)}
            if len(words) > 2:
                first = [hashes[w[0]] - x for w, x in zip(words, h)]
                all_of = sum(first)
                found |= {whole + a + b for a, b in combinations(first, 2)} | {whole + all_of - a for a in first}
            found -= joined
            keys += [*map(_signed, joined), *map(_signed, found)]
            ids += [form] * (len(joined) + len(found))
            typed += [True] * len(joined) + [False] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(typed, pa.bool_())], names=["key", "id", "typed"])


class Trie:
    """Words as tries in arrays, one for each of ``count`` roots, their nodes level by level. With roots, words come sorted by root, then by themselves."""

    def __init__(self, words: list[str], roots: np.ndarray | None = None, count: int = 1):
        if roots is None:
            words, roots = sorted(set(words)), np.zeros(len(set(words)), np.int64)
        self.words = words
        letters = _letters(words)
        self.levels = []  # for each depth: first child of each node before, letter, word that ends here or -1
        node, nodes = roots.astype(np.int64), count
        alive = np.arange(len(words))
        for depth in range(letters.shape[1] - 1):
            alive = alive[letters[alive, depth] > 0]
            if not len(alive):
                break
            parent, letter = node[alive], letters[alive, depth]
            new = np.append(True, (parent[1:] != parent[:-1]) | (letter[1:] != letter[:-1]))
            number = np.cumsum(new) - 1
            ends = np.full(number[-1] + 1, -1)
            last = letters[alive, depth + 1] == 0
            ends[number[last]] = alive[last]
            self.levels.append((np.searchsorted(parent[new], np.arange(nodes + 1)), letter[new], ends))
            node[alive], nodes = number, len(ends)

    def within(self, asked: list[str], most: int, swaps: bool = False, roots: np.ndarray | None = None):
        """Pairs (index into asked, index into words, distance) of words under one root at most ``most`` edits apart.

        The automaton's state for a prefix is a row of the edit matrix around its
        diagonal; a walk ends where the whole row is beyond the bound. With ``swaps``, two
        neighbouring letters swapped are one edit, and the row before and its letter
        belong to the state.
        """
        if not self.levels or not len(asked):
            return
        width, dead = 2 * most + 1, most + 1
        letters = _letters(asked)
        lengths = (letters > 0).sum(axis=1)
        pad = np.zeros((len(asked), letters.shape[1] + 2 * width + 2 + len(self.levels)), np.int32)
        pad[:, width : width + letters.shape[1]] = letters
        q = np.arange(len(asked))
        at = np.zeros(len(asked), np.int64) if roots is None else roots.astype(np.int64)
        offsets = np.arange(-most, most + 1)
        rows = np.tile(np.where(offsets >= 0, offsets, dead), (len(asked), 1)).astype(np.int8)
        before, last = np.full_like(rows, dead), np.full(len(asked), -1, np.int32)
        for depth, (begin, letter, ends) in enumerate(self.levels, 1):
            first = begin[at]
            count = begin[at + 1] - first
            again = np.repeat(np.arange(len(at)), count)
            if not len(again):
                return
            child = np.repeat(first - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(len(again))
            q, old = q[again], rows[again]
            at_child = letter[child]
            near = pad[q[:, None], width + depth - 2 + np.arange(-most, most + 2)[None, :]]  # the letters around the diagonal
            new = old + (near[:, 1:] != at_child[:, None])  # the letter stands for one of the word's
            new[:, :-1] = np.minimum(new[:, :-1], old[:, 1:] + 1)  # a letter too many in the trie
            if swaps:
                crossed = (near[:, 1:] == last[again][:, None]) & (near[:, :-1] == at_child[:, None])
                new = np.where(crossed, np.minimum(new, before[again] + 1), new)
            column = depth + offsets
            length = lengths[q]
            for o in range(width):
                if column[o] < 0:
                    new[:, o] = dead
                else:
                    if column[o] == 0:
                        new[:, o] = min(depth, dead)
                    elif o:  # a letter of the word left out
                        new[:, o] = np.minimum(new[:, o], new[:, o - 1] + 1)
                    new[column[o] > length, o] = dead
            new = np.minimum(new, dead).astype(np.int8)
            keep = new.min(axis=1) <= most
            if swaps:  # a swap goes on from the row before
                keep |= old.min(axis=1) < most
            q, at, rows, before, last = q[keep], child[keep], new[keep], old[keep], at_child[keep]
            end = ends[at]
            spot = lengths[q] - depth + most
            hit = (end >= 0) & (spot >= 0) & (spot < width)
            if hit.any():
                d = rows[np.flatnonzero(hit), spot[hit]]
                ok = d <= most
                yield q[hit][ok], end[hit][ok], d[ok]


def _letters(words: list[str]) -> np.ndarray:
    """The words' characters as numbers, a row each, with at least one 0 at the end."""
    longest = max(map(len, words), default=0) + 1
    return np.array(words, dtype=f"U{longest}").view(np.uint32).reshape(len(words), longest).astype(np.int32)


def _near_words(rows: pa.Table) -> pa.RecordBatch:
    """Rows (code, other, edits) of the words of some shards that are within the bound of the shorter: a typed word's code and the hash of the other's."""
    words, lengths = rows.column("word").to_pylist(), rows.column("length").to_numpy()
    shards, asked, indexed = (rows.column(c).to_numpy() for c in ("shard", "typed", "indexed"))
    root = np.cumsum(np.append(False, shards[1:] != shards[:-1]))
    kept = np.flatnonzero(indexed)
    trie = Trie([words[i] for i in kept], root[kept], root[-1] + 1)
    bounds = np.where(lengths < 4, 0, np.where(lengths < 6, 1, BOUND))
    sounds = rows.column("sounds").to_numpy()
    found: dict[tuple[str, int], int] = {}
    for most in range(1, BOUND + 1):
        ask = np.flatnonzero(asked & (bounds == most))
        for begin in range(0, len(ask), 5_000):
            some = ask[begin : begin + 5_000]
            for q, w, d in trie.within([words[i] for i in some], most, True, root[some]):
                x, y = some[q], kept[w]
                ok = (x != y) & (d <= bounds[y])
                for i, j, far in zip(x[ok].tolist(), y[ok].tolist(), d[ok].tolist()):
                    a, b = (words[i], words[j]) if sounds[i] else (code_of(words[i]), code_of(words[j]))
                    if a != b:
                        pair = (a, _signed(_number(b)))
                        found[pair] = min(far, found.get(pair, far))
    cols = [pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.int64()), pa.array(list(found.values()), pa.int32())]
    return pa.RecordBatch.from_arrays(cols, names=["code", "other", "edits"])


def _walked(batches):
    """The near words of whole shards, as many at a time as make up WALK_ROWS; rows come sorted by shard and word."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < WALK_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        cut = np.flatnonzero(pc.not_equal(rows.column("shard"), rows.column("shard")[-1]).to_numpy())
        if len(cut):
            yield _near_words(rows.slice(0, cut[-1] + 1).combine_chunks())
            held = rows.slice(cut[-1] + 1).to_batches()
    if held and sum(b.num_rows for b in held):
        yield _near_words(pa.Table.from_batches(held).combine_chunks())


def word_cost(a: str, b: str, more: int = 0) -> int:
    """Edits between two words, ``more`` than else allowed in long ones; a short form or an initial of the other costs nothing."""
    if a == b or b in given_names(a) or a in given_names(b):
        return 0
    short, full = sorted((a, b), key=len)
    if full.startswith(short) and (len(short) == 1 or (len(short) <= 4 and len(full) - len(short) >= 3)):
        return 0
    if len(short) == 1 and any(g.startswith(short) for g in given_names(full)):
        return 0
    most = bound_for(len(short)) + (more if len(short) >= 8 else 0)
    d = min(distance(a, b, most), distance(sound(a), sound(b), most))
    return d if d <= most else _FREE


def _pairing(costs: list[list[int]]) -> int:
    """The least sum of a pairing of all rows with all columns, by augmenting paths."""
    n = len(costs)
    u, v, match = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, done = [_FREE * (n + 1)] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while match[j0]:
            done[j0], row, delta, j1 = True, match[j0], _FREE * (n + 1), 0
            for j in range(1, n + 1):
                if not done[j]:
                    if (c := costs[row - 1][j - 1] - u[row] - v[j]) < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if done[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return sum(costs[match[j] - 1][j - 1] for j in range(1, n + 1))


def name_cost(a: list[str], b: list[str], more: int = 0) -> int:
    """Edits between two names: their words pair off, in the order that costs least; with ``more``, as many beyond the bound."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1 < len(b) - 1:  # all words were typed as one
        return word_cost(a[0], "".join(b), more) if len(a[0]) > 9 else _FREE
    if len(b) - len(a) > 1 or not a:
        return _FREE
    if len(b) == len(a) + 1:  # one word was typed as two
        joined = [[*b[:i], b[i] + b[i + 1], *b[i + 2 :]] for i in range(len(b) - 1)]
        return min(name_cost(a, x, more) for x in joined)
    costs, floor = [], 0
    for x in a:
        costs.append([word_cost(x, y, more) for y in b])
        floor += min(costs[-1])
        if floor > BOUND + more:
            return _FREE
    best = min(sum(costs[i][j] for i, j in enumerate(p)) for p in permutations(range(len(b)))) if len(b) < 4 else _pairing(costs)
    # a name of initials alone, or of words that all differ, says nothing
    if best <= BOUND + more and not any(len(x) > 3 and min(row) < _FREE for x, row in zip(a, costs)):
        return _FREE
    return best


def _compare(batches):
    """Rows (form_a, form_b, cost), the lesser form first, of the pairs within the bound."""
    for batch in batches:
        out = []
        for fa, fb, wa, wb in zip(*(batch.column(i).to_pylist() for i in range(4))):
            cost = name_cost(wa, wb)
            if cost <= BOUND:
                out.append((min(fa, fb), max(fa, fb), cost))
        cols = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32()))], names=["form_a", "form_b", "cost"])


def plain_forms(names: DataFrame) -> DataFrame:
    """(name, form, id, words) of each distinct name; a null or blank name has no form and is left out."""
    distinct = names.select(F.col(names.columns[0]).alias("name")).where("trim(name) <> ''").distinct().repartition(shuffle_width(names.sparkSession), "name")
    return distinct.mapInArrow(_forms, "name string, form string, id bigint, words array<string>").where("form <> ''")


def _shards(word: Column, sounds: bool) -> Column:
    """The shards of a word, as numbers."""
    n, keys = F.length(word), []
    for most, first, last, shortest in SHARDS:
        starts = [F.substring(word, 1, first - 1)] + [F.concat(F.substring(word, 1, i), F.substring(word, i + 2, first - 1 - i)) for i in range(first)]
        own = F.array_distinct(F.transform(F.array(*starts), lambda x: F.xxhash64(F.lit(f"{first}<{sounds}"), x)))  # noqa: B023
        ends = F.array(F.xxhash64(F.lit(f"{first}>{sounds}"), F.right(word, F.lit(last))))
        inside = n >= shortest if most is None else (n >= shortest) & (n <= most)
        keys.append(F.when(inside, F.concat(own, ends)).otherwise(F.array().cast("array<bigint>")))
    return F.concat(*keys)


def near_words(forms: DataFrame) -> DataFrame:
    """(code, near): for each typed word's code the hashes of the codes of near words, typed ones or two typed as one, with the edits."""
    spark = forms.sparkSession
    w = forms.select("words").distinct()
    pairs = F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.size("words")), lambda a, b: F.concat(a, b))
    every = w.select(F.explode("words").alias("word"), F.lit(True).alias("typed")).unionByName(w.where("size(words) > 1").select(F.explode(F.array_append(pairs, F.array_join("words", ""))).alias("word"), F.lit(False).alias("typed")))
    distinct = every.where("length(word) >= 4").groupBy("word").agg(F.max("typed").alias("typed"))
    coded = distinct.mapInArrow(_coded, "word string, code string, typed boolean")
    as_typed = coded.select("word", F.length("word").alias("length"), "typed", F.lit(False).alias("sounds"))
    by_sound = coded.groupBy(F.col("code").alias("word")).agg(F.max(F.length("word")).alias("length"), F.max("typed").alias("typed")).withColumn("sounds", F.lit(True))
    shard = F.explode(F.when(F.col("sounds"), _shards(F.col("word"), True)).otherwise(_shards(F.col("word"), False))).alias("shard")
    sharded = settle(as_typed.unionByName(by_sound)).select(shard, "word", "length", "typed", "sounds")

    hot = settle(sharded.groupBy("shard").agg(F.ceil(F.count("*") / TRIE_WORDS).cast("int").alias("parts")).where("parts > 1"))
    placed = sharded.join(hot, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("home", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    sent = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.withColumn("indexed", F.col("home") == F.col("part")).where("typed or indexed")
    sent = sent.select(F.when(F.col("parts") > 1, F.xxhash64("shard", "part")).otherwise(F.col("shard")).alias("shard"), "word", "length", "typed", "sounds", "indexed")
    # By number, lest the small shuffle be drawn together into one task: the walks are what costs.
    sent = sent.repartition(4 * shuffle_width(spark), "shard").sortWithinPartitions("shard", "word")
    pairs = sent.mapInArrow(_walked, "code string, other bigint, edits int")
    least = pairs.groupBy("code", "other").agg(F.min("edits").alias("edits"))
    return least.groupBy("code").agg(F.collect_list(F.struct("other", "edits")).alias("near"))


def _coded(batches):
    for batch in batches:
        codes = [code_of(w) for w in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.string()), batch.column(1)], names=["word", "code", "typed"])


def _edited(batches):
    """Rows (key, id) of forms (id, words, places): the keys with one word replaced by a near one, or two by words one edit away."""
    hashes = _Hashes()
    for batch in batches:
        keys: list[int] = []
        ids: list[int] = []
        for form, words, places in zip(*(batch.column(i).to_pylist() for i in range(3))):
            whole = sum(hashes[w] for w in words)
            steps = [[(n["other"] - _number(p["code"]), n["edits"]) for n in p["near"]] for p in places]
            found = {whole + d for s in steps for d, _ in s}
            ones = [[d for d, c in s if c == 1] for s in steps]
            for x, y in combinations(ones, 2):
                found |= {whole + a + b for a in x for b in y}
            keys += map(_signed, found)
            ids += [form] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64())], names=["key", "id"])


def similar_forms(forms: DataFrame) -> DataFrame:
    """(form_a, form_b, cost) of forms that may be spellings of one name; each pair once, in order."""
    width = shuffle_width(forms.sparkSession)
    forms = settle(forms.groupBy("id", "form").agg(F.first("words").alias("words")).repartition(width, "id"))
    keys = settle(forms.select("id", "words").mapInArrow(_keys, "key bigint, id bigint, typed boolean"))
    near = settle(near_words(forms))

    words = forms.select("id", F.posexplode("words").alias("pos", "word")).where("length(word) >= 4")
    places = words.mapInArrow(_placed_codes, "id bigint, pos int, code string").join(near, "code")
    around = places.groupBy("id").agg(F.collect_list(F.struct("code", "near")).alias("places")).join(forms, "id").select("id", "words", "places")
    edited = around.mapInArrow(_edited, "key bigint, id bigint")

    asked = edited.unionByName(keys.where("typed").select("key", "id")).withColumnRenamed("id", "a")
    met = asked.join(keys.select("key", F.col("id").alias("b")), "key").where("a <> b")
    both = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda i, f, w: forms.select(F.col("id").alias(i), F.col("form").alias(f), F.col("words").alias(w))
    compared = both.join(side("a", "fa", "wa"), "a").join(side("b", "fb", "wb"), "b").select("fa", "fb", "wa", "wb").repartition(width)
    return compared.mapInArrow(_compare, "form_a string, form_b string, cost int")


def _placed_codes(batches):
    for batch in batches:
        codes = [code_of(w) for w in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string())], names=["id", "pos", "code"])


def variant_pairs(records: DataFrame) -> DataFrame:
    """(key_a, key_b, cost) of records that name the same one, the smaller key first.

    ``records`` has key and name, and mbid: two records with different mbids are
    never the same; null says nothing. Null and blank names are nobody's. Repeated
    rows count once, extra columns are ignored. Equal spellings are pairs of cost 0.
    """
    rows = records.where("key is not null").select("key", "name", "mbid").distinct()
    forms = settle(plain_forms(rows.select("name")))
    known = settle(rows.join(forms.select("name", "form"), "name").select("key", "form", "mbid"))
    linked = similar_forms(forms)
    same = known.select("form").distinct().select(F.col("form").alias("form_a"), F.col("form").alias("form_b"), F.lit(0).alias("cost"))
    left = known.select(F.col("key").alias("ka"), F.col("form").alias("form_a"), F.col("mbid").alias("ma"))
    right = known.select(F.col("key").alias("kb"), F.col("form").alias("form_b"), F.col("mbid").alias("mb"))
    pairs = linked.unionByName(same).join(left, "form_a").join(right, "form_b").where("ka <> kb and (ma is null or mb is null or ma = mb)")
    ordered = pairs.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"), "cost")
    return ordered.groupBy("key_a", "key_b").agg(F.min("cost").alias("cost"))


def act_records(spark, sf_dir: str) -> DataFrame:
    """(key, name, mbid) of artists and candidates."""
    artists, candidates = table(spark, sf_dir, "artist"), table(spark, sf_dir, "bc_candidate")
    return artists.where("id is not null").select(F.concat(F.lit("artist:"), "id").alias("key"), F.col("display_name").alias("name"), "mbid").unionByName(
        candidates.where("id is not null").select(
            F.concat(F.lit("bc_candidate:"), F.col("id").cast("string")).alias("key"), F.col("band_name").alias("name"), F.lit(None).cast("string").alias("mbid")
        )
    )


def p1_found(spark, sf_dir: str) -> DataFrame:
    return variant_pairs(act_records(spark, sf_dir)).select("key_a", "key_b")


QUERIES = {"p1_found": p1_found}
SQL: dict[str, str] = {}
