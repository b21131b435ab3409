"""LM scoring: an interpolated modified Kneser-Ney model of any order (3 unless told otherwise), counted in Spark.

1. Texts are tokenized once: each slice is written with a number of its own, as its
   distinct word hashes and the tokens' places among them (a text begins with a start
   token, an end token closes it).  All counting and scoring reads these slices.
2. For each order k from 2 to the highest, every slice sends its k-grams on in arrays,
   one for each shard: context hash, word, training occurrences (0 in held-out texts
   only), and below the highest order the word before.  K-grams whose words before, as
   far as the highest order looks, are the same are sent once.
   A shard counts its k-grams: below the highest order a k-gram's count is the
   number of different words before it (its occurrences where it opens a text).
   It answers each slice in the order in which the slice asked: the counts of its
   k-grams, and for each of its contexts the total and how many of its k-grams
   count one, two or more.
3. Each slice sends its different words to shards of words, which get from the shards
   of order 2 the occurrences and how many different words stand before each, and
   answer likewise.  Only a few numbers per shard reach the driver (totals, counts of
   counts), from which follow all discounts.
4. A slice's tokens meet its answers by its number, and its texts are scored, in
   several rounds too; what was written before is removed then.

No step looks anything up at random: each reads what was sent to it once, in whole
arrays, so time, memory of a task and files follow the text.

K-grams are sharded by their context; contexts that take a large share in a
bounded sample are sharded by the k-gram instead, and their totals are summed
apart, which only spreads the work.  Each order is counted in several rounds
over the slices, one part of the shards in each, so that shuffle files take a
part of the disk only.  All counts cover all training texts.

Cases: null and empty texts are one end token; null ids are trained on;
equal rows count each; with no training text every token has the uniform
probability 1 / (V + 1); an empty table gives no rows.  Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, remove_staged, slices, staged
from ticklake.llm.words import Words, mix

SLICE, SHARD_BYTES, MIN_SHARDS, SAMPLE_DOCS = 4 << 20, 8 << 20, 64, 1000
ORDER, ROUND_BYTES, MAX_ROUNDS, WORD_SHARE = 3, 64 << 20, 3, 4
_START, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SUMS = ["tokens", "vocabulary", "types", "u1", "u2", "u3", "u4", "u5"]
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, the token before each, index of each text's first token, one more at the end)."""
    words = Words(texts)
    n = len(words.first) - 1
    out = np.empty(len(words) + n, np.uint64)
    out[np.arange(len(words)) + words.text_of()] = words.hashes(lower=True)
    first = words.first + np.arange(n + 1)
    out[first[1:] - 1] = _END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[first[:-1]] = _START
    return out, before, first


def pair_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR + token)


def contexts(before: np.ndarray, first: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(hashes of the 1, 2, ... order - 1 words before each token, each token's place in its text).

    The m words before are there from place m - 1 on, the start token being one of them.
    """
    place = np.arange(len(before)) - np.repeat(first[:-1], np.diff(first))
    out = [before]
    for m in range(1, order - 1):
        out.append(pair_keys(out[-1], shifted(before, m)))
    return out, place


def shifted(x: np.ndarray, m: int) -> np.ndarray:
    """x of m places before."""
    out = np.zeros_like(x)
    out[m:] = x[:len(x) - m]
    return out


def sorting(x: np.ndarray) -> np.ndarray:
    """``argsort`` of 64-bit hashes, stable: their high bits are sorted with the places in the low ones, several times
    faster; the few sets in which the high bits don't tell two hashes apart are sorted in full."""
    low = np.uint64((1 << max(1, (len(x) - 1).bit_length())) - 1)
    packed = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    values = x[order]
    return order if (values[1:] >= values[:-1]).all() else np.argsort(x, kind="stable")


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted different values, the first place of each, the number of each element's value); np.unique sorts several times slower."""
    order = sorting(x)
    values = x[order]
    new = np.ones(len(x), bool)
    new[1:] = values[1:] != values[:-1]
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    return values[new], order[new], number


def among(x: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which elements occur in a short sorted array: most are ruled out by 16 bits."""
    if not len(few):
        return np.zeros(len(x), bool)
    table = np.zeros(1 << 16, bool)
    table[few & np.uint64(0xFFFF)] = True
    out = table[x & np.uint64(0xFFFF)]
    at = np.flatnonzero(out)
    place = np.searchsorted(few, x[at])
    place[place == len(few)] = 0
    out[at] = few[place] == x[at]
    return out


def spread(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Evenly dealt numbers below ``shards``, by the high half of each hash (a product instead of a slow division)."""
    return ((mix(hashes) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def shard_of(context: np.ndarray, token: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """A k-gram's shard: that of its context, for hot contexts that of the k-gram."""
    common = np.flatnonzero(among(context, hot))
    if len(common):
        context = context.copy()
        context[common] = pair_keys(context[common], token[common])
    return spread(context ^ _PAIR, shards)


def by_shard(shard: np.ndarray) -> np.ndarray:
    """Stable order by shard number (a radix sort while the numbers have 16 bits)."""
    narrow = shard.astype(np.uint16) if not len(shard) or shard.max() < 1 << 16 else shard
    return np.argsort(narrow, kind="stable")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def binaries(x: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An array cut into runs of the given sizes, each run a binary value."""
    x = np.ascontiguousarray(x)
    cuts = np.concatenate([[0], np.cumsum(sizes)]) * (x.nbytes // max(1, len(x)))
    if cuts[-1] >= 1 << 31:
        raise ValueError("more than 2 GB of one slice or shard")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(x)])


def joined(arrays: pa.Array | pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``binaries`` cut: (the whole array, the size of each run)."""
    parts, sizes = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    width = np.dtype(kind).itemsize
    for x in arrays.chunks if isinstance(arrays, pa.ChunkedArray) else [arrays]:
        x = x.cast(pa.large_binary())
        if len(x):
            off = np.frombuffer(x.buffers()[1], np.int64, len(x) + 1, x.offset * 8)
            sizes.append(np.diff(off) // width)
            if off[-1] > off[0]:
                parts.append(np.frombuffer(x.buffers()[2], kind, (off[-1] - off[0]) // width, off[0]))
    return np.concatenate(parts), np.concatenate(sizes)


def small(x: np.ndarray, sizes: np.ndarray, width: int = 1) -> list[pa.Array]:
    """Whole numbers in runs of ``sizes`` times ``width``: a byte each, and apart, in the same order, those of 255 and more."""
    x = np.ascontiguousarray(x).ravel()
    large = x >= 255
    each = np.bincount(np.repeat(np.arange(len(sizes)), np.asarray(sizes) * width)[large], minlength=len(sizes))
    return [binaries(np.minimum(x, 255).astype(np.uint8), np.asarray(sizes) * width), binaries(x[large].astype(np.int64), each)]


def whole(low: pa.ChunkedArray, apart: pa.ChunkedArray, width: int = 1) -> np.ndarray:
    """What ``small`` made, in rows of ``width``."""
    x = joined(low, np.uint8)[0].astype(np.int64)
    x[x == 255] = joined(apart, np.int64)[0]
    return x.reshape(-1, width)


def coded(stats: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """Rows of (total, number of ones, of twos, of larger ones) in runs: a byte for few ones and twos alone, the others ``small``."""
    _, ones, twos, more = stats.T
    few = (more == 0) & (ones < 16) & (twos < 15)
    others = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~few], minlength=len(sizes))
    return [binaries(np.where(few, ones + 16 * twos, 255).astype(np.uint8), sizes), *small(stats[~few], others, 4)]


def decoded(code: pa.ChunkedArray, low: pa.ChunkedArray, apart: pa.ChunkedArray) -> np.ndarray:
    """What ``coded`` made."""
    x = joined(code, np.uint8)[0]
    out = np.zeros((len(x), 4), np.int64)
    out[:, 1], out[:, 2] = x & 15, x >> 4
    out[:, 0] = out[:, 1] + 2 * out[:, 2]
    out[x == 255] = whole(low, apart, 4)
    return out


_TOKENS = "slice long, ids array<long>, held array<boolean>, sizes array<int>, words binary, places binary"


def tokenized(docs: DataFrame) -> DataFrame:
    """The tokens of all texts, written once: per slice its number, the documents (id, held out, tokens), the distinct
    word hashes, common ones first, and each token's place among them (lowest bytes first, then the next
    ones as far as needed: what is left of the higher ones compresses)."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, target=SLICE):
            token, _, first = tokens(column(part, "text"))
            words, _, places = distinct(token)
            common = np.argsort(-np.bincount(places), kind="stable")
            rank = np.empty_like(common)
            rank[common] = np.arange(len(common))
            words, places = words[common], rank[places].astype("<u4").view(np.uint8).reshape(-1, 4).T
            places = places[:1 + (len(words) > 1 << 8) + (len(words) > 1 << 16) + (len(words) > 1 << 24)]
            one = [[number], [column(part, "doc_id").to_pylist()], [column(part, "held_out").to_pylist()], [np.diff(first).astype(np.int32)],
                   [words.tobytes()], [places.tobytes()]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(one, kinds, strict=True)],
                                             names=["slice", "ids", "held", "sizes", "words", "places"])
            number += 1

    return staged(map_arrow(docs.select("doc_id", "text", held_out().alias("held_out")), step, _TOKENS), "tokens", compression="zstd")


@dataclass
class Slice:
    """Tokens of some documents, as ``tokens`` gives them, and the distinct words with each token's place among them."""
    number: int
    ids: list
    held: np.ndarray
    token: np.ndarray
    before: np.ndarray
    first: np.ndarray
    words: np.ndarray
    places: np.ndarray


def _slices(table: pa.RecordBatch | pa.Table) -> Iterator[Slice]:
    """The slices of rows of ``tokenized``."""
    for batch in table.to_batches() if isinstance(table, pa.Table) else [table]:
        for i in range(batch.num_rows):
            words = np.frombuffer(column(batch, "words")[i].as_buffer(), np.uint64)
            first = np.concatenate([[0], np.cumsum(column(batch, "sizes")[i].values.to_numpy().astype(np.int64))])
            low, *planes = np.frombuffer(column(batch, "places")[i].as_buffer(), np.uint8).reshape(-1, first[-1])
            places = low.astype(np.uint32)
            for j, plane in enumerate(planes, 1):
                places |= plane.astype(np.uint32) << np.uint32(8 * j)
            token = words[places]
            before = np.empty_like(token)
            before[1:] = token[:-1]
            before[first[:-1]] = _START
            yield Slice(column(batch, "slice")[i].as_py(), column(batch, "ids")[i].as_py(),
                        np.array(column(batch, "held")[i].as_py(), bool), token, before, first, words, places)


def _grams(part: Slice, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(``contexts``, places, hash of each token with all words before it that the highest order looks at).

    Tokens of one such hash are one to every order, so a slice asks for each once, in the order of these hashes.
    """
    found, place = contexts(part.before, part.first, order)
    context = found[0]
    for m in range(1, order - 1):
        context = np.where(place >= m, found[m], context)
    return found, place, pair_keys(context, part.token)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of the runs of equal elements of a sorted array."""
    cuts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[cuts], np.diff(np.append(cuts, len(x)))


def _hot_contexts(docs: DataFrame, order: int, shards: int) -> list[np.ndarray]:
    """For each order from 2 on, contexts with at least a quarter shard's share of the tokens of a bounded sample of texts."""
    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).select("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, target=SLICE):
            _, before, first = tokens(column(part, "text"))
            found, place = contexts(before, first, order)
            for m, c in enumerate(found):
                word, n = np.unique(c[place >= m], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), m, np.int32)), pa.array(word.view(np.int64)), pa.array(n)],
                                                 names=["m", "word", "n"])

    counts = staged(map_arrow(sample, step, "m int, word long, n long").groupBy("m", "word").agg(F.sum("n").alias("n")), "contexts")
    total = counts.filter("m = 0").agg(F.sum("n")).first()[0] or 0
    rows = counts.filter(F.col("n") >= max(2, total / (4 * shards))).collect()  # 4 * shards rows an order at most
    remove_staged(counts)
    return [np.sort(np.array([r["word"] for r in rows if r["m"] == m], np.int64).view(np.uint64)) for m in range(order - 1)]


@dataclass
class Model:
    """The numbers that all workers need (lists go from order 2 up) and the counts that each slice asked for."""
    order: int
    shards: int
    word_shards: int
    turns: int
    hot: list[np.ndarray]
    hot_stats: list[np.ndarray]
    train_tokens: int
    vocabulary: int
    pair_types: int
    discounts: list[np.ndarray]   # of counts 0, 1, 2, 3 and more
    word_discounts: np.ndarray
    word_backoff: float
    answers: list[DataFrame]      # staged: the columns of ``_ANSWER`` (k = 1: words) and others, slice being null

    def numbers(self) -> Model:
        """The model without its tables, for workers."""
        return replace(self, answers=[])

    def _words(self, words: np.ndarray, answers: pa.Table) -> np.ndarray:
        """Occurrences and number of words before of a slice's words."""
        out = np.empty((2, len(words)), np.int64)
        out[:, by_shard(spread(words, self.word_shards))] = whole(answers["s"], answers["s_large"], 2).T
        return out

    def _contexts(self, k: int, context: np.ndarray, answers: pa.Table) -> np.ndarray:
        """Total and numbers of k-grams that count one, two or more, of distinct sorted contexts."""
        hot, stats = self.hot[k - 2], self.hot_stats[k - 2]
        common = among(context, hot)
        cold = np.flatnonzero(~common)
        shard = spread(context[cold] ^ _PAIR, self.shards)
        out = np.empty((4, len(context)), np.int64)
        out[:, cold[by_shard(shard)]] = decoded(answers["code"], answers["s"], answers["s_large"]).T
        out[:, common] = stats[:, np.searchsorted(hot, context[common])]
        return out

    def token_scores(self, part: Slice, answers: pa.Table) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, log10 probability.  ``answers``: all of the slice's."""
        answers = answers.drop_columns("slice").sort_by([("k", "ascending"), ("shard", "ascending")])
        level = answers["k"].to_numpy()
        of = {k: answers.slice(np.searchsorted(level, k), np.count_nonzero(level == k)) for k in range(1, self.order + 1)}
        count, n = self._words(part.words, of[1])
        uniform = 1 / (self.vocabulary + 1)
        log = np.full(len(part.token), np.log10(uniform))
        if self.pair_types:
            low = (n - self.word_discounts[np.minimum(n, 3)]) / self.pair_types + self.word_backoff * uniform
            found, place, full = _grams(part, self.order)
            _, one, number = distinct(full)
            p, token, place = low[part.places[one]], part.token[one], place[one]
            for k in range(2, self.order + 1):
                there, discounts = np.flatnonzero(place >= k - 2), self.discounts[k - 2]
                context = found[k - 2][one[there]]
                c = np.empty(len(there), np.int64)
                c[by_shard(shard_of(context, token[there], self.hot[k - 2], self.shards))] = whole(of[k]["c"], of[k]["c_large"])[:, 0]
                different, _, which = distinct(context)
                total, *ns = self._contexts(k, different, of[k])
                rest = sum(discounts[i] * x for i, x in zip((1, 2, 3), ns, strict=True))
                seen = np.maximum(total, 1)
                own = (c - discounts[np.minimum(c, 3)]) / seen[which]
                kept = np.where(total > 0, rest / seen, 1.0)[which]  # an unknown context leaves all to the lower order
                own[total[which] == 0] = 0
                p[there] = own + kept * p[there]
            log = np.log10(p)[number]
        base = np.log10((count + 1) / (self.train_tokens + self.vocabulary + 1))
        cut = part.first[:-1]
        return (np.diff(part.first), np.add.reduceat((count > 0)[part.places].astype(np.int64), cut),
                np.add.reduceat(base[part.places], cut), np.add.reduceat(log, cut))


def _discounts(counts: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts from the numbers of things that occur once to four times."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return np.array([0.0, *(min(max(x, 0.05), i - 0.05) for i, x in zip((1, 2, 3), d, strict=True))])


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries made inside go when each has ended."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)


_ANSWER = "slice long, k int, shard int, c binary, c_large binary, code binary, s binary, s_large binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _table(schema: str, rows: int, **columns: pa.Array) -> pa.Table:
    """A table of the named columns, nulls elsewhere."""
    kinds = {x.split()[0]: _KINDS[x.split()[1]] for x in schema.split(", ")}
    return pa.table({c: columns[c] if c in columns else pa.nulls(rows, kind) for c, kind in kinds.items()})


def _count_grams(texts: DataFrame, k: int, order: int, shards: int, word_shards: int, hot: np.ndarray, turn: int, turns: int) -> DataFrame:
    """The k-grams of every shard of one turn: the slices' answers; (to, word, s, s_large): the words of order 2 with occurrences
    and words before, for word shards; and (to, key, stats, t1 to t4): sums of hot contexts and counts of counts, to = -1."""
    top = k == order
    schema = f"{_ANSWER}, to int, word binary, key binary, stats binary, t1 long, t2 long, t3 long, t4 long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                found, place, full = _grams(part, order)
                shard = shard_of(found[k - 2], part.token, hot, shards)
                mine = np.flatnonzero((place >= k - 2) & (shard % turns == turn))
                _, one, number = distinct(full[mine])
                at = mine[one]
                by = by_shard(shard[at])
                at = at[by]
                trained = np.repeat(~part.held, np.diff(part.first))[mine]
                n = np.bincount(number[trained], minlength=len(one)).astype(np.uint32)[by]
                prior = part.before[np.maximum(at - (k - 1), 0)]
                prior[place[at] < k - 1] = 0  # opens a text
                found_at, sizes = _runs(shard[at])
                columns = [binaries(x, sizes) for x in (found[k - 2][at], part.token[at], n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found_at, pa.int32()), pa.array(np.full(len(sizes), part.number), pa.int64()), *columns,
                     binaries(prior[:0], np.zeros_like(sizes)) if top else binaries(prior, sizes)],
                    names=["shard", "slice", "context", "token", "n", "prior"])

    def grams(key: tuple, table: pa.Table) -> pa.Table:
        context, sizes = joined(table["context"], np.uint64)
        token = joined(table["token"], np.uint64)[0]
        n = joined(table["n"], np.uint32)[0].astype(np.int64)
        keys, one, at = distinct(pair_keys(context, token))
        times = np.bincount(at, n, len(keys)).astype(np.int64)
        if top:
            c = times
        else:
            prior = joined(table["prior"], np.uint64)[0]
            inner = np.flatnonzero((n > 0) & (prior != 0))
            pairs = pair_keys(keys[at[inner]], prior[inner])
            by = sorting(pairs)
            pairs = pairs[by]
            each = at[inner[by[np.concatenate([[True], pairs[1:] != pairs[:-1]])[:len(by)]]]]
            opens = prior == 0
            c = (np.bincount(each, minlength=len(keys)) + np.bincount(at[opens], n[opens], len(keys))).astype(np.int64)
        different, _, which = distinct(context[one])
        stats = np.stack([np.bincount(which, c, len(different)),
                          *(np.bincount(which[m], minlength=len(different)) for m in (c == 1, c == 2, c >= 3))]).astype(np.int64)
        common = among(different, hot)
        asks = np.repeat(np.arange(len(sizes)), sizes) * len(different) + which[at]  # each row's contexts, by hash
        asks = np.sort(asks[~common[which[at]]])
        asks = asks[np.concatenate([[True], asks[1:] != asks[:-1]])[:len(asks)]]
        row, number = np.divmod(asks, max(1, len(different)))
        c_low, c_large = small(c[at], sizes)
        code, s_low, s_large = coded(stats[:, number].T, np.bincount(row, minlength=len(sizes)))
        rows = len(sizes)
        out = [_table(schema, rows, slice=table["slice"], k=pa.array(np.full(rows, k), pa.int32()), shard=table["shard"],
                      c=c_low, c_large=c_large, code=code, s=s_low, s_large=s_large),
               _table(schema, 1, to=pa.array([-1], pa.int32()), key=pa.array([different[common].tobytes()]),
                      stats=pa.array([stats[:, common].T.tobytes()]), **{f"t{i}": pa.array([int((c == i).sum())]) for i in (1, 2, 3, 4)})]
        if k == 2:
            seen = np.flatnonzero(c)
            word, _, of = distinct(token[one[seen]])
            by = by_shard(spread(word, word_shards))
            to, sizes = _runs(spread(word, word_shards)[by])
            counts = np.stack([np.bincount(of, times[seen], len(word)), np.bincount(of, minlength=len(word))]).astype(np.int64)
            s_low, s_large = small(counts[:, by].T, sizes, 2)
            out.append(_table(schema, len(to), to=pa.array(to, pa.int32()), word=binaries(word[by], sizes), s=s_low, s_large=s_large))
        return pa.concat_tables(out)

    counted = map_arrow(texts, count, "shard int, slice long, context binary, token binary, n binary, prior binary")
    return counted.groupBy("shard").applyInArrow(grams, schema)


def _count_words(texts: DataFrame, counted: DataFrame, shards: int) -> DataFrame:
    """The answers of the word shards, and of each (tokens, vocabulary, types, u1 to u5): sums over its words."""
    schema = f"{_ANSWER}, " + ", ".join(f"{c} long" for c in _SUMS)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words in zip(column(batch, "slice").to_pylist(), column(batch, "words"), strict=True):
                words = np.frombuffer(words.as_buffer(), np.uint64)
                by = by_shard(spread(words, shards))
                shard, sizes = _runs(spread(words, shards)[by])
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(np.full(len(shard), number), pa.int64()),
                                                  binaries(words[by], sizes), *(pa.nulls(len(shard), pa.binary()) for _ in range(2))],
                                                 names=["shard", "slice", "word", "s", "s_large"])

    def count(key: tuple, table: pa.Table) -> pa.Table:
        known, asking = table.filter(pc.is_null(table["slice"])), table.filter(pc.is_valid(table["slice"]))
        given = joined(known["word"], np.uint64)[0]
        asked, sizes = joined(asking["word"], np.uint64)
        words, _, at = distinct(np.concatenate([given, asked]))
        stats = np.stack([np.bincount(at[:len(given)], x, len(words)) for x in whole(known["s"], known["s_large"], 2).T]).astype(np.int64)
        s_low, s_large = small(stats[:, at[len(given):]].T, sizes, 2)
        empty = binaries(np.zeros(0, np.uint8), np.zeros(len(sizes), np.int64))
        n = stats[1]
        sums = [stats[0].sum(), (stats[0] > 0).sum(), n.sum(), *((n == i).sum() for i in (1, 2, 3, 4)), (n >= 3).sum()]
        return pa.concat_tables([
            _table(schema, len(sizes), slice=asking["slice"], k=pa.array(np.ones(len(sizes)), pa.int32()), shard=asking["shard"],
                   c=empty, c_large=empty, code=empty, s=s_low, s_large=s_large),
            _table(schema, 1, **{c: pa.array([int(x)], pa.int64()) for c, x in zip(_SUMS, sums, strict=True)})])

    asking = map_arrow(texts.select("slice", "words"), ask, "shard int, slice long, word binary, s binary, s_large binary")
    known = counted.filter("to >= 0").select(F.col("to").alias("shard"), F.lit(None).cast("long").alias("slice"), "word", "s", "s_large")
    return asking.unionAll(known).groupBy("shard").applyInArrow(count, schema)


def _hot_stats(counted: DataFrame, hot: np.ndarray) -> np.ndarray:
    """Sums over the shards of the totals of hot contexts."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, stats = joined(column(batch, "key"), np.int64)[0], joined(column(batch, "stats"), np.int64)[0].reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(np.ascontiguousarray(x)) for x in stats.T)],
                                                 names=["key", "s0", "s1", "s2", "s3"])

    out = np.zeros((4, len(hot)), np.int64)
    sums = map_arrow(counted.filter("to = -1").select("key", "stats"), step, "key long, s0 long, s1 long, s2 long, s3 long")
    for r in sums.groupBy("key").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(4))).collect():
        out[:, np.searchsorted(hot, np.array([r["key"]], np.int64).view(np.uint64))[0]] = [r[f"s{i}"] for i in range(4)]
    return out


def train(docs: DataFrame, order: int = ORDER, written: DataFrame | None = None) -> Model:
    """Count the texts outside the held-out fold, and what all texts ask of the counts.

    docs: doc_id, text; ``written``: their tokens, if they were written before.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    training = docs.filter(~held_out()).select("doc_id", "text")
    size = training.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    shards = max(MIN_SHARDS, -(-size // SHARD_BYTES))
    word_shards = max(MIN_SHARDS, -(-shards // WORD_SHARE))
    turns = min(MAX_ROUNDS, max(1, -(-size // ROUND_BYTES)))
    hot = _hot_contexts(training, order, shards)
    written = tokenized(docs) if written is None else written
    hot_stats, discounts, answers = [], [], []
    with _shuffles_removed(spark):
        for k in range(2, order + 1):
            parts = [staged(_count_grams(written, k, order, shards, word_shards, hot[k - 2], t, turns), f"grams{k}", compression="zstd")
                     for t in range(turns)]
            counted = reduce(DataFrame.unionAll, parts)
            once = counted.filter("to = -1").agg(*(F.coalesce(F.sum(f"t{i}"), F.lit(0)) for i in (1, 2, 3, 4))).first()
            discounts.append(_discounts([int(x) for x in once]))
            hot_stats.append(_hot_stats(counted, hot[k - 2]))
            if k == 2:
                words = staged(_count_words(written, counted, word_shards), "words", compression="zstd")
                sums = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS)).first().asDict()
                answers.append(words)
            answers += parts
    word_discounts = _discounts([sums[f"u{i}"] for i in (1, 2, 3, 4)])
    backoff = (word_discounts[1] * sums["u1"] + word_discounts[2] * sums["u2"] + word_discounts[3] * sums["u5"]) / max(1, sums["types"])
    return Model(order, shards, word_shards, turns, hot, hot_stats, sums["tokens"], sums["vocabulary"], sums["types"], discounts,
                 word_discounts, float(backoff), answers)


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    written = tokenized(docs)
    model = train(docs, order, written)
    numbers = model.numbers()

    def step(key: tuple, found: pa.Table, answers: pa.Table) -> pa.Table:
        part, = _slices(found)
        n, known, base, score = numbers.token_scores(part, answers)
        return pa.table(
            [pa.array(part.ids, pa.int64()), pa.array(part.held), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
             pa.array(np.full(len(n), numbers.train_tokens), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    columns = [x.split()[0] for x in _ANSWER.split(", ")]
    answers = reduce(DataFrame.unionAll, [x.filter("slice is not null").select(*columns) for x in model.answers])
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = []
    with _shuffles_removed(docs.sparkSession):
        for t in range(model.turns):
            mine = F.pmod(F.xxhash64("slice"), F.lit(model.turns)) == t
            met = written.filter(mine).groupBy("slice").cogroup(answers.filter(mine).groupBy("slice"))
            scored.append(staged(met.applyInArrow(step, schema), "scores"))
    remove_staged(written, *model.answers)
    return reduce(DataFrame.unionAll, scored)
