"""Packing: the reduction against an exact solver, whole plans against simple checks, pieces against the tokenizer."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ticklake.llm import packing
from ticklake.llm.common import staged

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def fewest(items, capacity):
    """Exact number of sequences, by depth-first search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def counted(items):
    return {k: len(list(g)) for k, g in itertools.groupby(sorted(items))}


@pytest.mark.parametrize("seed", range(150))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 17, 30])
    low = rng.choice([1, capacity // 5 + 1])
    items = [rng.randint(low, capacity) for _ in range(rng.randint(1, 9))]
    fixed, left = packing.reduce_by_dominance(counted(items), capacity)
    used = [n for pattern, often in fixed for _ in range(often) for n, c in pattern for _ in range(c)]
    rest = [k for k, n in left.items() for _ in range(n)]
    assert sorted(used + rest) == sorted(items)
    assert all(sum(n * c for n, c in pattern) <= capacity for pattern, _ in fixed)
    assert sum(often for _, often in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_plan_places_each_rank_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.randint(1, 60) for _ in range(30)}
    where = packing.plan(counts, 100)
    fill = {}
    for length, n in counts.items():
        at = np.flatnonzero(where["length"] == length)
        for rank in range(n):
            k = at[np.searchsorted(where["rank"][at], rank, "right") - 1]
            i = rank - where["rank"][k]
            seq = int(where["base"][k] + i // where["copies"][k])
            off = int(where["offset"][k] + i % where["copies"][k] * length)
            fill.setdefault(seq, []).append((off, length))
    for parts in fill.values():
        end = 0
        for off, length in sorted(parts):
            assert off == end
            end += length
        assert end <= 100
    rooms = []  # first-fit decreasing
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            i = next((i for i, r in enumerate(rooms) if r >= length), None)
            if i is None:
                rooms.append(100 - length)
            else:
                rooms[i] -= length
    assert len(fill) <= 1.01 * len(rooms) + 1


def test_large_counts_need_no_loop_over_rows():
    where = packing.plan({1: 10**9, 1365: 10**9, 4096: 10**9, 2048: 10**9 + 1, 3000: 10**8})
    assert len(where["length"]) < 100


def _check(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = {}
    for d, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[d, k] = (s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for off, length in sorted(parts):
            assert off == end
            end += length
        assert end <= capacity


def test_documents_are_packed_whole(spark):
    docs = [(0, "the quick brown fox " * 60), (1, None), (2, ""), (3, "Été <|endoftext|> x 12"), (4, "don't stop"),
            (5, "don't stop"), (6, " \n\t "), (7, "a" * 3000)]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], "doc_id long, text string, length string, piece int")
    _check(packing.pack_documents(df, WORD_BPE, 50).collect(), docs, 50)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same text")] * 5 + [(None, None)], "doc_id long, text string")
    rows = packing.pack_documents(df, WORD_BPE, 8).collect()
    assert len(rows) == 6 and len({(r.sequence_id, r.offset) for r in rows}) == 6
    assert packing.pack_documents(df.limit(0), WORD_BPE).count() == 0


def test_pack_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 0, 5, "x"), (2, 0, 5, None)], "doc_id long, piece int, length long, base string")
    rows = packing.pack(staged(df, "t"), 10).orderBy("doc_id").collect()
    assert [r.base for r in rows] == ["x", None] and len({r.sequence_id for r in rows}) == 1
