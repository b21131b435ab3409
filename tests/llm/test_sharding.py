"""Shards: every row once, near-equal bytes, gapless slots; cuts against a sort on the driver."""

import random
import zlib

from ticklake.llm import sharding
from ticklake.llm.common import staged


def _docs(spark, n=3000, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["x" * rng.randint(0, 400), "hot text", None]), rng.choice(["a", "b", None]),
             "hot" if rng.random() < 0.5 else f"s{rng.randrange(9)}") for i in range(n)]
    return rows, spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, lang string, source string, shard int, size string")


def test_shards(spark):
    rows, df = _docs(spark)
    out = sharding.shard_documents(df, 16).collect()
    assert sorted(r.doc_id for r in out) == [r[0] for r in rows]
    text = {r[0]: r[1] or "" for r in rows}
    for r in out:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id].encode()))
        assert (r.law, r.grown_shard) == ("bytes", None)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(16))
    mean = sum(r.size for r in out) / 16
    assert all(abs(sum(r.size for r in part) - mean) <= 4 * 401 for part in by.values())
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())


def test_one_cut_equals_a_sort(spark):
    _, df = _docs(spark, 500, 9)
    meta = staged(sharding.metadata(df), "t")
    rows = sorted(meta.collect(), key=lambda r: r._size)
    total, run = sum(r.size for r in rows), 0
    cut = sharding._cuts(meta.selectExpr("*", "0 as _node"), {0: "size"}, {0: total / 2})[0]
    left = [r for r in rows if r._size < cut]
    best = min(abs(sum(r.size for r in rows[:k]) - total / 2) for k in range(len(rows)))
    assert abs(sum(r.size for r in left) - total / 2) == best
    assert run == 0


def test_target_bytes_and_odd_counts(spark):
    _, df = _docs(spark, 1000, 4)
    meta = staged(sharding.metadata(df), "t")
    total = meta.agg({"size": "sum"}).first()[0]
    sums = [r[1] for r in sharding.kd_shards(meta, target_bytes=total // 6).groupBy("shard").sum("size").collect()]
    assert len(sums) == 7 and max(sums) < 1.15 * total / 7


def test_repeated_rows_few_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", None, None)] * 3 + [(None, None, None, None)], "doc_id long, text string, lang string, source string")
    out = sharding.shard_documents(df, 16).collect()
    assert len(out) == 4
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.shard_documents(df.limit(0), 16).count() == 0


def test_whole_tree_equals_a_plain_tree(spark):
    """Every leaf of 13 against recursive cuts of sorted lists."""
    _, df = _docs(spark, 700, 21)
    meta = staged(sharding.metadata(df), "t")
    rows = meta.collect()
    code = lambda r, d: r[f"_{d}"] >> sharding.TIE_BITS
    whole = {d: max(1, max(code(r, d) for r in rows) - min(code(r, d) for r in rows)) for d in sharding.DIMENSIONS}

    def tree(part, first, n):
        if n == 1 or not part:
            return {r.doc_id: first for r in part}
        d = max(sharding.DIMENSIONS, key=lambda d: (max(code(r, d) for r in part) - min(code(r, d) for r in part)) / whole[d])
        part = sorted(part, key=lambda r: r[f"_{d}"])
        share = sum(r.size for r in part) * (n // 2) / n
        run, k = 0, 0
        while run + part[k].size < share:
            run, k = run + part[k].size, k + 1
        k += run + part[k].size - share <= share - run
        return tree(part[:k], first, n // 2) | tree(part[k:], first + n // 2, n - n // 2)

    got = {r.doc_id: r.shard for r in sharding.kd_shards(meta, shards=13).collect()}
    assert got == tree(rows, 0, 13)
