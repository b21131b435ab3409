"""Near-duplicate groups of documents: SuperMinHash signatures, banding, verification, union-find grouping.

1. ``signatures``: a document's set of word shingles, its identity (a 128-bit
   hash) and a SuperMinHash signature.  Each shingle ranks all ``M`` places by
   a permutation of its own (affine modulo the prime M); a place keeps the
   smallest rank-plus-fraction that any shingle gives it.  Ranks are handed
   out in rising order, so a set is done as soon as every place holds less
   than the next rank.  ``BANDS`` bands of ``ROWS`` places follow: sets at
   similarity 0.8 share none with probability 2e-6, at 0.85 with 7e-9.
2. Equal sets are one class from here on (copies never meet each other).
3. Within each band bucket all sets are compared with its most central
   member (the one whose buckets are largest), on full sets.  Where a bucket
   then still holds sets of different groups, its members are compared exactly, in
   blocks of bounded size, and each block pair only emits a spanning forest.
   Buckets with the same members are compared once.
4. Confirmed links are grouped by rounds of local union-find and star
   contraction; a group's name is its smallest document.

No pairs of copies are ever made, and no candidate is dropped.
Cases: empty and null texts have no shingles and link with nothing; a text
below a shingle's words is one shingle; equal rows are copies, and rows with one
id are one document; null ids count as smaller than any other id; an empty table gives no rows.  Other
columns are not read by ``groups``, and passed through by ``keep_first``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, ship_package, slices, staged
from ticklake.llm.components import connected_components
from ticklake.llm.words import Runs, Words, mix

M, BANDS, ROWS = 163, 32, 5
BLOCK = 512
FRACTION_BITS = 40
_PLACES = np.arange(M, dtype=np.int64)
_INVERSE = np.array([0, *(pow(a, -1, M) for a in range(1, M))], dtype=np.int64)
NULL_ID = -(2**63)


def super_minhash(shingles: np.ndarray) -> np.ndarray:
    """Signature (M int64) of a non-empty array of distinct 64-bit hashes."""
    h = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    step = (h % np.uint64(M - 1)).astype(np.int64) + 1
    origin = ((h >> np.uint64(20)) % np.uint64(M)).astype(np.int64)
    out = np.full(M, np.iinfo(np.int64).max)
    n, rank = len(h), 0
    while rank < M and out.max() >= rank << FRACTION_BITS:
        # as many ranks at once as should fill the places that are still open
        take = min(M - rank, max(1, (5 if rank else 1) * M // n), max(1, (1 << 17) // n))
        ranks = np.arange(rank, rank + take, dtype=np.int64)[:, None]
        places = (origin + step * ranks) % M
        fraction = mix(h[None, :] + ranks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FRACTION_BITS)
        np.minimum.at(out, places.ravel(), ((ranks << FRACTION_BITS) + fraction.astype(np.int64)).ravel())
        rank += take
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; keys of different bands differ."""
    rows = signature[:BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        key = mix(key ^ rows[:, i]) + np.uint64(i)
    return key.view(np.int64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct word shingles (A-Z lower-cased)."""
    words = Words(texts)
    runs = Runs(words.hashes(lower=True))
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if a == b:
            out.append(np.zeros(0, np.uint64))
        elif b - a < size:
            out.append(runs.run(np.array([a]), b - a))
        else:
            out.append(np.unique(runs.run(np.arange(a, b - size + 1), size)))
    return out


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc, n_shingles, set_id binary, bands): set_id and bands are null where there are no shingles."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, ids, bands = [], [], []
            for s in shingle_sets(column(part, "text"), size):
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(super_minhash(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc", "n_shingles", "set_id", "bands"])

    return map_arrow(docs, step, "doc long, n_shingles long, set_id binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, shingles binary) of the documents in ``wanted`` (rep)."""
    texts = docs.join(wanted, F.col("doc") == F.col("rep")).select("rep", "text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [column(part, "rep"), pa.array([s.tobytes() for s in shingle_sets(column(part, "text"), size)], pa.binary())],
                names=["rep", "shingles"])

    return map_arrow(texts, step, "rep long, shingles binary")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    same = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * same >= percent * (len(a) + len(b) - same)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have similarity percent / 100 or more."""
    left = sets.select(F.col("rep").alias("_a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("_b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, F.col("b") == F.col("_b")).join(left, F.col("a") == F.col("_a")).select("a", "b", "sa", "sb")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(column(batch, "sa"), column(batch, "sb"), strict=True)]
            part = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield part

    return map_arrow(both, step, "a long, b long")


def block_forest(reps: np.ndarray, groups: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the sets of one block pair that join different groups.

    ``sides``: 1 and 2 for the two blocks (only pairs across are compared), 0
    within one block.  Overlaps are counted through an index of shingles.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    _, label = np.unique(groups, return_inverse=True)
    main = np.bincount(label).argmax() if len(label) else 0
    out = []
    for i in np.flatnonzero(label != main):  # what lies outside the largest group meets all others
        ask = (label != label[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        if sides[i]:
            ask &= sides != sides[i]
        if not ask.any():
            continue
        lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        same = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero(ask & (100 * same >= percent * (sizes + sizes[i] - same))):
            if label[j] != label[i]:
                out.append((int(reps[i]), int(reps[j])))
                label[label == label[i]] = label[j]
    return out


def _residual_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that comparing with the central members left open.

    members: (key, rep) of buckets of three sets or more.
    """
    named = members.join(labels.select(F.col("node").alias("_n"), "group"), F.col("rep") == F.col("_n"), "left").select(
        "key", "rep", F.coalesce("group", "rep").alias("group"))
    named = staged(named, "members")
    # buckets with equal members (two sums of hashes) need one comparison
    kinds = (named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("g0"), F.max("group").alias("g1"),
                                      F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("h1"),
                                      F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(20,0)")).alias("h2"))
             .filter("g0 != g1").groupBy("n", "h1", "h2").agg(F.min("key").alias("_key")))
    kinds = staged(kinds.select("_key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open-buckets")
    # block b of a bucket of B blocks takes part in the pairs (min, max) of b with each block
    placed = (named.join(kinds, F.col("key") == F.col("_key"))
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "rep", "group", F.least("block", "other").alias("b0"), F.greatest("block", "other").alias("b1"),
                      F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")))
    full = placed.join(sets.select(F.col("rep").alias("_rep"), "shingles"), F.col("rep") == F.col("_rep")).drop("_rep")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        links = block_forest(table.column("rep").to_numpy(), table.column("group").to_numpy(), table.column("side").to_numpy(), sets_, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    ship_package(full.sparkSession)
    return full.groupBy("key", "b0", "b1").applyInArrow(compare, "a long, b long")


def groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document: shingles of ``size`` words, similarity percent / 100 or more."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.col("text").cast("string").alias("text"))
    base = staged(signatures(docs, size), "signatures")
    classes = staged(base.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands")), "classes")

    rows = classes.select("rep", F.explode("bands").alias("key"))
    buckets = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumnRenamed("key", "_key"), "buckets")
    shared = staged(rows.join(buckets, F.col("key") == F.col("_key")).select("key", "rep", "n"), "shared")
    centrality = shared.groupBy("rep").agg(F.sum("n").alias("central")).withColumnRenamed("rep", "_rep")
    ranked = staged(shared.join(centrality, F.col("rep") == F.col("_rep")).select("key", "rep", "n", "central"), "ranked")
    centres = staged(ranked.groupBy("key").agg(F.min(F.struct(-F.col("central"), "rep")).getField("rep").alias("centre"))
                     .withColumnRenamed("key", "_key"), "centres")
    pairs = (ranked.join(centres, F.col("key") == F.col("_key")).filter("rep != centre")
             .select(F.col("rep").alias("a"), F.col("centre").alias("b")).dropDuplicates())
    sets = staged(full_sets(docs, centrality.select(F.col("_rep").alias("rep")), size), "sets")
    stars = staged(confirmed(staged(pairs, "pairs"), sets, percent), "stars")
    labels = connected_components(stars)
    more = staged(_residual_links(ranked.filter("n > 2").select("key", "rep"), labels, sets, percent), "more-links")
    if not more.isEmpty():
        labels = connected_components(stars.unionByName(more))

    names = staged(classes.select("set_id", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("set_id").alias("_set"), F.coalesce("group", "rep").alias("_group")), "names")
    out = base.select("doc", "n_shingles", "set_id").join(names, F.col("set_id") == F.col("_set"), "left")
    component = F.coalesce("_group", "doc")
    return out.select(F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), "n_shingles",
                      F.nullif(component, F.lit(NULL_ID)).alias("component_id"), (F.col("doc") == component).alias("kept"))


def keep_first(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``docs`` with one row of each group: one of those with the smallest id.

    Rows are grouped by a number of their own, so rows that share an id, or
    have none (these come before all others), are told apart."""
    rows = staged(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "numbered")
    found = groups(rows.select(F.col("__llm_row").alias("doc_id"), "text"), size, percent)
    ids = rows.select(F.col("__llm_row").alias("doc_id"), F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNotNull().alias("named"), "id", "doc_id")).getField("doc_id")
    kept = found.join(ids, "doc_id").groupBy("component_id").agg(first.alias("__llm_row")).select("__llm_row")
    return rows.join(kept, "__llm_row", "left_semi").drop("__llm_row")
