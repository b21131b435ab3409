"""Substring dedup: a De Bruijn graph of token k-mers, compacted where it does not branch.

Edges are runs of ``K`` words; of the ``WINDOW - K + 1`` k-mers in every
window of ``WINDOW`` words the one with the smallest hash (the leftmost of
equal ones) is taken, so equal windows take the same edge at the same place and
the graph holds about an eighth of all k-mers while each window keeps one.

1. ``edges``: one row per taken k-mer of each document with its source
   coordinate: the first window that took it, how many in a row did, a hash of
   the whole path around it (all words of these windows) and the next k-mer
   that the document takes.
2. ``repeated``: a join keeps the edges that more than one document holds.
   Where all occurrences lie in the same path the edge does not branch.
3. ``chains``: an unbranched edge links to another where every occurrence of
   either lies beside the other. Linked edges are compacted into maximal paths by
   joins that double each edge's distance to its predecessor, so a passage is
   one row of each document that holds it, whatever its length.
4. ``verified``: the words of every path are read at its source coordinate in
   every document; 128 bits of BLAKE2b over them say which are equal. A path
   with equal words everywhere belongs to the document with the smallest id.
5. Where an edge branches, or one path's words differ (colliding hashes), each
   distinct path is read once at its first document's coordinate and its
   single windows are compared by digests of their words; a window belongs to
   the smallest document that starts it.
6. Paths of one document that overlap or touch are joined into spans.

The 64-bit hashes of steps 1 to 3 only propose: two texts whose hashes collide
meet in one group, and the digests of their words set them apart.
Cases: a null or empty text has no words; a document below ``WINDOW`` words
loses nothing; rows with one id count as one document, so equal rows do not
remove each other's words;
a null doc_id counts as smaller than any other; an empty table gives no rows.
Input columns besides doc_id and text are passed through by
``remove_repeats`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, remove_staged, ship_package, slices, staged
from ticklake.llm.words import Runs, Words

WINDOW, K = 50, 20
NULL_ID = -(2**63)


def _argmin(x: np.ndarray, n: int) -> np.ndarray:
    """For each start s the index of the smallest of x[s : s + n], the leftmost of equal ones."""
    at, width = np.arange(len(x)), 1
    while width < n:
        step = min(width, n - width)
        a, b = at[:-step], at[step:]
        at = np.where(x[b] < x[a], b, a)
        width += step
    return at


def taken_edges(words: Words, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, k-mer hash, path hash, first window, windows) of every taken edge; places are word indices of the batch."""
    hashes = words.hashes()
    runs = Runs(hashes)
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none, none, none
    kmers = runs.run(np.arange(len(hashes) - k + 1), k)
    at = _argmin(kmers, window - k + 1)[:len(hashes) - window + 1]
    text = words.text_of()
    start = np.arange(len(at))
    inside = text[start] == text[start + window - 1]
    at, start = at[inside], start[inside]
    if not len(at):
        return none, none, none, none, none
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
    n = np.diff(np.append(first, len(at)))
    begin, edge = start[first], at[first]
    path = runs.run(begin, n + window - 1)  # where in it the edge lies follows from its words
    return text[begin], kmers[edge].view(np.int64), path.view(np.int64), begin, n


def edges(docs: DataFrame, window: int = WINDOW, k: int = K, bits: int = 64) -> DataFrame:
    """(doc, kmer, path, next, at, n): taken edges of every text; ``at`` counts the document's words from 0.

    ``next`` is the k-mer that the document takes next, null at its end.
    ``bits``: how much of the hashes is kept.
    """
    shift = np.int64(64 - bits)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(column(part, "text"))
            ids = column(part, "doc").to_numpy(zero_copy_only=False)
            text, kmer, path, begin, n = taken_edges(words, window, k)
            kmer, path = kmer >> shift, path >> shift
            last = np.append(text[1:] != text[:-1], True)[:len(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[text]), pa.array(kmer), pa.array(path), pa.array(np.append(kmer[1:], 0)[:len(kmer)], mask=last),
                 pa.array((begin - words.first[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["doc", "kmer", "path", "next", "at", "n"])

    return map_arrow(docs, step, "doc long, kmer long, path long, next long, at int, n int")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.col("text").cast("string").alias("text"))


def chains(unbranched: DataFrame) -> DataFrame:
    """(head, total): maximal paths of linked edges, each named by its first k-mer, with the windows of all its edges.

    An edge links to its next one where all its occurrences agree on it and
    both occur equally often, so neither occurs without the other. No cycle
    can arise, since a document's last edge has no next one.
    """
    units = staged(unbranched.groupBy("kmer").agg(F.count(F.lit(1)).alias("rows"), F.count("next").alias("nexts"), F.min("next").alias("next"),
                                                  F.max("next").alias("other"), F.min("n").alias("n")), "units")
    before = units.filter("nexts = rows and next = other").select(F.col("kmer").alias("at"), F.col("next").alias("_next"), F.col("rows").alias("_rows"), F.col("n").alias("far"))
    # an edge's earlier edge and the windows from that one to it
    back = staged(units.join(before, (F.col("kmer") == F.col("_next")) & (F.col("rows") == F.col("_rows"))).select("kmer", "n", "at", "far"), "back")
    while True:
        earlier = back.select(F.col("kmer").alias("_kmer"), F.col("at").alias("_at"), F.col("far").alias("_far"))
        longer = staged(back.join(earlier, F.col("at") == F.col("_kmer"), "left").select(
            "kmer", "n", F.coalesce("_at", "at").alias("at"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far"),
            F.col("_at").isNotNull().alias("moved")), "back")
        moved = not longer.filter("moved").isEmpty()
        remove_staged(back)
        back = longer.drop("moved")
        back._staged_at = longer._staged_at
        if not moved:
            break
    ends = back.groupBy("at").agg(F.max(F.col("far") + F.col("n")).alias("total"))
    linked = back.select(F.col("kmer").alias("_kmer"))
    heads = units.join(linked, F.col("kmer") == F.col("_kmer"), "left_anti").join(ends, F.col("kmer") == F.col("at"), "left")
    return heads.select(F.col("kmer").alias("head"), F.coalesce("total", F.col("n")).cast("int").alias("total"))


def _joined_words(words: Words) -> tuple[memoryview, np.ndarray]:
    """All words of a batch, each followed by one space, and the place where each begins (one more at the end)."""
    size = words.end - words.start
    place = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(place[-1], 0x20, np.uint8)
    # the k-th byte of a word goes to the k-th place after the word's own
    into = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    source = np.arange(size.sum()) + np.repeat(words.start - (np.cumsum(size) - size), size)
    out[into] = words.data[source]
    return memoryview(out), place


def _word_digests(text: memoryview, place: np.ndarray, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of BLAKE2b over each run of ``n`` words from word ``begin`` on."""
    a, b = place[begin].tolist(), place[begin + n].tolist()
    raw = b"".join(hashlib.blake2b(text[x:y], digest_size=16).digest() for x, y in zip(a, b, strict=True))
    both = np.frombuffer(raw, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _with_lists(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc, text, wanted) of the documents that ``rows`` (with a column doc) name."""
    fields = [c for c in rows.columns if c != "doc"]
    wanted = rows.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("wanted")).withColumnRenamed("doc", "_doc")
    return docs.join(wanted, F.col("doc") == F.col("_doc")).select("doc", "text", "wanted")


def _wanted(part: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(row of the batch, fields) of every entry of the lists in ``wanted``."""
    lists = column(part, "wanted")
    items = lists.flatten()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return row, {f.name: items.field(f.name).to_numpy(zero_copy_only=False) for f in items.type}


def verified_paths(docs: DataFrame, occurrences: DataFrame, window: int, bits: int = 64) -> DataFrame:
    """(doc, grp, branches, at, total, d1, d2): occurrences of paths with the digest of the words that really lie there."""
    shift = np.int64(64 - bits)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(column(part, "text"))
            runs = Runs(words.hashes())
            row, x = _wanted(part)
            # where rows share an id but not their text, a coordinate may be another row's
            good = x["at"] + x["total"] + window - 1 <= words.counts[row]
            row, x = row[good], {c: v[good] for c, v in x.items()}
            begin = words.first[row] + x["at"]
            same = runs.run(begin, x["n"] + window - 1).view(np.int64) >> shift == x["path"]
            row, begin, x = row[same], begin[same], {c: v[same] for c, v in x.items()}
            d1, d2 = _word_digests(*_joined_words(words), begin, x["total"] + window - 1)
            ids = column(part, "doc").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), *(pa.array(x[c]) for c in ("grp", "branches", "at", "total")), pa.array(d1), pa.array(d2)],
                schema=out_schema)

    out_schema = pa.schema([("doc", pa.int64()), ("grp", pa.int64()), ("branches", pa.bool_()), ("at", pa.int32()),
                            ("total", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])
    return map_arrow(_with_lists(docs, occurrences), step, "doc long, grp long, branches boolean, at int, total int, d1 long, d2 long")


def _single_windows(docs: DataFrame, source: DataFrame, window: int) -> DataFrame:
    """Read each distinct path once: (grp, d1, d2, i, digest w1 and w2 of its i-th window, smallest document of the path)."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(column(part, "text"))
            text, place = _joined_words(words)
            row, x = _wanted(part)
            good = x["at"] + x["total"] + window - 1 <= words.counts[row]
            row, x = row[good], {c: v[good] for c, v in x.items()}
            begin = words.first[row] + x["at"]
            d1, d2 = _word_digests(text, place, begin, x["total"] + window - 1)
            same = (d1 == x["d1"]) & (d2 == x["d2"])
            row, begin, x = row[same], begin[same], {c: v[same] for c, v in x.items()}
            n = x["total"]
            i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w1, w2 = _word_digests(text, place, np.repeat(begin, n) + i, np.full(len(i), window))
            ids = column(part, "doc").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(x[c], n)) for c in ("grp", "d1", "d2")), pa.array(i.astype(np.int32)),
                 pa.array(w1), pa.array(w2), pa.array(np.repeat(ids[row], n))],
                names=["grp", "d1", "d2", "i", "w1", "w2", "doc"])

    return map_arrow(_with_lists(docs, source), step, "grp long, d1 long, d2 long, i int, w1 long, w2 long, doc long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K, bits: int = 64) -> DataFrame:
    """(doc, spans): for each document the [start, end) word ranges that windows of smaller documents cover, in order."""
    docs = _plain(docs)
    taken = staged(edges(docs, window, k, bits), "edges")
    shared = staged(
        taken.groupBy("kmer").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("path").alias("p0"), F.max("path").alias("p1"),
                                  F.min("n").alias("n0"), F.max("n").alias("n1"))
        .filter("lo < hi").select(F.col("kmer").alias("_kmer"), F.expr("p0 != p1 or n0 != n1").alias("branches")), "repeated")
    repeated = staged(taken.join(shared, F.col("kmer") == F.col("_kmer")).drop("_kmer"), "occurrences")
    remove_staged(taken)

    unbranched = repeated.filter("not branches")
    paths = unbranched.join(chains(unbranched), F.col("kmer") == F.col("head"))
    fields = ["doc", F.col("kmer").alias("grp"), "branches", "path", "at", "n"]
    occurrences = paths.select(*fields, "total").unionByName(repeated.filter("branches").select(*fields, F.col("n").alias("total")))
    verified = staged(verified_paths(docs, occurrences, window, bits), "verified")
    remove_staged(repeated)
    groups = staged(verified.groupBy("grp", "branches").agg(F.min("doc").alias("lo"), *(f(c).alias(f"{c}_{name}") for c in ("d1", "d2") for name, f in (("a", F.min), ("b", F.max))))
                    .select(F.col("grp").alias("_grp"), "lo", F.expr("branches or d1_a != d1_b or d2_a != d2_b").alias("differs"), F.col("branches").alias("_branches")), "groups")
    judged = staged(verified.join(groups, (F.col("grp") == F.col("_grp")) & (F.col("branches") == F.col("_branches"))), "judged")

    end = F.col("at") + F.col("total") + window - 1
    whole = judged.filter("not differs and doc > lo").select("doc", "at", end.alias("end"))

    differing = judged.filter("differs")
    source = differing.groupBy("grp", "d1", "d2").agg(F.min(F.struct("doc", "at", "total")).alias("s")).select("grp", "d1", "d2", "s.*")
    singles = staged(_single_windows(docs, source, window), "windows")
    # the smallest document that starts each window; a window of one path alone may still lie in other documents
    owner = staged(singles.groupBy("w1", "w2").agg(F.min("doc").alias("owner")).withColumnsRenamed({"w1": "_w1", "w2": "_w2"}), "owners")
    limits = staged(singles.join(owner, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")))
                    .groupBy("grp", "d1", "d2").agg(F.array_sort(F.collect_set(F.struct("i", "owner"))).alias("owners"))
                    .select(F.col("grp").alias("_g"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "owners"), "limits")
    single = (differing.join(limits, (F.col("grp") == F.col("_g")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")))
              .select("doc", "at", F.explode(F.expr("filter(owners, o -> o.owner < doc)")).alias("o"))
              .select("doc", (F.col("at") + F.col("o.i")).alias("at"), (F.col("at") + F.col("o.i") + window).alias("end")))
    pieces = whole.unionByName(single)
    joined = pieces.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("at", "end"))).alias("pieces"))
    merge = F.expr("""aggregate(pieces, CAST(array() AS ARRAY<STRUCT<at: INT, end: INT>>), (a, x) ->
        CASE WHEN size(a) = 0 OR x.at > element_at(a, -1).end THEN array_append(a, x)
             WHEN x.end <= element_at(a, -1).end THEN a
             ELSE array_append(slice(a, 1, size(a) - 1), named_struct('at', element_at(a, -1).at, 'end', x.end)) END)""")
    return joined.select("doc", merge.alias("spans"))


def _with_spans(docs: DataFrame, window: int, k: int, bits: int = 64) -> DataFrame:
    spans = repeated_spans(docs, window, k, bits).withColumnRenamed("doc", "__llm_doc").withColumnRenamed("spans", "__llm_spans")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.join(spans, key == F.col("__llm_doc"), "left").drop("__llm_doc")


def _kept(words: Words, row: int, spans: list[tuple[int, int]]) -> list[bytes]:
    """The words of text ``row`` outside its spans."""
    first, last = int(words.first[row]), int(words.first[row + 1])
    start, end = words.start[first:last], words.end[first:last]
    if not len(start):
        return []
    data = words.data
    if spans:
        keep = np.ones(last - first, bool)
        for a, b in spans:
            keep[a:b] = False
        start, end = start[keep], end[keep]
    raw = data[words.start[first]:words.end[last - 1]].tobytes()
    base = int(words.start[first])
    if not spans:
        return raw.split()
    return [raw[a - base:b - base] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def _span_lists(lists: pa.Array) -> list[list[tuple[int, int]]]:
    return [[(s["at"], s["end"]) for s in x] if x else [] for x in lists.to_pylist()]


def digests(docs: DataFrame, window: int = WINDOW, k: int = K, bits: int = 64) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(column(part, "text"))
            counts = words.counts
            removed, sha = [], []
            for row, spans in enumerate(_span_lists(column(part, "__llm_spans"))):
                kept = _kept(words, row, spans)
                removed.append(int(counts[row]) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = _with_spans(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), window, k, bits)
    return map_arrow(joined, step, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts.

    A text that loses words keeps the others joined by one space; all other
    texts stay as they are.
    """
    ship_package(docs.sparkSession)
    schema = docs.schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(column(part, "text"))
            text = column(part, "text").to_pylist()
            for row, spans in enumerate(_span_lists(column(part, "__llm_spans"))):
                if spans:
                    text[row] = b" ".join(_kept(words, row, spans)).decode("utf-8")
            names = [n for n in part.schema.names if n != "__llm_spans"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(text, pa.string()) if n == "text" else column(part, n) for n in names], names=names)

    return map_arrow(_with_spans(docs, window, k), step, schema)
