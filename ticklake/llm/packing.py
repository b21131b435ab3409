"""Packing token pieces into sequences: dominance reduction, then best fit.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
driver.  There the Martello-Toth reduction fixes small sets that provably
dominate every other set holding a given piece, and the rest is placed by
best-fit decreasing, both on whole classes of equal lengths, so the plan is a
bounded table whatever the corpus' size.  Pieces then find their place from
their rank among the pieces of equal length.

Cases: a null or empty text is one piece that holds the end id alone; a text
longer than a sequence is cut into full sequences and a rest; equal rows and
equal lengths are told apart by their rank; an empty table gives no rows.
Further columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, number_rows, slices, staged
from ticklake.llm.encoding import encoder

CAPACITY = 4096
END_ID = 1


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Encode whole texts, append ``end_id`` and cut what is longer than ``capacity``.

    One row per piece: doc_id, piece, start (ids before it), length, ids_crc32.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for part in slices(batches):
            ids, off = enc.encode(column(part, "text"))
            doc, piece, start, length, crc = [], [], [], [], []
            end = np.array([end_id], np.uint32).tobytes()
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            for d, a, b in zip(column(part, "doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                n = b - a + 1
                for k, s in enumerate(range(0, n, capacity)):
                    size = min(capacity, n - s)
                    last = s + size == n
                    c = zlib.crc32(raw[4 * (a + s):4 * (a + s + size - last)])
                    doc.append(d)
                    piece.append(k)
                    start.append(s)
                    length.append(size)
                    crc.append(zlib.crc32(end, c) if last else c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step,
                     "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Classes:
    """Counts of pieces by length, with the lengths in use kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.lengths = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))

    def smallest(self, k: int, without: int) -> list[int]:
        """The k smallest lengths of the pieces besides one piece of length ``without``."""
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(k - len(out), self.n[length] - (length == without))
            if len(out) == k:
                break
        return out

    def partner(self, room: int, without: int) -> int | None:
        """The longest other piece of at most ``room``."""
        i = bisect.bisect_right(self.lengths, room)
        while i:
            i -= 1
            length = self.lengths[i]
            if self.n[length] > (length == without):
                return length
        return None

    def best_pair(self, room: int, without: int) -> int:
        """The largest sum of two other pieces within ``room`` (0: none)."""
        best, hi = 0, len(self.lengths) - 1
        for lo, a in enumerate(self.lengths):
            while hi >= lo and a + self.lengths[hi] > room:
                hi -= 1
            if hi < lo:
                break
            j = hi
            while j >= lo:
                b = self.lengths[j]
                need = {a: 1 + (a == b), b: 1 + (a == b)}
                if all(self.n[x] - (x == without) >= k for x, k in need.items()):
                    best = max(best, a + b)
                    break
                j -= 1
        return best


Pattern = tuple[list[tuple[int, int]], int]  # [(length, copies)], how often


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth reduction: sequences that some best packing has, and the counts that are left.

    Of the longest pieces on, a piece of length j with room r = capacity - j is fixed
      * alone, if no other piece fits;
      * with a piece of length r, if there is one (it may replace whatever else shares j's sequence);
      * with the longest fitting piece k, if no two others fit together, or if no three do and k is at
        least the best sum of two: what else could share the sequence fits into k's place.
    Each rule is repeated for as many equal pieces as it holds for.
    """
    left, fixed = _Classes(counts), []
    changed = True
    while changed:
        changed = False
        for j in sorted(left.lengths, reverse=True):
            while j in left.n:
                room = capacity - j
                k = left.partner(room, j)
                if k is None:
                    fixed.append(([(j, 1)], left.n[j]))
                    left.take(j, left.n[j])
                    changed = True
                    continue
                ok, low = k == room, []
                if not ok:
                    low = left.smallest(3, j)
                    ok = len(low) < 2 or low[0] + low[1] > room
                    ok = ok or ((len(low) < 3 or sum(low) > room) and k >= left.best_pair(room, j))
                if not ok:
                    break
                # without an exact fill the rule holds on while the smallest pieces stay the same
                if k == j:
                    n = left.n[j] // 2 if k == room else max(1, (left.n[j] - 4) // 2)
                    fixed.append(([(j, 2)], n))
                    left.take(j, 2 * n)
                else:
                    spare = left.n[k] if k == room or k not in low else max(1, left.n[k] - 3)
                    n = min(left.n[j], spare)
                    fixed.append(([(j, 1), (k, 1)], n))
                    left.take(j, n)
                    left.take(k, n)
                changed = True
    return fixed, dict(left.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on classes of equal lengths; open sequences are classes of equal contents."""
    open_: dict[int, list[Pattern]] = {}  # by room
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append(pattern)

    for length in sorted(counts, reverse=True):
        n, moved = counts[length], []
        while n:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                break
            room = rooms[i]
            items, often = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            each = room // length  # the tightest sequence stays the tightest until it is full
            full = min(often, n // each)
            if full:
                moved.append((room - each * length, (items + [(length, each)], full)))
            n -= full * each
            if full < often:
                rest = 1 if n else 0
                if rest:
                    moved.append((room - n * length, (items + [(length, n)], 1)))
                    n = 0
                if often - full - rest:
                    put(room, (items, often - full - rest))
        if n:
            each = capacity // length
            if n // each:
                moved.append((capacity - each * length, ([(length, each)], n // each)))
            if n % each:
                moved.append((capacity - n % each * length, ([(length, n % each)], 1)))
        for room, pattern in moved:
            put(room, pattern)
    return [p for patterns in open_.values() for p in patterns]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: ranks from ``rank`` on fill ``copies`` places a sequence from ``offset`` on."""
    fixed, left = reduce_by_dominance(counts, capacity)
    rows, used, base = [], {}, 0
    for items, often in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, copies in items:
            rank = used.get(length, 0)
            rows.append((length, rank, copies, base, offset))
            used[length] = rank + often * copies
            offset += length * copies
        base += often
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "copies", "base", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (a written table with doc_id, piece, length)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = plan(counts, capacity)
    # lengths and ranks as one sorted key: the rank fits below 2**48
    starts = (where["length"] << 48) + where["rank"]
    ranked = number_rows(pieces, ["length"], [c for c in pieces.columns if c != "length"], "_rank", rows=sum(counts.values()))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = column(batch, "length").to_numpy(zero_copy_only=False)
            rank = column(batch, "_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, (length << 48) + rank, "right") - 1
            i, copies = rank - where["rank"][at], where["copies"][at]
            keep = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(where["base"][at] + i // copies), pa.array(where["offset"][at] + i % copies * length)],
                names=[*(x for x in batch.schema.names if x != "_rank"), "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_arrow(ranked.select(*pieces.columns, "_rank"), step, f"{kept}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places; see the module's docstring for the odd cases."""
    return pack(staged(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)
