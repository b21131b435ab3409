"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and log scores of a public vocabulary file go into a double-array
trie over UTF-8 bytes, with the white-space marker spelt as a space.  A text
gets the dummy prefix, and the path of pieces with the highest sum of scores
is found by Viterbi; equal sums keep the path whose last piece is longer.  A
character without a piece costs more than any piece and comes out as byte
pieces.  No piece goes over a border between another character and a space, nor holds a
line feed, so the best path of a text is made of the best paths of its
chunks: the trie walk and the Viterbi steps run with NumPy on all distinct
chunks of a batch at once.  Decoding joins pieces and bytes, turns markers
into spaces and drops the dummy prefix.

Cases: null and empty texts have no ids and decode to the empty text; a
literal marker character cannot be told from a space; bytes that are not UTF-8
decode to the replacement character; equal rows are dealt with each; an empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, ship_package, slices
from ticklake.llm.encoding import MAX_WORDS, PartEncoder
from ticklake.llm.words import span_hashes, text_buffer

MARKER = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass
class DoubleArray:
    """Trie of byte strings: the child of state s by byte b is base[s] + b if check[base[s] + b] == s."""
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # of the state: the string's number, or -1

    @staticmethod
    def build(keys: list[bytes]) -> "DoubleArray":
        children: list[dict[int, int]] = [{}]
        ends = {}
        for number, key in enumerate(keys):
            node = 0
            for b in key:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = len(children)
                    children[node][b] = nxt
                    children.append({})
                node = nxt
            ends.setdefault(node, number)
        size = 2 * len(children) + 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        place, stack, free, top = {0: 0}, [0], 1, 1  # top: all places above it are free
        while stack:
            node = stack.pop()
            state = place[node]
            value[state] = ends.get(node, -1)
            if not children[node]:
                continue
            labels = sorted(children[node])
            while check[free] >= 0:
                free += 1
            # a place near the first free one or, for wide nodes, near the top
            near = max(1, free - labels[0])
            at = next((a for a in (*range(near, min(near + 40, top)), *range(max(1, top - 400), top))
                       if all(check[a + b] < 0 for b in labels)), top)
            if at + 512 >= len(base):
                grow = len(base)
                base, check, value = base + [0] * grow, check + [-1] * grow, value + [-1] * grow
            top = max(top, at + labels[-1] + 1)
            base[state] = at
            for b in labels:
                check[at + b] = state
                place[children[node][b]] = at + b
                stack.append(children[node][b])
        return DoubleArray(*(np.array(x + [-1 if x is check else 0] * 256, np.int64) for x in (base, check)),
                           np.array(value + [-1] * 256, np.int64))


@dataclass
class Vocabulary:
    """Pieces with log scores; numbers are ids."""
    pieces: list[bytes]        # the marker spelt as a space
    scores: np.ndarray
    normal: np.ndarray         # pieces that text may match
    byte_id: np.ndarray        # id of each byte's piece, or of the unknown piece
    unknown: int

    @staticmethod
    def load(path: str) -> "Vocabulary":
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        odd = np.array([model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)])
        byte_id = np.full(256, model.unk_id())
        for i in range(n):
            if model.is_byte(i):
                byte_id[int(names[i][1:-1], 16)] = i
        return Vocabulary.of(names, [model.get_score(i) for i in range(n)], ~odd, byte_id, model.unk_id())

    @staticmethod
    def of(names: list[str], scores: list[float], normal, byte_id, unknown: int) -> "Vocabulary":
        pieces = [s.replace(MARKER, " ").encode() for s in names]
        for p, ok in zip(pieces, normal, strict=True):
            if ok and (b" " in p.lstrip(b" ") or b"\n" in p):
                raise ValueError(f"the piece {p!r} goes over a chunk's border")
        return Vocabulary(pieces, np.asarray(scores, np.float64), np.asarray(normal, bool), np.asarray(byte_id), unknown)

    @cached_property
    def trie(self) -> DoubleArray:
        return DoubleArray.build([p if ok else b"" for p, ok in zip(self.pieces, self.normal, strict=True)])

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p, ok in zip(self.pieces, self.normal, strict=True) if ok), default=0)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all ids as they are decoded, begin, length)."""
        out = list(self.pieces)
        for i, ok in enumerate(self.normal):
            if not ok:
                out[i] = b""
        for b, i in enumerate(self.byte_id):
            if i != self.unknown:
                out[i] = bytes([b])
        length = np.array([len(p) for p in out])
        return np.frombuffer(b"".join(out), np.uint8), np.cumsum(length) - length, length


def viterbi(vocabulary: Vocabulary, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the best paths of all chunks, number of ids of each)."""
    sizes = np.array([len(c) for c in chunks], np.int64)
    found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(chunks)
    # chunks of like lengths together, so that the tables hold little else
    kind = np.ceil(np.log2(np.maximum(sizes, 8))).astype(int)
    for k in np.unique(kind):
        for part in np.array_split(np.flatnonzero(kind == k), max(1, int(((kind == k).sum() << int(k)) >> 21))):
            ids, n = _viterbi(vocabulary, [chunks[i] for i in part], int(sizes[part].max(initial=0)))
            cuts = np.cumsum(n)[:-1]
            for i, x in zip(part.tolist(), np.split(ids, cuts), strict=True):
                found[i] = x
    length = np.array([len(x) for x in found], np.int64)
    return np.concatenate(found).astype(np.uint32) if found else np.zeros(0, np.uint32), length


def _viterbi(vocabulary: Vocabulary, chunks: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    trie, scores = vocabulary.trie, vocabulary.scores
    n = len(chunks)
    size = np.array([len(c) for c in chunks], np.int64)
    text = np.zeros((n, width + 1), np.uint8)
    text[np.arange(width + 1) < size[:, None]] = np.frombuffer(b"".join(chunks), np.uint8)
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    back, ids = np.zeros((n, width + 1), np.int32), np.zeros((n, width + 1), np.int32)
    lowest = scores[vocabulary.normal].min(initial=0.0) - UNKNOWN_PENALTY
    char = np.ones(256, np.int64)
    char[0xC0:0xE0], char[0xE0:0xF0], char[0xF0:0xF8] = 2, 3, 4
    for p in range(width):
        row = np.flatnonzero((best[:, p] > -np.inf) & (size > p))
        if not len(row):
            continue
        start = best[row, p]
        wide = np.minimum(char[text[row, p]], size[row] - p)
        single = np.zeros(len(row), bool)
        alive, state = np.arange(len(row)), np.zeros(len(row), np.int64)
        for q in range(p, min(width, p + vocabulary.longest)):
            alive = alive[size[row[alive]] > q]
            nxt = trie.base[state[alive]] + text[row[alive], q]
            ok = (trie.check[nxt] == state[alive]) & (nxt > 0)
            alive = alive[ok]
            if not len(alive):
                break
            state[alive] = nxt[ok]
            piece = trie.value[state[alive]]
            hit, piece = alive[piece >= 0], piece[piece >= 0]
            if len(hit):
                single[hit] |= wide[hit] == q + 1 - p
                r, total = row[hit], start[hit] + scores[piece]
                better = total > best[r, q + 1]
                r = r[better]
                best[r, q + 1], back[r, q + 1], ids[r, q + 1] = total[better], p, piece[better]
        lone = np.flatnonzero(~single)
        if len(lone):
            r, w = row[lone], wide[lone]
            better = start[lone] + lowest > best[r, p + w]
            r, w, total = r[better], w[better], (start[lone] + lowest)[better]
            best[r, p + w] = total
            for j in range(1, int(w.max(initial=0)) + 1):  # a chain of byte pieces; nothing else ends inside a character
                x = r[w >= j]
                back[x, p + j], ids[x, p + j] = p + j - 1, vocabulary.byte_id[text[x, p + j - 1]]
    out, lengths, at = [], np.zeros(n, np.int64), size.copy()
    row = np.flatnonzero(at > 0)
    while len(row):
        out.append((row, ids[row, at[row]]))
        lengths[row] += 1
        at[row] = back[row, at[row]]
        row = row[at[row] > 0]
    if not out:
        return np.zeros(0, np.uint32), lengths
    rows, found = np.concatenate([r for r, _ in out]), np.concatenate([i for _, i in out])
    step = np.repeat(np.arange(len(out)), [len(r) for r, _ in out])
    end = np.cumsum(lengths)
    flat = np.zeros(end[-1], np.uint32)
    flat[end[rows] - 1 - step] = found  # paths were read from their ends
    return flat, lengths


class Chunks:
    """Chunks of a batch of texts: a run of spaces with what follows up to the next space or line feed; each line feed by itself."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        texts = pc.replace_substring(texts, MARKER, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
        self.data, self.off = text_buffer(texts)
        data, n = self.data, len(self.data)
        begin = np.zeros(n, bool)
        if n:
            space, line = data == 0x20, data == 0x0A
            begin[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
            begin[self.off[:-1][self.off[:-1] < n]] = True
        self.start = np.flatnonzero(begin)
        self.end = np.append(self.start[1:], n)[:len(self.start)]
        self.first = np.searchsorted(self.start, self.off)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


class PieceEncoder(PartEncoder):
    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS):
        self.vocabulary = vocabulary
        super().__init__(max_words)

    def _parts(self, texts) -> Chunks:
        return Chunks(texts)

    def _encode_new(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return viterbi(self.vocabulary, parts)


def decode(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of id lists."""
    flat, begin, length = vocabulary.flat
    n = length[ids]
    total = np.concatenate([[0], np.cumsum(n)])
    data = flat[np.repeat(begin[ids] - total[:-1], n) + np.arange(total[-1])]
    out = []
    for a, b in zip(total[offsets[:-1]].tolist(), total[offsets[1:]].tolist(), strict=True):
        text = data[a:b].tobytes()
        out.append((text[1:] if text[:1] == b" " else text).decode("utf-8", "replace"))
    return out


_VOCABULARIES: dict[str, Vocabulary] = {}
_ENCODERS: dict[str, PieceEncoder] = {}


def _broadcast(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary with its trie, built once on the driver (a few MB, whatever the data)."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary.load(path)
        _ = _VOCABULARIES[path].trie, _VOCABULARIES[path].longest
    ship_package(spark)
    return spark.sparkContext.broadcast(_VOCABULARIES[path])


def _encoder(path: str, vocabulary: Broadcast) -> PieceEncoder:
    """The worker's encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(vocabulary.value)
    return _ENCODERS[path]


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    known_pieces = _broadcast(docs.sparkSession, vocabulary)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(vocabulary, known_pieces)
        for part in slices(batches):
            ids, off = enc.encode(column(part, "text"))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of every list of ids (null: null)."""
    known_pieces = _broadcast(encoded.sparkSession, vocabulary)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _encoder(vocabulary, known_pieces).vocabulary
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                lists = column(part, "ids")
                off = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
                texts = decode(known, lists.flatten().to_numpy(zero_copy_only=False), off.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array([t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())],
                    names=["doc_id", "text"])

    return map_arrow(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), step, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, n_byte_tokens, ids_crc32, decoded_crc32, same (decoded text equals the text)."""
    known_pieces = _broadcast(docs.sparkSession, vocabulary)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(vocabulary, known_pieces)
        known = enc.vocabulary
        is_byte = np.zeros(len(known.pieces), np.int64)
        is_byte[known.byte_id] = 1
        for part in slices(batches):
            texts = column(part, "text")
            ids, off = enc.encode(texts)
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            fallback = np.concatenate([[0], np.cumsum(is_byte[ids])])
            crc, back, same = [], [], []
            for a, b, text, again in zip(off[:-1].tolist(), off[1:].tolist(), texts.to_pylist(), decode(known, ids, off), strict=True):
                crc.append(zlib.crc32(raw[4 * a:4 * b]))
                back.append(zlib.crc32(again.encode()))
                same.append(again == (text or "").replace(MARKER, " "))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(np.diff(off), pa.int64()), pa.array(np.diff(fallback[off]), pa.int64()),
                 pa.array(crc, pa.int64()), pa.array(back, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "decoded_crc32", "same"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step,
                     "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, decoded_crc32 long, same boolean")
