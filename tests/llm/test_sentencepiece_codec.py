"""Unigram codec against the library in unigram mode, a plain Viterbi, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from ticklake.llm import sentencepiece_codec as sc

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b ", "\n", "a\n\nb\n", "é́x", "日本語 テキスト", "\U0001F600 ok", "\x00\x01", "tab\there", "x" * 300,
       " nbsp", "ünïcode wörds", "<s> </s> <unk> <0x41>", "1234567", "    deep    space    "]


def plain(vocabulary, text):
    """Best sum of scores over all paths, and the library's rule for equal sums."""
    data = (" " + text.replace(sc.MARKER, " ")).encode() if text else b""
    number = {}
    for i, (p, ok) in enumerate(zip(vocabulary.pieces, vocabulary.normal, strict=True)):
        if ok:
            number.setdefault(p, i)
    low = min(s for s, ok in zip(vocabulary.scores, vocabulary.normal, strict=True) if ok) - sc.UNKNOWN_PENALTY
    best = {0: (0.0, [])}
    for p in range(len(data)):
        if p not in best:
            continue
        total, path = best[p]
        wide = 1
        while p + wide < len(data) and data[p + wide] & 0xC0 == 0x80:
            wide += 1
        for q in range(p + 1, min(len(data), p + vocabulary.longest) + 1):
            i = number.get(data[p:q])
            if i is not None and (q not in best or total + vocabulary.scores[i] > best[q][0]):
                best[q] = (total + vocabulary.scores[i], [*path, i])
        if data[p:p + wide] not in number and (p + wide not in best or total + low > best[p + wide][0]):
            best[p + wide] = (total + low, [*path, *(int(vocabulary.byte_id[b]) for b in data[p:p + wide])])
    return best[len(data)][1]


def encode(vocabulary, texts, **kw):
    ids, off = sc.PieceEncoder(vocabulary, **kw).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(off, off[1:], strict=False)]


def test_equals_plain_viterbi_with_a_small_vocabulary():
    rng = random.Random(1)
    for _ in range(30):
        names = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), sc.MARKER, "a", "b"]
        names += sorted({(sc.MARKER if rng.random() < 0.4 else "") + "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))) for _ in range(25)} - set(names))
        scores = [0.0 if i < 257 else float(-rng.randint(1, 12)) for i in range(len(names))]
        normal = np.arange(len(names)) >= 257
        vocabulary = sc.Vocabulary.of(names, scores, normal, np.arange(1, 257), 0)
        texts = ["".join(rng.choice("abcé d\n") for _ in range(rng.randint(0, 60))) for _ in range(25)]
        assert encode(vocabulary, texts) == [plain(vocabulary, t) for t in texts]


def test_as_good_as_the_library_in_unigram_mode():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    vocabulary = sc.Vocabulary.load(PATH)
    rng = random.Random(2)
    words = ["the", "thing", "Stster", "orblehe", "reingwh", "an", "of", "erheer.", "und", "ciónasja", "12", "don't", "Hello,", "(x)", "être"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", rng.choice(words)]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    for text, ids in zip(texts, encode(vocabulary, texts, max_words=50), strict=True):
        # the library's lattice search sums in single precision; its fast path misses better paths
        best = library.nbest_encode(text, nbest_size=2)[0]
        assert 0 <= sum(vocabulary.scores[ids]) - sum(vocabulary.scores[best]) < 200 and library.decode(ids) == text


def test_real_vocabulary_equals_plain_viterbi():
    vocabulary = sc.Vocabulary.load(PATH)
    assert encode(vocabulary, ODD) == [plain(vocabulary, t) for t in ODD]


def test_round_trips(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(10**6 + i, t) for i, t in enumerate([*ODD, None])]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, n_tokens int, ids string")
    encoded = sc.encode_texts(df, PATH)
    assert {r.doc_id: r.text for r in sc.decode_ids(encoded, PATH).collect()} == {d: t or "" for d, t in rows}
    out = sc.round_trip(df, PATH).collect()
    assert len(out) == len(rows) and all(r.same for r in out)
    assert {r.doc_id: r.n_tokens for r in out} == {r.doc_id: len(r.ids) for r in encoded.collect()}
    assert sc.round_trip(df.limit(0), PATH).count() == 0


def test_marker_character_and_invalid_bytes():
    vocabulary = sc.Vocabulary.load(PATH)
    ids, off = sc.PieceEncoder(vocabulary).encode(pa.array([f"a{sc.MARKER}b"]))
    assert sc.decode(vocabulary, ids, off) == ["a b"]
    lone = vocabulary.byte_id[[0xE2]]
    assert sc.decode(vocabulary, lone, np.array([0, 1])) == ["�"]
