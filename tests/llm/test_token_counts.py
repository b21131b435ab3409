"""Length histogram against a direct count with the tokenizer."""

import public_tokenizers
from tokenizers import Tokenizer

from ticklake.llm import token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_histogram_and_quantiles(spark):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = ["one two three"] * 4 + ["", None, "Straße 12,5", "x " * 700, "wörd wörd", "don't", "a", "\n", "日本 語"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    size = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts)
    hist = token_counts.length_histogram(df, WORD_BPE, block=4)
    got = {r.n_tokens: r for r in hist.collect()}
    assert sorted(got) == sorted(set(size))
    for n, r in got.items():
        assert (r.n_docs, r.token_sum) == (size.count(n), n * size.count(n))
        assert r.docs_ge == sum(s >= n for s in size) and r.tokens_ge == sum(s for s in size if s >= n)
        assert r.truncated_tokens == sum(min(s, n) for s in size)
        assert (r.total_docs, r.total_tokens) == (len(size), sum(size))
    asked = [0.0, 0.25, 0.5, 0.9, 1.0]
    quantile = {r.probability: r.n_tokens for r in token_counts.quantiles(hist, asked).collect()}
    for p in asked:
        need = -(-p * len(size) // 1)
        assert quantile[p] == min(s for s in size if sum(x <= s for x in size) >= need)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.length_histogram(df, WORD_BPE).count() == 0
