"""Quality rules: counts against a plain computation, the learner on planted rules and on held-out labels."""

import random
import re

from pyspark.sql import functions as F

from ticklake.llm import quality_rules as qr

GAP = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, covered = {}, set()
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if GAP.sub("", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(5)
    out = [None, "", " ", "\n\n \t\n", "a", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "é ü 日本 \x0b x\x0cy\rz",
           "x\ny\nx\n x\n\n\n", "##|| <a> $5 100%", "a b c d", "a b a b a", "\U0001F600 ok \U0001F600 ok \U0001F600"]
    for _ in range(60):
        out.append(" ".join(rng.choice("abcdef"[:rng.randint(1, 6)]) + rng.choice(["", "\n", "\t", "|"]) for _ in range(rng.randint(1, 90))))
    out.append(" ".join(f"w{i % 9000}" for i in range(20000)))
    out.append("und " * 30000)
    return out


def test_counts_equal_a_plain_computation(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], "doc_id long, text string, n_words int, _words string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in qr.text_statistics(df).collect()}
    assert got == {i: plain(t) for i, t in rows}


def _corpus(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1200):
        low = i % 4 == 0
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 120))]
        if low:
            words = [w + "|" for w in words]
        rows.append((i, " ".join(words), int(not low)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_finds_a_planted_rule(spark):
    df = _corpus(spark)
    out = qr.apply_rules(df.select("doc_id", "text"), df.select("doc_id", "quality")).collect()
    assert not any(r.base_failed for r in out)
    assert sum(r.kept != (r.doc_id % 4 != 0) for r in out) <= 6


def test_rules_are_ordered_conditionals(spark):
    rules = [(qr.Condition("upper", True, 0.5),), (qr.Condition("words", False, 10.0), qr.Condition("symbols", True, 0.1))]
    df = spark.createDataFrame([(0.6, 100.0, 0.0), (0.1, 5.0, 0.2), (0.1, 5.0, 0.0), (0.1, 20.0, 0.9)], "upper double, words double, symbols double")
    assert [r.x for r in df.select(qr.rejected(rules).alias("x")).collect()] == [True, True, False, False]


def test_no_labels_null_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "word " + "x y z " * 3), (None, None), (2, " ".join(f"a{i}" for i in range(60)))], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, quality int")
    got = {r.doc_id: (r.base_failed, r.kept) for r in qr.apply_rules(docs, none).collect()}
    assert got == {1: (True, False), None: (True, False), 2: (False, True)}
    assert qr.apply_rules(docs.limit(0), none).count() == 0


def test_query_on_held_out_labels(spark):
    """Learned on half of the labels, the list must be right about most of the others and keep the good ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = qr.apply_rules(docs, labels.filter("doc_id % 2 = 0"))
    held = out.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    r = held.agg(F.expr("count_if(quality = 1 and kept)").alias("tp"), F.expr("count_if(quality = 1)").alias("p"),
                 F.expr("count_if(quality = 0 and not kept)").alias("tn"), F.expr("count_if(quality = 0)").alias("n")).first()
    assert r.tp >= 0.97 * r.p and r.tn >= 0.5 * r.n
