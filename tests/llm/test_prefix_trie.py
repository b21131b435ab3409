"""Prefix trie against a plain dictionary of prefixes, with cuts below large prefixes, odd rows and deep conversations."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from ticklake.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % 20, [])[:h] + ts[h:] if rebuild else ts
    nodes = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        below = [sums[k] for k in kids.get(p, [])]
        sums[p] = (sum(b[0] for b in below) or 1, (len(nodes[p]) - 1) * words + sum(b[1] for b in below))
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), *sums[p],
                    sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, rebuild=True, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text AS keys", "1 AS n", "2 AS depth")
    found = pt.sequences(df)
    return sorted((tuple(r) for r in pt.prefix_trie(pt.share_heads(found) if rebuild else found, **options).collect()), key=str)


def made(n, seed=5, words="ab"):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "bot", None]), rnd.choice([None, "", *words, "two words"]))
            for c in range(n) for t in range(rnd.randint(1, 7))]


def test_rebuilt_conversations(spark):
    rows = made(150) + [(161 + c, 0, "user", "hi") for c in range(25)]
    rows = [r for r in rows if r[0] not in (20, 60)]  # families without a first conversation
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("limit", [60, 400])
def test_large_prefixes_are_cut_deeper(spark, limit, monkeypatch):
    monkeypatch.setattr(pt, "FEW", 4)
    rows = made(300, words="a")
    rows += [(c, t, "user", "same") for c in range(1000, 1200) for t in range(3)]              # copies of one sequence
    rows += [(c, t, "user", "same" if t < 2 else f"w{c % 50} x") for c in range(2000, 2100) for t in range(4)]
    assert run(spark, rows, rebuild=False, limit=limit, chunk_turns=50, ids_per_row=7) == plain(rows, rebuild=False)


def test_deep_conversations(spark):
    rows = [(c, t, "u", f"t{t if t < 120 else t + c}") for c in (3, 4, 41) for t in range(150 + c)]
    assert run(spark, rows, rebuild=False) == plain(rows, rebuild=False)


def test_nulls_repeated_rows_and_ids(spark):
    rows = [(None, 0, "u", "lost"), (-5, None, None, None), (-5, 2, "u", "b"), (-5, 2, "u", "b"), (-5, 1, "u", "x " * 3000), (7, 3, "", ""),
            (8, 3, None, None), (21, 0, "u", "tab\tand\x0bmore  ")]
    assert run(spark, rows, rebuild=False) == plain(rows, rebuild=False)
    assert run(spark, rows[4:]) == plain(rows[4:])


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 2)
    rows = [(c, 0, "u", "a"), (c, 1, "u", "b")]
    assert run(spark, rows) == plain(rows) and len(run(spark, rows)) == 1


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(1, 0, "u", t) for t in "abc"] + [(2, 0, "u", t) for t in "cab"]
    assert len(run(spark, rows, rebuild=False)) == 4


def test_empty_table(spark):
    assert run(spark, []) == []
