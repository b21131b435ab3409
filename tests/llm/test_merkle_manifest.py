"""Merkle manifest: trees, proofs and versions against plain recursion, over several rounds of blocks."""

import zlib
from hashlib import sha256

from ticklake.llm import merkle_manifest as mm

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        a = i - i % 16
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 16])))
        i //= 16
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified, nodes copied), sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = [levels([leaf(r, r[4]) for r in groups[s]]) for s in order]
    top = levels([t[-1][0] for t in trees])
    out = []
    for place, (s, tree) in enumerate(zip(order, trees)):
        for i, r in enumerate(groups[s]):
            path = siblings(tree, i) + siblings(top, place)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[4].translate({c: c + 32 for c in range(65, 91)}) if hit and r[4] is not None else r[4]
            node = leaf(r, text)
            for a, b in path:
                node = h(a, node, b)
            out.append((r[0], tree[0][i], tree[-1][0], top[-1][0], h(*(a + b for a, b in path)), node, node == top[-1][0],
                        len(path) + 1 if hit else 0))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "doc_id AS tree", "text AS hash", "1 AS position", "2 AS n")
    return sorted((tuple(r) for r in mm.verified_documents(df).collect()), key=str)


def test_one_tree_of_two_rounds_of_blocks_and_many_small_ones(spark):
    rows = [(i, "hot", "en", i % 7, f"Text {i}") for i in range(5000)] + [(9000 + i, f"s{i % 33}", None, None, "A" * (i % 4)) for i in range(200)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert {r[7] for r in got} == {0, 1 + 4 + 2, 1 + 1 + 2}  # hot: 5000, 313, 20, 2, 1; small: 7, 1; sources: 34, 3, 1


def test_tampering_shows_unless_nothing_changed(spark):
    rows = [(i, "s", "en", 1, "UPPER" if i % 2 else "lower") for i in range(40)]
    for r in run(spark, rows):
        hit = zlib.crc32(str(r[0]).encode()) % 5 == 0
        assert r[6] == (not (hit and r[0] % 2))


def test_nulls_empty_texts_ties_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (1, "", "x", 0, "É A"),
            (5, None, "de", -3, None), (-7, "ü", "de", 2, "B"), (2**62, "z", "q", 9, "C\n")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[2:3]) == plain(rows[2:3])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_version_shares_all_but_its_path(spark):
    """The nodes listed by a version are the only ones that a rebuilt tree does not share with the first one."""
    rows = [(i, "s", "en", 1, f"Doc {i}") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = mm.manifest(df, mm.F.col("doc_id") == 37, mm.F.lit("other")).collect()
    assert [r.doc_id for r in found if r.version] == [37]
    version = next(r.version for r in found if r.version)
    first = levels([leaf(r, r[4]) for r in rows])
    second = levels([leaf(r, "other" if r[0] == 37 else r[4]) for r in rows])
    new = [x for a, b in zip(first, second) for x, y in zip(b, a) if x != y]
    assert version[:len(new)] == new and version[-1] == h(new[-1]) or version == new
