import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from riskmart.llm import manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, g int, k string, leaf string, more int, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves, fanout=8):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, i, fanout=8):
    out = []
    for level in levels[:-1]:
        s = i // fanout * fanout
        out.append(("".join(level[s:i]), "".join(level[i + 1:s + fanout])))
        i //= fanout
    return out


def fold(way, node):
    for before, after in way:
        node = H(before, node, after)
    return node


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    groups = {}
    for row in rows:
        tried = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        leaf = leaf_of(row, row[1])
        groups.setdefault(row[2], []).append(
            (row[0] is not None, row[0] or 0, leaf, row[0], leaf_of(row, lowered(row[1])) if tried else leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(groups[x], key=lambda r: r[:3])]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for i, (_, _, leaf, doc, tampered) in enumerate(sorted(groups[x], key=lambda r: r[:3])):
            way = path(trees[x], i) + path(top, at)
            folded = fold(way, tampered)
            out.append((doc, leaf, trees[x][-1][0], top[-1][0], H(*[a + b for a, b in way]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows():
    out = [(i, f"Text Nr {i} äß€" if i % 5 else "lower only", ["en", "de", None, "ä"][min(i % 11, 3)], None if i % 4 else "s", i, )
           for i in range(1300)]
    out += [(7000, "Only One", "fr", "s", 1), (None, None, "en", None, None), (None, "", "en", None, None), (9, "", "de", "", 0)]
    out += [(8000, "Copy", "en", "s", 4)] * 40 + [(8000, "Other Text", "en", "s", 4)]
    return [r + (1, "x", "y", 2, "z") for r in out]


def run(spark, data, folder):
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return M.op11_merkle(spark, str(folder))


def test_matches_brute_force_and_sql(spark, tmp_path):
    data = rows()
    got = sorted(map(tuple, run(spark, data, tmp_path).collect()), key=str)
    assert got == brute(data)
    assert {v for *_, v in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    assert sorted(con.execute(f"SELECT {columns} FROM ({M.OP11_SQL})").fetchall(), key=str) == got


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 16, 17, 33, 65])
def test_every_ragged_butterfly(spark, n):
    """Fanout 2 and blocks of 2 leaves: many rounds, incomplete subtrees at every level."""
    leaves = spark.range(n).select(F.lit(0).alias("g"), F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"),
                                   F.struct("id").alias("more"))
    levels = tree([H(str(i)) for i in range(n)], 2)
    got = M.proofs(leaves, fanout=2, height=1).collect()
    assert len(got) == n
    for r in got:
        assert r.pos == r.more.id and r.root == levels[-1][0] == r.subroot
        assert [tuple(step) for step in r.path] == path(levels, r.pos, 2)
