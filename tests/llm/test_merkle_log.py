"""The Merkle log against trees put together by hand."""

import zlib
from hashlib import sha256
from pathlib import Path

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from tidemark.llm import merkle_log
from tidemark.llm.common import Scratch

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        at //= 16
    return out


def by_hand(rows) -> list[tuple]:
    order = lambda x: (x is not None, x)
    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0], leaf(row), row))
    named = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(sources[s], key=lambda x: (order(x[0])[0], x[0] or 0, x[1]))]) for s in named}
    top = tree([trees[s][-1][0] for s in named])
    out = []
    for k, s in enumerate(named):
        for at, (doc_id, own, row) in enumerate(sorted(sources[s], key=lambda x: (order(x[0])[0], x[0] or 0, x[1]))):
            steps = path(trees[s], at) + path(top, k)
            d = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and row[4] is not None:
                d = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in steps:
                d = h(left + d + right)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in steps)), d, d == top[-1][0]))
    return sorted(out, key=repr)


def got(df, spark) -> list[tuple]:
    return sorted((tuple(r) for r in merkle_log.manifest(df, Scratch(spark, "t")).collect()), key=repr)


def test_query_equals_its_sql(spark):
    assert not differences(merkle_log.op11(spark, SF), duck(SF), merkle_log.SQL)


def test_ragged_trees(spark):
    rows = [(k, f"of {n}", "en", k, f"Text {k}") for n in (1, 2, 16, 17, 255, 256, 257, 272, 273, 4097) for k in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3), spark) == by_hand(rows)


def test_single_row(spark):
    rows = [(15, "s", "en", 1, "A")]
    assert got(spark.createDataFrame(rows, SCHEMA), spark) == by_hand(rows)


def test_many_sources_and_odd_rows(spark):
    rows = [(k, f"s{k % 300}", None, None, "É A" * (k % 7)) for k in range(900)]
    rows += [(None, "s1", "en", 1, "A"), (None, "s1", "en", 1, "B"), (None, None, None, None, None), (5, None, "x", 2, None), (0, None, "x", 2, None), (-7, "", "x", 2, "")]
    rows += [(10, "s1", "en", 3, "same")] * 40 + [(20, "é", "en", 3, "Z" * 100_000), (20, "é", "en", 3, "z" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("tree", "index", "n", "digest", "leaf", "_at", "_part")})
    assert got(df, spark) == by_hand(rows)


def test_empty_table(spark):
    out = merkle_log.manifest(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and out.count() == 0


@pytest.mark.parametrize("m", [1, 2, 15, 16, 17, 31, 100, 240, 241, 255, 256])
def test_positions_in_a_log(m):
    leaves = [sha256(b"%d" % k).digest() for k in range(m)]
    levels = tree([x.hex() for x in leaves])
    over = merkle_log.levels_over(m)
    log = merkle_log.append_log(leaves, over)
    assert over == len(levels) - 1 and len(log) == 32 * sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for k, digest in enumerate(nodes):
            p = merkle_log.position(level, k, m)
            assert log[32 * p : 32 * p + 32].hex() == digest


def test_a_change_anywhere_is_noticed(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}") for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = merkle_log.manifest(df, Scratch(spark, "t"), tampered=F.concat("text", F.lit("!"))).collect()
    changed = {r.doc_id for r in out if not r.verified}
    assert changed == {k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert len({r.root for r in out}) == 1 and not Path(Scratch(spark, "u").root.removeprefix("file://")).exists()
