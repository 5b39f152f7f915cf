"""Text trees against their SQL and against trees built by hand."""

import re
from hashlib import sha256

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from tidemark.llm import text_tree

SF = "/root/testdata/sf0.001"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def by_hand(text: str) -> tuple[str, list[list[str]], dict[str, int]]:
    sections: list[list[str]] = [[]]
    for p in text.split("\n"):
        sections[-1].append(h("p" + p))
        if sections[-1][-1] < "4" or not p:
            sections.append([])
    sections = [s for s in sections if s]
    root = h("r" + "".join(h("s" + "".join(s)) for s in sections))
    found = re.findall(r"[^.!?,;:\n]{1,60000}[.!?,;:]{0,5000}|[.!?,;:]{1,60000}", text)
    return root, sections, {c: len(c) for c in found}


def alike(a: str, b: str) -> float:
    (ra, _, ca), (rb, _, cb) = by_hand(a), by_hand(b)
    total = sum(ca.values()) + sum(cb.values())
    return 1.0 if ra == rb else 2 * sum(n for c, n in ca.items() if c in cb) / total if total else 0.0


def audit_by_hand(rows: list[tuple]) -> list[tuple]:
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        out.append((doc_id, n, h(edited), by_hand(text)[0], by_hand(edited)[0], round(alike(text, edited), 9), round(alike(text, after), 9)))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    rows = text_tree.edit_audit(df).collect()
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows), key=repr)


def bounds_by_hand(a: str, b: str) -> tuple[int, int]:
    (_, own, _), (_, others, _) = by_hand(a), by_hand(b)
    known, lines, at, found = {tuple(s) for s in others}, {x for s in others for x in s}, 0, []
    for s in own:
        if tuple(s) not in known:
            found.append([at + k for k, x in enumerate(s) if x not in lines] or [at, at + len(s) - 1])
        at += len(s)
    return min(found[0]), max(found[-1])


def test_query_equals_its_sql(spark):
    assert not differences(text_tree.op12(spark, SF), duck(SF), text_tree.SQL)


def test_odd_texts(spark):
    texts = [None, "", "\n", "\n\n\n", "one", "One. Two, three\nfour\n\nfive", "ÄÖ😀" * 50_000, "a" * 200_000, "!" * 130_000, "x.\n" * 30_000, "same", "same", "𝒳y. 𝒳z.\n𝒳"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(-(1 << 63), "low. est"), ((1 << 63) - 1, "high. est")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("edited", "_lines", "own_root", "_bucket", "n_chars", "next_text")})
    assert got(df) == audit_by_hand(rows)


@pytest.mark.parametrize("n", [1, 2, 500])
def test_many_ranges(spark, n):
    rows = [(7 * k % n - 40, f"Text {k}. Of {n}") for k in range(n)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == audit_by_hand(rows)


def test_ids_that_many_rows_share(spark):
    """A document's next is still the one after it, though most rows share an id or are equal."""
    rows = [(5, "copy. of it")] * 300 + [(None, "no id")] * 200 + [(9, "first")] + [(1, "last")]
    out = text_tree.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    pairs = sorted(((r.doc_id, r.text, r.next_text) for r in out), key=repr)
    want = [(9, "first", "copy. of it")] + [(5, "copy. of it", "copy. of it")] * 299 + [(5, "copy. of it", "last"), (1, "last", "no id")] + [(None, "no id", "no id")] * 199 + [(None, "no id", "first")]
    assert pairs == sorted(want, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert text_tree.edit_audit(df).count() == 0 and text_tree.fingerprints(df).count() == 0


def test_trees_and_edits(spark):
    lines = [f"Line {k}, of a text. With clauses" for k in range(200)]
    changed = [*lines[:60], "New line", *lines[60:120], "Other words", *lines[123:]]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed)), ("\n".join(lines), "\n".join(lines)), (None, "")], "a string, b string")
    edit, same, empty = text_tree.compared(df, "a", "b").collect()
    _, sections, _ = by_hand("\n".join(lines))
    assert (edit.first_edit, edit.last_edit) == bounds_by_hand("\n".join(lines), "\n".join(changed))
    assert edit.first_edit <= 120 and 122 <= edit.last_edit < 150 and 0.9 < edit.likeness < 1 and edit.a_root != edit.b_root
    assert (same.likeness, same.first_edit, same.last_edit) == (1.0, None, None) and same.a_root == same.b_root
    assert empty.a_root == empty.b_root and empty.likeness == 1.0
    tree = text_tree.fingerprints(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).first()
    assert [[p.digest for p in s.paragraphs] for s in tree.sections] == sections and [p.line for s in tree.sections for p in s.paragraphs] == list(range(200))


def test_no_python_in_the_plan(spark):
    plan = text_tree.op12(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
