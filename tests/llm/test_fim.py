"""Fill-in-the-middle against slices of Python strings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from starmart.llm import fim


def sliced(doc_id, text, layout):
    """(doc_id, n, form, prefix_chars, middle_chars, output) by slices."""
    text, marks = text or "", layout.marks
    p, s, m = marks
    digest = hashlib.sha256(f"{layout.salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in marks) or h[2] % 100 >= 100 - layout.plain_percent:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < layout.spm_percent:
        return doc_id, n, "spm", a, b - a, s + suffix + p + prefix + m + middle
    return doc_id, n, "psm", a, b - a, p + prefix + s + suffix + m + middle


ODD = [
    "a", "é😀\n" * 300, "x" * fim.BLOCK, "x" * 2 * fim.BLOCK + "\r\n", "<P", "<P> in it", "😀" * 1000, "$1\\b \\E" * 99,
    "\x85  a" * 200, "<S" * 100, "<" * 77, ">" * 50, "w " * 400_000,
]


def same(df, rows, layout=fim.Layout()):
    got = fim.transform(df, layout)
    back = got.select("*", fim.restore(F.col("output"), F.col("form"), layout).alias("back")).collect()
    assert sorted(repr(tuple(r)[:6]) for r in back) == sorted(repr(sliced(d, t, layout)) for d, t in rows)
    assert sorted(r.back for r in back) == sorted(t or "" for _, t in rows)
    return back


@pytest.mark.parametrize("table", ["edge", "given"])
def test_tables_are_cut_like_slices(request, table):
    df = request.getfixturevalue(table)
    back = same(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    for r in back:
        prefix, middle, suffix = fim.split_output(r.output, r.form)
        assert prefix + middle + suffix == r.back
        if r.form != "plain":
            assert (len(prefix), len(middle)) == (r.prefix_chars, r.middle_chars)


def test_odd_texts_under_many_ids(spark):
    rows = [(1000 * k + i, t) for k in range(6) for i, t in enumerate(ODD)]
    same(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_other_marks_with_signs_of_patterns(spark):
    rows = [(i, t) for i, t in enumerate(["a.b$c\\d" * 20, "^^ no mark", "plain ^p$ here", "z" * 300] * 4)]
    layout = fim.Layout("^p$", "^s.*", "^m\\1", plain_percent=0, spm_percent=50, salt="seed")
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows, layout)


def test_marks_that_could_arise_by_chance_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("<P<", "<S>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Layout(*marks)


def test_no_rows(empty):
    out = fim.digests(fim.transform(empty))
    assert out.collect() == []
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_the_plan_moves_nothing_and_runs_no_python(given):
    plan = fim.digests(fim.transform(given))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
