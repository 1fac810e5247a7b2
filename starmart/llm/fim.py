"""Fill-in-the-middle transformation with counted-quantifier patterns.

``regexp_count`` gives a text's number of code points, n. Two places in
``0..n`` and the layout come from a hash of the document's id. Each row then
gets a pattern of its own: a possessive group of exactly ``a`` units, one of
``b - a`` units and one of the rest, ``\\A(.{a}+)(.{b-a}+)(.*+)``. One match
captures prefix, middle and suffix, and the replacement lays them out behind
their marks, so no text is cut three times. Possessive groups don't back up:
a match is one pass over the text, without recursion.

Counting writes one match for each ``BLOCK`` units and one for each unit of the
last, incomplete block, so a very long text needs few of them in memory.

Layouts: ``plain`` (the text), ``psm`` (prefix, suffix, middle), ``spm``
(suffix, prefix, middle). Plain are empty texts, those that hold a mark, and a
share of the rest. Marks start with a character that occurs in none of them
again, so no mark arises where a part and a mark meet, and ``restore`` rebuilds
the text from the output and its layout alone.

Defined results: a null text counts as empty; a null id hashes as the bare
salt; rows that repeat, or share an id, are transformed alike; a text with line
ends, or characters beyond the basic plane, is counted and cut in code points;
an empty table gives an empty table; columns beyond the two named are not read.
DataFrame functions only; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import text_of

BLOCK = 256


@dataclass(frozen=True)
class Layout:
    """Marks of prefix, suffix and middle, and the shares of the layouts (percent)."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain_percent: int = 10
    spm_percent: int = 20
    salt: str = "1"

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) < 3 or any(not m or m[0] in "".join(x[1:] for x in marks) for m in marks):
            raise ValueError("marks must differ and start with a character that none of them has again")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def code_points(text: Column) -> Column:
    """Number of code points: whole blocks, then the units of what is left behind them."""
    blocks = F.regexp_count(text, F.lit(rf"(?s).{{{BLOCK}}}+"))
    rest = F.regexp_count(text, F.lit(rf"(?s)\G(?:.{{{BLOCK}}}+)*+."))
    return (blocks.cast("long") * BLOCK + rest).cast("long")


def id_numbers(id_col: str, salt: str) -> list[Column]:
    """Four numbers of 32 bits of an id: the first groups of its salted SHA-256."""
    said = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(said, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _plain_text(mark: str) -> str:
    """``mark`` for a replacement string, where ``\\`` and ``$`` mean something."""
    return mark.replace("\\", r"\\").replace("$", r"\$")


def transform(
    docs: DataFrame, layout: Layout = Layout(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: ``doc_id, n, form, prefix_chars, middle_chars, output``."""
    p, s, m = layout.marks
    text = F.col("text")
    h = [F.col(f"h{i}") for i in range(4)]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_of(text_col).alias("text"),
        *[x.alias(f"h{i}") for i, x in enumerate(id_numbers(id_col, layout.salt))],
    ).withColumn("n", code_points(text))
    marked = F.lit(False)
    for mark in layout.marks:
        marked = marked | text.contains(mark)
    plain = (F.col("n") == 0) | marked | (h[2] % 100 >= 100 - layout.plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < layout.spm_percent, "spm").otherwise("psm")
    cuts = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    rows = rows.select("*", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    pattern = F.format_string(r"(?s)\A(.{%d}+)(.{%d}+)(.*+)", F.col("a"), F.col("b") - F.col("a"))
    p, s, m = map(_plain_text, (p, s, m))
    laid = F.when(F.col("form") == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(cut, F.col("a")).alias("prefix_chars"),
        F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        F.when(cut, F.regexp_replace(text, pattern, laid)).otherwise(text).alias("output"),
    )


def restore(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The text that ``output`` was made of: one match of the three marks and what stands behind them."""
    p, s, m = (rf"\Q{x}\E" for x in layout.marks)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def split_output(output: str, form: str, layout: Layout = Layout()) -> tuple[str, str, str]:
    """(prefix, middle, suffix) of one output, for a reader outside Spark; a plain text is all prefix."""
    if form == "plain":
        return output, "", ""
    p, s, m = layout.marks
    first, second = (p, s) if form == "psm" else (s, p)
    found = re.fullmatch(f"{re.escape(first)}(.*?){re.escape(second)}(.*?){re.escape(m)}(.*)", output, re.S)
    if found is None:
        raise ValueError(f"not an output of form {form}")
    x, y, middle = found.groups()
    return (x, middle, y) if form == "psm" else (y, middle, x)


def digests(done: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """``output`` replaced by its digest and that of the text restored from it."""
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form"), layout), 256).alias("restored_sha256"),
    )
