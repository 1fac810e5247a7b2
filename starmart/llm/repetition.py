"""Quality rules on repetition inside a text, from its suffix array.

The words of a text are numbered and a suffix array over them is built by
prefix doubling, for many texts at once: a sentinel of its own ends each text,
so suffixes of different texts never share a prefix. Neighbouring suffixes
give the longest common prefixes, whose intervals are the repeated passages:
every suffix that shares ``k`` or more words with a neighbour starts an
occurrence of a maximal repeat of at least ``k`` words. The union of the spans of these
occurrences is the covered part of the text; the largest common prefix is its
longest repeat.

Rules: ``base`` (too few words, or too many words in repeated three-word
windows) and ``repetition`` (covered fraction or longest repeat over a limit).

Defined results: a null or empty text has no words and fails the base rule;
repeated rows give repeated rows; an empty table gives an empty table; other
columns are passed through (``keep_clean``) or not read (``repetition_rules``).
Texts are read whole; what a task holds is one Arrow batch and the arrays of
about ``WORDS_AT_ONCE`` words, or of one text if that has more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_AT_ONCE = 400_000
_WHITE = np.isin(np.arange(256), list(b"\x20\t\n\x0b\x0c\r"))
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: Adds one for each code point (bytes that don't continue one).
_FIRST = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Limits:
    """``min_words`` words at least; ``max_window_percent`` of words in repeated three-word windows;
    passages of ``repeat_words`` words or more that repeat may cover ``max_covered_percent`` of the words,
    and the longest may hold ``max_longest_percent`` of them or ``repeat_words * 2`` words."""

    min_words: int = 50
    max_window_percent: int = 50
    repeat_words: int = 10
    max_covered_percent: int = 30
    max_longest_percent: int = 25


def longest_shared(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word, the longest prefix its suffix shares with any other suffix of its text.

    ``words``: numbers, texts one after another; ``sizes``: words of each text.
    """
    n = words.size
    if not n:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(sizes.size), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)  # the place after the text's last word
    # rank[i]: place of the class of suffixes that agree on the first h words.
    order = np.lexsort((words, owner))
    w, o = words[order], owner[order]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    h = 1
    # Only suffixes that still share their class are sorted again.
    counts = np.diff(np.append(starts, n))
    open_at = np.flatnonzero(np.repeat(counts > 1, counts))
    while open_at.size:
        who = order[open_at]
        ahead = who + h
        past = ahead >= end[who]
        key = np.where(past, -1, rank[np.minimum(ahead, n - 1)])
        mine = rank[who]
        turn = np.lexsort((key, mine))
        who, key, mine = who[turn], key[turn], mine[turn]
        order[open_at] = who  # classes keep their places, so sorted by class they fall into their own
        new = np.empty(who.size, bool)
        new[0] = True
        new[1:] = (mine[1:] != mine[:-1]) | (key[1:] != key[:-1]) | (key[1:] < 0)
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, who.size))
        rank[who] = np.repeat(open_at[starts], counts)
        open_at = open_at[np.repeat(counts > 1, counts)]
        h *= 2
    return _neighbours(words, order, owner, end)


def _neighbours(words: np.ndarray, order: np.ndarray, owner: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the suffix array: the larger common prefix with either neighbour, by suffix."""
    n = words.size
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n + 1, np.int64)
    going = np.flatnonzero(owner[a] == owner[b])
    # Binary lifting on matched lengths would need all ranks; comparing word by
    # word would cost the length of the repeat for each pair. Neighbours are
    # compared in text order instead: a suffix shares at least one word less
    # than the suffix before it did, so only the rest is compared (Kasai), here
    # for the pairs whose start isn't explained by the pair before.
    if going.size:
        left = np.full(n, -1, np.int64)  # the neighbour before, by suffix
        left[b[going]] = a[going]
        # A pair (p, q) goes on the pair (p-1, q-1) if the words before agree
        # and that pair are neighbours too: then its length is one less.
        p = b[going]
        q = a[going]
        back = (p > 0) & (q > 0)
        follows = np.zeros(p.size, bool)
        pb, qb = p[back] - 1, q[back] - 1
        follows[back] = (left[pb] == qb) & (words[pb] == words[qb]) & (owner[pb] == owner[p[back]]) & (owner[qb] == owner[q[back]])
        length = np.zeros(n, np.int64)
        live_p, live_q = p[~follows], q[~follows]
        heads = live_p
        k = np.zeros(heads.size, np.int64)
        at = np.arange(heads.size)
        while at.size:
            x, y = live_p[at] + k[at], live_q[at] + k[at]
            ok = (x < end[live_p[at]]) & (y < end[live_q[at]])
            ok[ok] = words[x[ok]] == words[y[ok]]
            at = at[ok]
            k[at] += 1
        length[heads] = k
        # The others take what their head leaves, by their distance from it.
        chained = np.sort(p)
        head_mark = np.zeros(n, bool)
        head_mark[heads] = True
        last_head = np.maximum.accumulate(np.where(head_mark, np.arange(n), -1))
        rest = chained[~head_mark[chained]]
        length[rest] = length[last_head[rest]] - (rest - last_head[rest])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        lcp[place[p]] = length[p]
    both = np.maximum(lcp[:-1], lcp[1:])  # with the one before, with the one after
    out = np.empty(n, np.int64)
    out[order] = both
    return out


def covered(shared: np.ndarray, sizes: np.ndarray, at_least: int) -> np.ndarray:
    """Words of each text inside a repeat of ``at_least`` words or more (union of all spans)."""
    n = shared.size
    if not n:
        return np.zeros(sizes.size, np.int64)
    reach = np.where(shared >= at_least, np.arange(n) + shared, 0)  # a span ends in its own text
    inside = np.maximum.accumulate(reach) > np.arange(n)
    return _sums(inside, sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def window_words(shared: np.ndarray, sizes: np.ndarray, width: int = 3) -> np.ndarray:
    """Words of each text inside a ``width``-word window that occurs twice or more."""
    n = shared.size
    if not n:
        return np.zeros(sizes.size, np.int64)
    reach = np.where(shared >= width, np.arange(n) + width, 0)
    return _sums(np.maximum.accumulate(reach) > np.arange(n), sizes)


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


COLUMNS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_covered_words",
    "longest_repeat",
)


def measure(texts: pa.Array, repeat_words: int = Limits.repeat_words) -> dict[str, np.ndarray]:
    """The columns of ``COLUMNS`` for an Arrow array of texts (binary); passages of ``repeat_words`` or more are covered."""
    out = {c: np.zeros(len(texts), np.int64) for c in COLUMNS}
    numbers, parts, sizes, first = _Numbers(), [], [], 0

    def close(upto: int) -> None:
        words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        size = np.array(sizes, np.int64)
        shared = longest_shared(words, size)
        out["n_repeat_words"][first:upto] = window_words(shared, size)
        out["n_covered_words"][first:upto] = covered(shared, size, repeat_words)
        if shared.size:
            some = size > 0
            ends = np.cumsum(size)
            at = (ends - size)[some]
            out["longest_repeat"][first:upto][some] = np.maximum.reduceat(shared, at)

    held = 0
    for i, t in enumerate(texts):
        raw = t.as_buffer().to_pybytes() if t.is_valid else b""
        words = raw.split()
        if held + len(words) > WORDS_AT_ONCE and held:
            close(i)
            numbers, parts, sizes, first, held = _Numbers(), [], [], i, 0
        sizes.append(len(words))
        held += len(words)
        if words:
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        data = np.frombuffer(raw, np.uint8)
        out["n_words"][i] = len(words)
        out["word_chars"][i] = np.count_nonzero(_FIRST[data]) - np.count_nonzero(_WHITE[data])
        out["n_symbols"][i] = np.count_nonzero(_SYMBOL[data])
        if b"\n" in raw:
            out["n_dup_lines"][i] = repeated_lines(raw)
    if sizes:
        close(len(texts))
    return out


def verdict(found: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """``(base_failed, kept)``."""
    n = found["n_words"]
    base = (n < limits.min_words) | (100 * found["n_repeat_words"] > limits.max_window_percent * n)
    repeats = (100 * found["n_covered_words"] > limits.max_covered_percent * n) | (
        (100 * found["longest_repeat"] > limits.max_longest_percent * n)
        & (found["longest_repeat"] >= 2 * limits.repeat_words)
    )
    return base, ~base & ~repeats


def repetition_rules(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: its id, the measures of ``COLUMNS``, ``base_failed`` and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(1), limits.repeat_words)
            base, kept = verdict(found, limits)
            cols = [batch.column(0), *[pa.array(found[c]) for c in COLUMNS], pa.array(base), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *COLUMNS, "base_failed", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS) + ", base_failed boolean, kept boolean"
    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass without a shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, kept = verdict(measure(batch.column(at).cast(pa.binary()), limits.repeat_words), limits)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
