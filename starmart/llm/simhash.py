"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links.

* ``fingerprints`` — 64 bits per text from XXH64 (seed 42) of its word
  shingles, in one pass over the texts.
* ``link_fingerprints`` — of 64 bits in ``blocks`` runs, two fingerprints
  at most ``distance`` bits apart have at least ``blocks - distance`` whole
  runs in common. Every choice of so many runs is one key; fingerprints that
  share a key meet in a bucket and links are verified there bit by bit. Only
  distinct fingerprints are dealt out, and a bucket gives a spanning forest of
  its links, not its pairs: at most one link for each fingerprint in it. A
  bucket over ``BUCKET`` fingerprints is cut in chunks, and each two chunks
  meet in a task of their own, so that no task holds more than two chunks.
* ``near_duplicates`` — connected components of these links.

Defined results: a null text counts as empty; a text without words has
fingerprint 0, linked like any other; repeated rows give repeated rows; null
ids stay null and a component's id is its smallest id that isn't null; an
empty table gives an empty table; columns other than the two named are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import one_row_each, stage, text_of
from starmart.llm.components import components

SEED = 42
#: Fingerprints of one bucket that a task compares at once.
BUCKET = 8192
#: Random fingerprints that a bucket holds on average at most, before another block makes its keys longer.
LOAD = 1024
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each run of ``words`` words, A-Z lower-cased, one space between."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]


def fingerprint(text: bytes, words: int) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes."""
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # 4 MB of bits at a time
        some = np.array(hashes[at : at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)``: fp is the fingerprint as a signed long, text_hash XXH64 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in batch.column(2)]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """One mask for each choice of ``blocks - distance`` of the runs."""
    if not distance < blocks <= 64:
        raise ValueError("blocks must be over distance and at most 64")
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    runs = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(runs, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_keys(fps: DataFrame, masks: list[int]) -> DataFrame:
    """``(j, bits, fp)``: a row for each fingerprint and mask."""
    entry: list[Column] = [
        F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits"))
        for j, m in enumerate(masks)
    ]
    return fps.select("fp", F.explode(F.array(*entry)).alias("k")).select("k.j", "k.bits", "fp")


def bits_apart(x: np.ndarray, y: np.ndarray | np.int64) -> np.ndarray:
    """Of signed 64-bit numbers (bitwise_count alone would count those of the absolute value)."""
    return np.bitwise_count((x ^ y).view(np.uint64))


def forest(fps: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that connect what pairs within ``distance`` bits connect.

    Grows one component at a time: a member is compared with the fingerprints
    that are in none yet, so a tight group of g costs about g steps.
    """
    left, a, b = fps, [], []
    while left.size > 1:
        front, left = [left[0]], left[1:]
        while front and left.size:
            c = front.pop()
            near = bits_apart(left, c) <= distance
            if near.any():
                new = left[near]
                left = left[~near]
                front.extend(new)
                a.extend([int(c)] * new.size)
                b.extend(new.tolist())
    return a, b


def bucket_links(distance: int, limit: int | None):
    """For mapInArrow over rows sorted by bucket: verified links, and the buckets over ``limit``."""
    names = ["u", "v", "over", "n"]

    def links_of(fp: np.ndarray, bounds: np.ndarray, u: list, v: list) -> None:
        sizes = np.diff(bounds)
        run = np.repeat(np.arange(sizes.size), sizes)
        small = sizes[run] <= 4
        for d in (1, 2, 3):  # small buckets all at once
            if fp.size <= d:
                break
            x, y = fp[:-d], fp[d:]
            hit = (run[:-d] == run[d:]) & small[:-d] & (bits_apart(x, y) <= distance)
            u.extend(x[hit].tolist())
            v.extend(y[hit].tolist())
        for k in np.flatnonzero(sizes > 4):
            a, b = forest(fp[bounds[k] : bounds[k + 1]], distance)
            u.extend(a)
            v.extend(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: tuple | None = None  # of the bucket that isn't ended yet
        held: list[np.ndarray] = []
        count = 0

        def out(u: list, v: list, over: list) -> pa.RecordBatch:
            none = [None] * len(u)
            cols = [
                pa.array(u + [o[1] for o in over], pa.int64()),
                pa.array(v + [None] * len(over), pa.int64()),
                pa.array(none + [o[0] for o in over], pa.int32()),
                pa.array(none + [o[2] for o in over], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(cols, names)

        def close(u: list, v: list, over: list) -> None:
            if limit is not None and count > limit:
                over.append((keys[0], keys[1], count))
            elif count > 1:
                fp = np.concatenate(held)
                links_of(fp, np.array([0, fp.size]), u, v)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = [np.asarray(batch.column(i)) for i in range(batch.num_columns - 1)]
            fp = np.asarray(batch.column(batch.num_columns - 1)).view(np.int64)
            change = np.zeros(fp.size, bool)
            for k in key:
                change[1:] |= k[1:] != k[:-1]
            change[0] = keys is None or keys != tuple(int(k[0]) for k in key)
            bounds = np.append(np.flatnonzero(change), fp.size)
            u, v, over = [], [], []
            first = bounds[0]  # rows before it go on with the bucket held
            if first:
                count += int(first)
                if limit is None or count <= limit:
                    held.append(fp[:first])
                else:
                    held = []
            if bounds.size > 1:
                if keys is not None:
                    close(u, v, over)
                whole, last = bounds[:-1], bounds[-2]
                if limit is not None and whole.size > 1 and np.diff(whole).max() > limit:
                    for x, y in zip(whole[:-1], whole[1:]):
                        if y - x > limit:
                            over.append((int(key[0][x]), int(key[1][x]), int(y - x)))
                        else:
                            links_of(fp[x:y], np.array([0, y - x]), u, v)
                elif whole.size > 1:
                    links_of(fp[whole[0] : last], whole - whole[0], u, v)
                keys, held, count = tuple(int(k[last]) for k in key), [fp[last:]], int(fp.size - last)
            yield out(u, v, over)
        if keys is not None:
            u, v, over = [], [], []
            close(u, v, over)
            yield out(u, v, over)

    return run


_LINKS = "u long, v long, over int, n long"


def link_fingerprints(fps: DataFrame, distance: int, blocks: int, bucket: int = BUCKET) -> DataFrame:
    """``fps(fp)``, distinct → ``(u, v)``: verified links that connect all that are linked."""
    keyed = bucket_keys(fps, block_masks(blocks, distance))
    found = stage(
        keyed.repartition("j", "bits").sortWithinPartitions("j", "bits").mapInArrow(bucket_links(distance, bucket), _LINKS)
    )
    links = found.where("over is null").select("u", "v")
    crowded = found.where("over is not null").select(F.col("over").alias("j"), F.col("u").alias("bits"), "n")
    if crowded.isEmpty():
        return links
    # Buckets over the limit: chunk a meets chunk b in a task of their own.
    s, mine, other = F.col("s"), F.col("c"), F.col("i")
    cut = (
        keyed.join(crowded, ["j", "bits"])
        .withColumn("s", F.ceil(F.col("n") / F.lit(bucket)).cast("int"))
        .withColumn("c", F.pmod(F.xxhash64("fp"), s).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), s - 1)))
        .select("j", "bits", F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b"), "fp")
        .repartition("j", "bits", "a", "b")
        .sortWithinPartitions("j", "bits", "a", "b")
    )
    more = stage(cut.mapInArrow(bucket_links(distance, None), _LINKS))
    return links.unionByName(more.select("u", "v"))


def blocks_for(distinct: int, distance: int, load: int = LOAD) -> int:
    """The fewest blocks, two over ``distance`` at least, whose keys put ``load`` random fingerprints in a bucket at most."""
    for blocks in range(distance + 2, 64):
        cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
        bits = sum(sorted(b - a for a, b in zip(cuts, cuts[1:]))[: blocks - distance])
        if distinct <= load << bits:
            return blocks
    return 64


def components_of(fps: DataFrame, distance: int, blocks: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """``fps(doc_id, fp, ...)`` → ``(fp, root, component_id)``, one row for each fingerprint."""
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    blocks = blocks or blocks_for(classes.count(), distance)
    links = link_fingerprints(classes.select("fp"), distance, blocks, bucket)
    linked = stage(components(links).select(F.col("node").alias("fp"), "root"))
    members = stage(linked.join(classes, "fp").select("fp", "root", "least"))
    ids = stage(members.groupBy("root").agg(F.min("least").alias("component_id")))
    named = members.join(ids, "root").select("fp", "root", "component_id")
    alone = classes.join(linked, "fp", "left_anti").select("fp", F.col("fp").alias("root"), "least")
    return stage(named.unionByName(alone.withColumnRenamed("least", "component_id")))


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    distance: int = 4,
    blocks: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket: int = BUCKET,
) -> DataFrame:
    """One row a document: ``doc_id, fingerprint, component_id``.

    ``blocks`` sets the work, never the result: a key has about
    ``64 * (blocks - distance) / blocks`` bits (6: 21, 7: 27, 8: 32), and a
    random pair meets with that chance. None: ``blocks_for`` the distinct fingerprints.
    """
    fps = stage(fingerprints(docs, words, id_col, text_col).select("doc_id", "fp"))
    found = components_of(fps, distance, blocks, bucket)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(found, "fp").select("doc_id", hexed, "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    words: int = 4,
    distance: int = 4,
    blocks: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest id.

    Null ids come last; rows of one id that differ in text are told apart by
    XXH64 of the text, the smallest stays; equal rows count as one.
    """
    fps = stage(fingerprints(docs, words, id_col, text_col))
    found = components_of(fps, distance, blocks)
    keys = fps.join(found, "fp").groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    keys = stage(keys)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")).alias("best")
    best = stage(keys.groupBy("root").agg(first, F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"))
    stays = F.col("best").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    )
    verdicts = keys.join(best, "root", "left").select("doc_id", "text_hash", "n", stays.alias("stays"))
    marked = docs.withColumns({"__key_id": F.col(id_col).cast("long"), "__key_text": F.xxhash64(text_of(text_col))})
    verdicts = verdicts.select(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_text"), "n", "stays")
    return one_row_each(marked, verdicts, ["__key_id", "__key_text"]).drop("__key_id", "__key_text")
