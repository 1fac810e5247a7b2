"""Byte-level BPE over rank files, and back.

A text is cut by the pre-token pattern and each pre-token is looked up in two
tiers: a minimal perfect hash over the vocabulary's byte strings answers those
that are tokens themselves; any other is merged on a linked list of its bytes
with a heap of candidate pairs, lowest rank first, then leftmost: n log n
steps for n bytes.

The tables are built once on the driver from the rank file, whose size bounds
them, and broadcast. Each worker remembers what it has looked up, within ``REMEMBERED``
keys, so a frequent word is looked up once.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to nothing; bytes that aren't UTF-8 are read as U+FFFD; repeated rows
give repeated rows; an empty table gives an empty table; columns other than
the two named are not read. No special tokens: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED = 250_000
_hash = xxhash.xxh64_intdigest
#: Ids are packed as this machine's unsigned integers: little-endian ones.
assert sys.byteorder == "little" and array("I").itemsize == 4


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings to their values.

    Keys are dealt to buckets by one hash; each bucket, largest first, takes
    the first seed that sends all its keys to free slots. There are as many
    slots as keys. A string that isn't a key lands on some slot, so the slot's
    key is compared.
    """

    def __init__(self, items: dict[bytes, int]):
        keys = list(items)
        n = self.size = len(keys)
        self.n_buckets = max(1, (n + 1) // 2)
        buckets: list[list[bytes]] = [[] for _ in range(self.n_buckets)]
        for k in keys:
            buckets[_hash(k) % self.n_buckets].append(k)
        self.seeds = [0] * self.n_buckets
        self.slots: list[bytes | None] = [None] * n
        for b in sorted(range(self.n_buckets), key=lambda b: -len(buckets[b])):
            if len(buckets[b]) < 2:
                break
            seed = 1
            while True:
                at = {_hash(k, seed) % n for k in buckets[b]}
                if len(at) == len(buckets[b]) and all(self.slots[x] is None for x in at):
                    break
                seed += 1
            for k in buckets[b]:
                self.slots[_hash(k, seed) % n] = k
            self.seeds[b] = seed
        free = iter([x for x in range(n) if self.slots[x] is None])
        for b, members in enumerate(buckets):
            if len(members) == 1:  # a single key needs no search: its slot, as a negative seed
                x = next(free)
                self.slots[x] = members[0]
                self.seeds[b] = -1 - x
        self.values = [items[k] for k in self.slots]

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        if not self.size:
            return -1
        seed = self.seeds[_hash(key) % self.n_buckets]
        x = -1 - seed if seed < 0 else _hash(key, seed) % self.size
        return self.values[x] if self.slots[x] == key else -1


class Merger:
    """Merges byte pairs lowest rank first, leftmost first, until no two neighbours join to a token."""

    def __init__(self, tokens: list[bytes]):
        self.ranks = {t: r for r, t in enumerate(tokens) if t}
        self.one = [self.ranks.get(bytes([a])) for a in range(256)]
        self.two = [None] * 65536
        for t, r in self.ranks.items():
            if len(t) == 2:
                self.two[t[0] << 8 | t[1]] = r

    def __call__(self, piece: bytes) -> list[int]:
        n, get, two = len(piece), self.ranks.get, self.two
        one = self.one
        token = [one[a] for a in piece]  # rank of the part that starts here
        after = [*range(1, n + 1)]  # start of the next part; n: none
        before = [*range(-1, n - 1)]
        # pair[i]: rank of the part at i joined with the next; None: no token, or the part is gone.
        pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(None)
        heap = [r << 32 | i for i, r in enumerate(pair) if r is not None]  # by rank, then place
        heapify(heap)
        while heap:
            x = heappop(heap)
            i = x & 0xFFFFFFFF
            r = x >> 32
            if pair[i] != r:
                continue  # an entry from before one of its parts was merged
            j = after[i]
            token[i] = r
            pair[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = get(piece[i : after[k]])
                if r is not None:
                    heappush(heap, r << 32 | i)
            else:
                pair[i] = None
            h = before[i]
            if h >= 0:
                pair[h] = r = get(piece[h:k])
                if r is not None:
                    heappush(heap, r << 32 | h)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out


class Remembered(dict):
    """Remembers what ``make`` gave: two generations of ``REMEMBERED`` keys, the older dropped when the newer is full."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str):
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.pop(key, None)
        if found is None:
            found = self.make(key)
        if len(key) <= 64:
            self[key] = found
        return found


class Encoder:
    """Texts to packed ids: ``pattern`` cuts, ``encode`` gives the ids of one pre-token.

    The pattern never joins what stands before a single space between two
    words with what follows it, so texts are cut there first and the ids of a
    word with its space are remembered; white space of any other kind stays
    with the words around it.
    """

    def __init__(self, pattern: str, encode, code: str = "I"):
        self.find = regex.compile(pattern).findall
        self.encode = lambda token: array(code, encode(token)).tobytes()
        self.pretokens = Remembered(self.encode)
        self.words = Remembered(self._word)

    def _whole(self, text: str) -> bytes:
        return b"".join([self.pretokens[t] for t in self.find(text)])

    def _word(self, word: str) -> bytes:
        """Of a word and the space before it; nothing where the space isn't alone."""
        if not word or word[0].isspace() or word[-1].isspace():
            return b""
        if word.isascii() and word.isalpha():  # one pre-token
            return self.encode(" " + word)
        return self._whole(" " + word)

    def __call__(self, text: str) -> bytes:
        words = text.split(" ")
        first = words[0]
        lookup = self.words
        if first and not first[-1].isspace():
            found = [lookup[w] for w in words[1:]]
            if all(found):
                return self._whole(first) + b"".join(found)
        out, held = [], [first]  # held: words that white space between them keeps together
        for w in words[1:]:
            last = held[-1]
            ids = lookup[w] if last and not last[-1].isspace() else b""
            if ids:
                out.append(self._whole(" ".join(held)) if held[0] is not _DONE else b"")
                out.append(ids)
                held = [_DONE]
            elif held[0] is _DONE:
                held = ["", w]
            else:
                held.append(w)
        if held[0] is not _DONE:
            out.append(self._whole(" ".join(held)))
        return b"".join(out)


class _Done(str):
    """In place of words that are in ``out`` already; not white space."""


_DONE = _Done("x")


class Codec:
    """Encodes and decodes by ranks; small enough to broadcast (it holds the vocabulary)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.hash = PerfectHash(ranks)
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, r in ranks.items():
            self.tokens[r] = token

    def encoder(self) -> Encoder:
        """For one task. Neighbouring parts are looked up in a plain table of the same tokens."""
        whole, merge = self.hash.get, Merger(self.tokens)

        def encode(token: str) -> list[int]:
            raw = token.encode()
            r = whole(raw)
            return [r] if r >= 0 else merge(raw)

        return Encoder(self.pattern, encode)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


#: Of this worker process: what it has looked up serves its next task too.
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: ids as little-endian unsigned 32-bit integers, decoded the bytes."""
    return _coded(docs, path, pattern, id_col, text_col, False)


def encode_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    return _coded(docs, path, pattern, id_col, text_col, True)


def _coded(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    codec = docs.sparkSession.sparkContext.broadcast(Codec(read_ranks(path), pattern))
    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.value
        if (path, pattern) not in _ENCODERS:
            _ENCODERS[path, pattern] = c.encoder()
        encode = _ENCODERS[path, pattern]
        for batch in batches:
            n, packed, plain = [], [], []
            for t in batch.column(1):
                ids = encode(t.as_buffer().to_pybytes().decode("utf-8", "replace")) if t.is_valid else b""
                back = c.decode(np.frombuffer(ids, "<u4").tolist())
                n.append(len(ids) // 4)
                packed.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                plain.append(hashlib.sha256(back).hexdigest() if digests else back)
            kind = pa.string() if digests else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(packed, kind), pa.array(plain, kind)], names
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = "string" if digests else "binary"
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {names[2]} {kind}, {names[3]} {kind}")
