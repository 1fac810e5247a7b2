"""Token ids as wavelet matrices: one compressed file for each run of documents.

``WaveletMatrix`` keeps a sequence of ids as bit planes, highest bit first;
each plane is in the order that the planes above give (zeros before ones). A
directory of the ones before every block of a plane, made when the plane is
first asked, answers access and count (rank) with one or two steps down each
plane, and occurrence lookup (select) with the same way down and one search of
a directory a plane on the way up.

``write_shards`` encodes documents, deals them to shards by ranges of the id,
sorts each shard and writes its files, each of about ``TOKENS_PER_FILE`` ids,
whole documents only; ``read_shards`` reads them back.

File: magic, counts, then the sections document ids, document lengths, zeros
of each plane and the planes, each Zstandard-compressed behind its length.

Defined results: a null text counts as empty; every document ends with the
end id, so an empty one has that alone; null ids come first; documents of one
id are ordered by the crc of their ids, then by the ids; an empty table gives no file and an
empty result; columns other than the two named are not read. Documents are in
ascending id order over the files in name order. Ids are under ``2 ** 16``.
Strings of the tokenizer's added tokens (as ``<|endoftext|>``) get their ids, as
``Tokenizer.encode`` gives them.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.bpe import Encoder
from starmart.llm.common import quantiles, shared_folder, shuffle_partitions, stage

TOKENS_PER_FILE = 8_000_000
LEVELS = 16
MAGIC = b"WVMX0001"
_PIECE = 1 << 15  # ids that are dealt to zeros and ones at once
_BLOCK = 512  # bits between two entries of the rank directory
_NO_ID = -(1 << 63)  # stands for a null document id in a file


class WaveletMatrix:
    """Bit planes of a sequence of unsigned 16-bit ids."""

    def __init__(self, size: int, zeros: list[int], planes: list[np.ndarray]):
        self.size, self.zeros, self.planes = size, zeros, planes
        self._ones: list[np.ndarray | None] = [None] * LEVELS

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        x, ones = np.array(ids, np.uint16), np.empty(ids.size, np.uint16)
        zeros, planes = [], []
        for level in range(LEVELS):
            mask, plane, low, high = np.uint16(1 << (LEVELS - 1 - level)), np.empty((x.size + 7) // 8, np.uint8), 0, 0
            for at in range(0, x.size, _PIECE):  # small enough for the processor's cache
                some = x[at : at + _PIECE].copy()
                bit = (some & mask) != 0
                packed = np.packbits(bit, bitorder="little")
                plane[at // 8 : at // 8 + packed.size] = packed
                one, none = np.flatnonzero(bit), np.flatnonzero(~bit)
                some.take(one, out=ones[high : high + one.size], mode="clip")
                some.take(none, out=x[low : low + none.size], mode="clip")
                low, high = low + none.size, high + one.size
            x[low:] = ones[:high]
            planes.append(plane)
            zeros.append(low)
        return cls(ids.size, zeros, planes)

    def all(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        x, up = np.zeros(self.size, np.uint16), np.empty(self.size, np.uint16)
        for level in range(LEVELS - 1, -1, -1):
            mask, plane, low, high = np.uint16(1 << (LEVELS - 1 - level)), self.planes[level], 0, self.zeros[level]
            for at in range(0, x.size, _PIECE):
                some = up[at : at + _PIECE]
                bit = np.unpackbits(plane[at // 8 : at // 8 + _PIECE // 8], count=some.size, bitorder="little").view(bool)
                one, none = np.flatnonzero(bit), np.flatnonzero(~bit)
                some[none] = x[low : low + none.size]
                some[one] = x[high : high + one.size] | mask
                low, high = low + none.size, high + one.size
            x, up = up, x
        return x

    def _directory(self, level: int) -> np.ndarray:
        """Ones before every block of a plane, and all of them."""
        if self._ones[level] is None:
            counts = np.bitwise_count(self.planes[level]).astype(np.int64)
            sums = np.add.reduceat(counts, np.arange(0, counts.size, _BLOCK // 8)) if counts.size else counts
            self._ones[level] = np.concatenate(([0], np.cumsum(sums)))
        return self._ones[level]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane = self.planes[level]
        block, rest = divmod(i, _BLOCK)
        at = block * (_BLOCK // 8)
        whole, odd = divmod(rest, 8)
        n = int(self._directory(level)[block]) + int(np.bitwise_count(plane[at : at + whole]).sum())
        return n + (int(plane[at + whole]) & ((1 << odd) - 1)).bit_count() if odd else n

    def _select(self, level: int, bit: int, j: int) -> int:
        """The place of the ``j``-th (from 0) one, or zero, of a plane."""
        before = self._directory(level)
        if not bit:
            before = np.arange(before.size) * _BLOCK - before
        block = int(np.searchsorted(before, j, "right")) - 1
        at = block * (_BLOCK // 8)
        bits = np.unpackbits(self.planes[level][at : at + _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(bits == bit)[j - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level in range(LEVELS):
            bit = int(self.planes[level][i >> 3]) >> (i & 7) & 1
            ones = self._rank1(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where ``value``'s occurrences among the first ``i`` ids stand below the last plane."""
        a, b = 0, min(max(i, 0), self.size)
        for level in range(LEVELS):
            ones_a, ones_b = self._rank1(level, a), self._rank1(level, b)
            if value >> (LEVELS - 1 - level) & 1:
                a, b = self.zeros[level] + ones_a, self.zeros[level] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def count(self, value: int, i: int | None = None) -> int:
        """How often ``value`` stands among the first ``i`` ids (all)."""
        a, b = self._range(value, self.size if i is None else i)
        return b - a

    def occurrence(self, value: int, k: int) -> int:
        """The place of the ``k``-th (from 0) ``value``; -1 if there are fewer."""
        a, b = self._range(value, self.size)
        if not 0 <= k < b - a:
            return -1
        i = a + k
        for level in range(LEVELS - 1, -1, -1):
            bit = value >> (LEVELS - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i


def _section(raw: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=1).compress(raw)
    return struct.pack("<Q", len(packed)) + packed


def to_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    m = WaveletMatrix.build(ids)
    parts = [MAGIC, struct.pack("<QQ", len(doc_ids), m.size)]
    parts += [_section(x.tobytes()) for x in (np.asarray(doc_ids, "<i8"), np.asarray(lengths, "<i8"))]
    parts.append(_section(np.array(m.zeros, "<i8").tobytes()))
    parts += [_section(p.tobytes()) for p in m.planes]
    return b"".join(parts)


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """``(document ids, lengths with the end id, matrix)``."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    docs, size = struct.unpack_from("<QQ", data, 8)
    at, found = 24, []
    for _ in range(3 + LEVELS):
        n = struct.unpack_from("<Q", data, at)[0]
        found.append(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + n]))
        at += 8 + n
    zeros = np.frombuffer(found[2], "<i8").tolist()
    planes = [np.frombuffer(x, np.uint8) for x in found[3:]]
    doc_ids, lengths = np.frombuffer(found[0], "<i8"), np.frombuffer(found[1], "<i8")
    if len(doc_ids) != docs:
        raise ValueError("the file's counts disagree")
    return doc_ids, lengths, WaveletMatrix(size, zeros, planes)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


#: What the file must say of cutting texts into pre-tokens for ``public_tokenizers.PATTERN`` to be the same.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: ASCII marks that stand behind a word as one pre-token of their own, or together as one; not the apostrophe.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


#: Words of letters that a worker remembers at most; then it starts anew.
REMEMBERED_WORDS = 400_000


class _Words(dict):
    """Ids of words of letters with a space before them, remembered; of other words put together from them."""

    def __init__(self, letters: Callable[[str], bytes], other: Callable[[str], bytes]):
        super().__init__()
        self.letters, self.other = letters, other

    def __missing__(self, word: str) -> bytes:
        if not word.isalpha():
            return self.other(word)
        found = self.letters(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found


class WordEncoder(Encoder):
    """``Encoder`` for the pattern that byte-level vocabularies share: most words need no pattern to be cut.

    Letters are one pre-token with the space before them, marks behind them
    another; a single line end between two such words is one alone.
    """

    def __init__(self, pattern: str, encode, letters: Callable[[str], bytes], code: str = "I"):
        super().__init__(pattern, encode, code)
        self.words = _Words(letters, self.other)

    def other(self, word: str) -> bytes:
        """Of a word that is not letters alone."""
        core = word.rstrip(_MARKS)
        if core.isalpha():
            return self.words[core] + self.pretokens[word[len(core) :]]
        left, end, right = word.partition("\n")
        core = right.rstrip(_MARKS)
        if end and left and core.isalpha() and not left[-1].isspace():
            head = self.words[left]
            if head:
                marks = right[len(core) :]
                return head + self.pretokens[end] + self.pretokens[core] + (self.pretokens[marks] if marks else b"")
        return self._word(word)


#: Bytes of text whose words are looked up together, and ids that are put together at once.
TEXT_BYTES, IDS_AT_ONCE = 16_000_000, 1 << 20
#: Bytes of the words that a worker remembers as they stand, with their marks; beyond them it starts anew.
REMEMBERED_BYTES = 48_000_000


def _gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat``, one behind the other."""
    places = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    places += np.arange(places.size)
    return flat.take(places)


def _behind(words: pa.Array, sizes: pa.Array) -> pa.Array:
    """What stands behind the first bytes of each word."""
    if not len(words):
        return pa.array([], pa.binary())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    first = bounds[:-1] + np.asarray(sizes)
    more = bounds[1:] - first
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(
        pa.binary(),
        len(words),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(more))).astype(np.int32)), pa.py_buffer(_gathered(data, first, more))],
    )


class LibraryEncoder:
    """What ``Tokenizer.encode`` gives, as packed 16-bit ids, without its bookkeeping of offsets.

    Words go to the library's model, and are remembered. A text that holds the
    string of an added token goes to ``Tokenizer.encode`` whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = library = Tokenizer.from_file(path)
        if json.loads(library.to_str())["pre_tokenizer"] != _BYTE_LEVEL:
            raise ValueError(f"{path} does not cut texts as byte-level vocabularies do")
        tokenize, letters = library.model.tokenize, _byte_letters()
        space = letters[32]

        def ids(token: str) -> list[int]:
            if token.isascii() and token.isprintable():
                token = token.replace(" ", space)
            else:
                token = token.encode().decode("latin-1").translate(letters)
            return [t.id for t in tokenize(token)]

        def word(w: str) -> bytes:
            """Of letters with a space before them."""
            if not w.isascii():
                w = w.encode().decode("latin-1").translate(letters)
            found = [t.id for t in tokenize(space + w)]
            return pack[len(found)](*found) if len(found) < len(pack) else array("H", found).tobytes()

        pack = [struct.Struct(f"<{n}H").pack for n in range(24)]
        self.plain = WordEncoder(public_tokenizers.PATTERN, ids, word, "H")
        self._forget()
        self.added = [t.content for t in library.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return self.plain(text)

    def batch(self, texts: pa.Array, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts with ``end`` behind each: ``(ids, length of each text)``, in runs of whole texts."""
        texts = texts.fill_null("")
        ends = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + TEXT_BYTES, "right")))
            yield from self._together(texts.slice(at, to - at), end)
            at = to

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.lengths, self.begins, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u2")

    def _with(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, begins and ids of the remembered words and, behind them, of ``found``."""
        more = np.fromiter(map(len, found), np.int64, len(found)) // 2
        begins = self.flat.size + np.cumsum(more) - more
        flat = np.concatenate((self.flat, np.frombuffer(b"".join(found), "<u2")))
        return np.concatenate((self.lengths, more)), np.concatenate((self.begins, begins)), flat

    def _places(self, different: pa.Array) -> np.ndarray:
        """Where each word stands among the remembered ones; new ones are encoded and remembered."""
        if self.known.nbytes > REMEMBERED_BYTES:
            self._forget()
        place = pc.index_in(different, value_set=self.known)
        new = different.filter(place.is_null())
        places = np.asarray(place.fill_null(-1)).astype(np.int64)
        places[places < 0] = len(self.known) + np.arange(len(new))
        # Letters with marks behind them: the letters are a word of their own, looked up once.
        core = pc.ascii_rtrim(new, characters=_MARKS)
        size = pc.binary_length(core)
        marks = _behind(new, size)
        core, marks = core.dictionary_encode(), marks.dictionary_encode()
        cores = core.dictionary.to_pylist()
        simple = np.fromiter(map(str.isalpha, cores), bool, len(cores))
        which, mark = np.asarray(core.indices), np.asarray(marks.indices)
        joined = simple[which]
        letters, pretokens, other = self.plain.words, self.plain.pretokens, self.plain.other
        found = [letters[w] if a else b"" for w, a in zip(cores, simple)]
        found += [pretokens[m.decode()] if m else b"" for m in marks.dictionary.to_pylist()]
        odd = new.filter(pa.array(~joined)).to_pylist()
        found += [other(w) for w in odd]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        at = np.cumsum(sizes) - sizes
        # Two parts a word: the letters and the marks, or the word as it stands and nothing.
        parts = np.empty((len(new), 2), np.int64)
        parts[:, 0], parts[:, 1] = which, len(cores) + mark
        parts[~joined, 0] = len(found) - len(odd) + np.arange(len(odd))
        each = sizes[parts]
        each[~joined, 1] = 0
        ids = _gathered(np.frombuffer(b"".join(found), "<u2"), at[parts].ravel(), each.ravel())
        more = each.sum(axis=1)
        self.begins = np.concatenate((self.begins, self.flat.size + np.cumsum(more) - more))
        self.lengths = np.concatenate((self.lengths, more))
        self.flat = np.concatenate((self.flat, ids))
        self.known = pa.concat_arrays([self.known, new])
        return places

    def _together(self, texts: pa.Array, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Looks up each different word of the texts once, then takes the ids of all words by place."""
        n = len(texts)
        words = pc.split_pattern(texts, " ")
        bounds = np.asarray(words.offsets).astype(np.int64)
        words_at = bounds[:-1]
        coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        codes = self._places(coded.dictionary)[np.asarray(coded.indices)]
        # White space beyond single spaces keeps words together: such a text is encoded by itself.
        alone = np.zeros(n, bool)
        misfits = np.flatnonzero(self.lengths[codes] == 0)
        text_of = np.searchsorted(bounds, misfits, "right") - 1
        alone[text_of[misfits != bounds[text_of]]] = True
        for a in self.added:
            alone |= np.asarray(pc.match_substring(texts, a))
        # The first word of a text has no space before it, and is its own entry; so is a text by itself.
        whole, found = self.plain._whole, []
        for i, word in enumerate(words.values.take(pa.array(words_at)).to_pylist()):
            alone[i] |= not word or word[-1].isspace()
            found.append(self(texts[i].as_py()) if alone[i] else whole(word))
        found.append(struct.pack("<H", end))
        remembered = self.lengths.size
        lengths, begins, flat = self._with(found)
        # Entries of every text in their order: the first, the other words, the end.
        counts = np.where(alone, 1, np.diff(bounds))
        keep = np.ones(codes.size, bool)
        for i in np.flatnonzero(alone):
            keep[bounds[i] + 1 : bounds[i + 1]] = False
        last = np.cumsum(counts + 1) - 1
        entries = np.empty(int(counts.sum()) + n, np.int64)
        inner = np.ones(entries.size, bool)
        inner[last] = False
        entries[inner] = codes[keep]
        entries[last - counts] = remembered + np.arange(n)
        entries[last] = remembered + n
        sizes = np.add.reduceat(lengths[entries], last - counts)
        sums = np.cumsum(sizes)
        at = 0
        while at < n:
            done = sums[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sums, done + IDS_AT_ONCE, "right")))
            some = entries[last[at] - counts[at] : last[to - 1] + 1]
            yield _gathered(flat, begins[some], lengths[some]), sizes[at:to]
            at = to


def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


#: Of this worker process.
_ENCODERS: dict[str, LibraryEncoder] = {}


def _strings(raw: pa.Array) -> pa.Array:
    """Bytes as text; what is no UTF-8 becomes U+FFFD."""
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if x is None else x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def shards_of(cuts: np.ndarray, ids: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The shard of each document; those of an id that several cuts name are dealt to all its shards, in order of crc."""
    first = np.searchsorted(cuts, ids, "left")
    spread = np.searchsorted(cuts, ids, "right") - first + 1
    return (first + (crc * spread >> 32)).astype(np.int32)


def encoded(docs: DataFrame, path: str, bounds: list[int], end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``(shard, doc_id, crc, ids)``: ids with the end id, little-endian unsigned 16 bit."""
    cuts = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = library_encoder(path)
        encode = _ENCODERS[path]
        for batch in batches:
            at, texts = 0, _strings(batch.column(1))
            for ids, sizes in encode.batch(texts, end_id):
                key = batch.column(0).slice(at, sizes.size)
                at += sizes.size
                ends = np.concatenate(([0], np.cumsum(sizes * 2)))
                raw = memoryview(ids).cast("B")
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])), np.int64, sizes.size)
                packed = pa.Array.from_buffers(
                    pa.binary(), sizes.size, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)]
                )
                shard = shards_of(cuts, np.asarray(key.fill_null(_NO_ID)), crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), key, pa.array(crc), packed], ["shard", "doc_id", "crc", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "shard int, doc_id long, crc long, ids binary")


def _writer(folder: str, tokens_per_file: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        # The folder has its scheme: a store that is not reached raises here, and no task writes to its own disk.
        files, root = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        shard, seq, held, ids, size = None, 0, [], [], 0

        def close() -> dict:
            data = to_bytes(
                np.array([_NO_ID if d is None else d for d in held], np.int64),
                np.array([len(x) // 2 for x in ids], np.int64),
                np.frombuffer(b"".join(ids), "<u2"),
            )
            # The same documents give the same file: a task that runs again
            # replaces it by an equal one, and a rename shows no half of it.
            name = f"{shard:08d}-{seq:08d}.wm"
            part = f"{root}/.{name}-{uuid.uuid4().hex}"
            with files.open_output_stream(part) as f:
                f.write(data)
            files.move(part, f"{root}/{name}")
            return {"name": name, "shard": shard, "seq": seq, "n_docs": len(held), "n_tokens": size}

        made = []
        for batch in batches:
            shards = batch.column(0).to_pylist()
            keys = batch.column(1).to_pylist()
            for s, d, x in zip(shards, keys, batch.column(3)):
                raw = x.as_buffer().to_pybytes()
                n = len(raw) // 2
                if held and (s != shard or size + n > tokens_per_file):
                    made.append(close())
                    seq = seq + 1 if s == shard else 0
                    held, ids, size = [], [], 0
                shard = s
                held.append(d)
                ids.append(raw)
                size += n
        if held:
            made.append(close())
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_MANIFEST)

    return run


_MANIFEST = pa.schema(
    [("name", pa.string()), ("shard", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)


def write_shards(
    docs: DataFrame,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_per_file: int = TOKENS_PER_FILE,
) -> tuple[str, DataFrame]:
    """Writes the files to a fresh shared folder: ``(folder, manifest)``.

    There are as many shards as shuffle partitions, cut at quantiles of the id
    (that many numbers on the driver); null ids, or the rows of one id, that are
    more than a shard are split by crc. Only ids of two bytes a token are
    shuffled, never texts.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    known = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("k"))
    cuts = quantiles(known, ["k"], [i / n for i in range(1, n)])["k"]
    rows = encoded(docs, path, cuts, end_id, id_col, text_col)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(hadoop)
    folder = store.makeQualified(hadoop).toString()
    order = ["shard", F.col("doc_id").asc_nulls_first(), "crc", "ids"]
    made = rows.repartitionById(n, F.col("shard")).sortWithinPartitions(*order)
    manifest = stage(
        made.mapInArrow(
            _writer(folder, tokens_per_file), "name string, shard int, seq int, n_docs long, n_tokens long"
        )
    )
    return folder, manifest


def starts(manifest: DataFrame) -> DataFrame:
    """``(name, start)``: ids in all files before, in name order.

    Sums of each shard are one row for each shuffle partition; files are
    added up inside their shard.
    """
    spark = manifest.sparkSession
    sums = sorted(tuple(r) for r in manifest.groupBy("shard").agg(F.sum("n_tokens")).collect())
    before, at = [], 0
    for shard, n in sums:
        before.append((shard, at))
        at += n
    first = spark.createDataFrame(before, "shard int, first long")
    w = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
        .join(F.broadcast(first), "shard")
        .select("name", (F.col("first") + F.col("inside")).alias("start"))
    )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["name", "doc_id", "inside", "n_tokens", "ids_crc32"]
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            doc_ids, lengths, matrix = from_bytes(data.as_buffer().to_pybytes())
            ids = matrix.all()
            ends = np.cumsum(lengths)
            begins = ends - lengths
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
            key = pa.array(doc_ids, pa.int64(), mask=doc_ids == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(key)), key, pa.array(begins), pa.array(lengths), pa.array(crc, pa.int64())], names
            )


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(f"{folder}/*.wm")
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    rows = named.mapInArrow(_reader, "name string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    place = (F.col("start") + F.col("inside")).alias("start")
    return rows.join(stage(starts(manifest)), "name").select("doc_id", place, "n_tokens", "ids_crc32")
