"""Operators on documents: edge rows, empty tables and brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import bpe, components, exact_dedup, hilbert, mixing, repetition, simhash, wavelet
from starmart.llm import queries
from starmart.llm.common import quantiles
from tests.llm import brute

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = P.path("byte_bpe_50k.json")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("table", ["edge", "given"])
def test_simhash_is_brute_force(request, table):
    df = request.getfixturevalue(table)
    rows = pairs(df)
    assert bag(simhash.near_duplicates(df).collect()) == bag(brute.components(rows))


def test_simhash_crowded_buckets_and_other_blocks(spark):
    r = random.Random(3)
    centre = r.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:  # a tight group, a chain away from it, and noise
        fps.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 3))))
    x = centre
    for _ in range(40):
        x ^= 1 << r.randrange(64) | 1 << r.randrange(64)
        fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(300)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4)

    def groups(links):
        parent = {f: f for f in fps}

        def find(a):
            while parent[a] != a:
                a = parent[a]
            return a

        for a, b in links:
            assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
            parent[find(a)] = find(b)
        out = defaultdict(set)
        for f in fps:
            out[find(f)].add(f)
        return sorted(map(sorted, out.values()))

    wanted = groups([(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    for blocks, bucket in ((6, 8192), (6, 50), (5, 8192), (8, 64)):
        links = simhash.link_fingerprints(df, 4, blocks, bucket).collect()
        assert groups([tuple(x) for x in links]) == wanted
    found = {r.node: r.root for r in components.components(simhash.link_fingerprints(df, 4, 6)).collect()}
    assert all(found.get(f, f) == min(g) for g in wanted for f in g)


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "u long, v long")
    found = {r.node: r.root for r in components.components(df).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert components.components(df.limit(0)).count() == 0


def test_drop_near_duplicates_keeps_one_of_each(edge, empty):
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    rows = pairs(kept)
    comp = {(d, t): c for (d, t), (_, _, c) in zip(pairs(edge), brute.components(pairs(edge)))}
    groups = brute.components(pairs(edge))
    # Id 12 names two components: two texts have it.
    assert len(rows) == len({(c, f if c is None else None) for _, f, c in groups}) + 1
    assert all(comp[r] == r[0] for r in rows)
    assert simhash.drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("table", ["edge", "given"])
def test_exact_duplicates_are_brute_force(request, table):
    df = request.getfixturevalue(table)
    rows = pairs(df)
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    wanted = []
    for t, ids in groups.items():
        ids.sort(key=lambda d: (d is not None, d or 0), reverse=True)
        wanted += [(d, ids[0], len(ids), i == 0, brute.sha(t)) for i, d in enumerate(ids)]
    assert bag(exact_dedup.exact_duplicates(df, digest_all=True).collect()) == bag(wanted)
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(list(groups))
    assert {(r.doc_id, r.text or "") for r in kept.collect()} == {(g[1], t) for t, ids in groups.items() for g in [(0, ids[0])]}


def test_exact_digest_only_where_needed(edge):
    found = exact_dedup.exact_duplicates(edge).collect()
    assert {r.text_sha256 is None for r in found if r.group_size == 1} == {True}
    assert all(r.text_sha256 for r in found if r.group_size > 1)


@pytest.mark.parametrize("table", ["edge", "given"])
def test_bpe_is_the_library_and_round_trips(request, table):
    import tiktoken

    df = request.getfixturevalue(table)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    wanted = []
    for d, t in pairs(df):
        ids = lib.encode_ordinary(t or "")
        wanted.append((d, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    found = bpe.encode_documents(df, RANKS, P.PATTERN).collect()
    assert bag((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in found) == bag(wanted)


def test_perfect_hash_is_minimal_and_tells_strangers():
    items = {f"key{i}".encode(): i for i in range(3000)}
    h = bpe.PerfectHash(items)
    assert len(h.slots) == len(items) and None not in h.slots
    assert all(h.get(k) == v for k, v in items.items())
    assert {h.get(f"other{i}".encode()) for i in range(3000)} == {-1}
    assert bpe.PerfectHash({}).get(b"x") == -1


def test_encoder_odd_white_space_and_forgetting(monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    ranks = bpe.read_ranks(RANKS)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = bpe.Codec(ranks, P.PATTERN).encoder()
    r = random.Random(5)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "1", "é", "\xa0", "　", "!", "\x1c", "\x85", "😀"]
    for _ in range(5000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(encode(t), "<u4").tolist() == lib.encode_ordinary(t)


@pytest.mark.parametrize("table", ["edge", "given"])
def test_repetition_is_brute_force(request, table):
    df = request.getfixturevalue(table).where("text is null or length(text) < 6000")
    cols = ["doc_id", *repetition.COLUMNS]
    wanted = [(d, *brute.repetition(t)) for d, t in pairs(df)]
    found = repetition.repetition_rules(df)
    assert bag(found.select(cols).collect()) == bag(wanted)


def test_suffix_array_on_random_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(repetition, "WORDS_AT_ONCE", 300)
    r = random.Random(11)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(60)]
    texts += ["a " * 150, "x y z " * 40, " ".join(map(str, range(50))) + " " + " ".join(map(str, range(50)))]
    found = repetition.measure(pa.array([t.encode() for t in texts], pa.binary()))
    for i, t in enumerate(texts):
        assert tuple(int(found[c][i]) for c in repetition.COLUMNS) == brute.repetition(t), t


def test_repetition_rules_keep_clean_and_reject_repeats(spark):
    clean = " ".join(f"word{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {1: clean, 2: f"{passage} middle of it {passage}", 3: "too short", 4: None, 5: "one two three " * 50}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id: (r.base_failed, r.kept) for r in repetition.repetition_rules(df).collect()}
    assert kept == {1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False), 5: (True, False)}
    half = spark.createDataFrame([(6, f"{passage} {clean} {passage} {clean.replace('word', 'x')}")], "doc_id long, text string")
    row = repetition.repetition_rules(half, repetition.Limits(max_covered_percent=20)).first()
    assert (row.base_failed, row.kept, row.n_covered_words, row.longest_repeat) == (False, False, 120, 60)
    assert [r.doc_id for r in repetition.keep_clean(df).collect()] == [1]


def test_repetition_covers_what_the_limits_say(spark):
    passage = "six words that come back again"
    text = f"{passage} {' '.join(f'w{i}' for i in range(80))} {passage}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for least, covered in ((5, 12), (6, 12), (7, 0)):
        limits = repetition.Limits(repeat_words=least, max_covered_percent=10)
        row = repetition.repetition_rules(df, limits).first()
        assert row.n_covered_words == covered == brute.repetition(text, least)[5]
        assert row.kept == (covered == 0) == (repetition.keep_clean(df, limits).count() == 1)


@pytest.mark.parametrize("table", ["edge", "given"])
def test_hilbert_shards(request, table):
    df = request.getfixturevalue(table)
    dims = [hilbert.text_key("source"), hilbert.text_key("lang"), F.col("n_chars")]
    rows = hilbert.shard_rows(df, dims, 16, [F.col("doc_id")]).select("doc_id", "hilbert", "shard", "slot").collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == df.count() and max(counts.values()) - min(counts.get(s, 0) for s in range(16)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_hilbert_tells_sources_of_one_beginning(spark, tmp_path):
    rows = [(i, "same text", "en", f"common_crawl_{2000 + i % 16}", 9) for i in range(320)] + [(400, "x", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ranks = {r.source: r.k for r in hilbert.with_text_rank(docs, "source", "k").collect()}
    assert ranks == {None: None, **{f"common_crawl_{2000 + i}": i for i in range(16)}}
    out = queries.op7_hilbert_shards(spark, str(tmp_path)).join(docs.select("doc_id", "source"), "doc_id")
    assert out.count() == len(rows)
    ranges = hilbert.manifest(out, ["source"])
    wanted = hilbert.matching(ranges, source=("common_crawl_2000", "common_crawl_2000")).count()
    assert wanted < ranges.count() == 16


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = hilbert.hilbert_index(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        path = grid[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_hilbert_manifest_prunes(spark, given):
    dims = [F.col("n_chars"), F.col("doc_id")]
    placed = hilbert.shard_rows(given, dims, 16)
    ranges = hilbert.manifest(placed, ["n_chars", "doc_id"]).collect()
    need = {r.shard for r in hilbert.matching(hilbert.manifest(placed, ["n_chars"]), n_chars=(0, 400)).collect()}
    assert {r.shard for r in placed.where("n_chars <= 400").select("shard").distinct().collect()} <= need
    assert len(need) < len(ranges) == 16


@pytest.mark.parametrize("table", ["edge", "given"])
def test_mix_targets_and_taken(request, table):
    df = request.getfixturevalue(table)
    sizes = defaultdict(int)
    for r in df.select("source", "text").collect():
        sizes[r.source] += len(brute.words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    wanted = brute.targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count() and bag(rows) == bag(mixing.mix(df).collect())
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    # Half of what falls on one hash, which repeated rows share: two rows of one text here.
    assert all(abs(t - taken[s]) <= largest[s] + 1 for s, t in wanted.items())
    ids = Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    copies = Counter()
    for r in rows:
        copies[r.doc_id] += r.copies
    assert ids == +copies


def test_no_document_is_mixed_beyond_the_cap(spark):
    rows = [(i, "", "a") for i in range(200)] + [(200, "ten words " * 5, "a"), (201, None, "a")]
    rows += [(300 + i, f"word{i} " * 40, "b") for i in range(30)] + [(400 + i, None, "c") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    mixed = mixing.mix(df, share_percent=150, max_epochs=2).collect()
    assert max(r.copies for r in mixed) == 2 and len(mixed) == len(rows)
    assert {r.copies for r in mixed if r.source == "a"} == {2}  # at its cap: twice, and none a third time
    assert {r.copies for r in mixed if r.source == "c"} == {0}  # a source without words
    taken = Counter(r.doc_id for r in mixing.mixed_documents(df, share_percent=150, max_epochs=2).collect())
    assert taken == +Counter({r.doc_id: r.copies for r in mixed})


@pytest.mark.parametrize("table", ["edge", "given"])
def test_wavelet_files_are_the_library(request, spark, table):
    import zlib

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(LIBRARY)
    df = request.getfixturevalue(table)
    coded = []
    for d, t in pairs(df):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        # Documents of one id are ordered by the crc of their 16-bit ids.
        coded.append((d is not None, d or 0, zlib.crc32(ids.astype("<u2").tobytes()), len(ids), zlib.crc32(ids.tobytes())))
    wanted, at = [], 0
    for known, d, _, n, crc in sorted(coded):
        wanted.append((d if known else None, at, n, crc))
        at += n
    folder, manifest = wavelet.write_shards(df, LIBRARY, tokens_per_file=5000)
    assert manifest.count() > 3
    assert bag(wavelet.read_shards(spark, folder, manifest).collect()) == bag(wanted)


def test_wavelet_query_knows_added_tokens(spark, tmp_path):
    import zlib

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(LIBRARY)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n y <|endoftext", "no marker  here", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert lib.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    wanted, at = [], 0
    for d, t in enumerate(texts):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        wanted.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert bag(queries.op9_wavelet(spark, str(tmp_path)).collect()) == bag(wanted)


def test_wavelet_words_are_cut_as_the_library_cuts_them():
    from tokenizers import Tokenizer

    lib, encode = Tokenizer.from_file(LIBRARY), wavelet.library_encoder(LIBRARY)
    r = random.Random(11)
    letters = ["a", "Word", "über", "東京", "²", "٣", "9", "e\u0301", ".", ",", "'s", "'", "it's", "#", "_", "…", "!?", "(", "\n", "\n\n", "\r\n", " ", "  ", "\t", "\x1c", "\xa0", "\u3000", "😀", "<|endoftext|>"]
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 14))) for _ in range(6000)]
    texts += [f"{a}{b}{c}{d}" for a in letters for b in ("\n", ".\n", "\n.") for c in letters for d in ("", ",", " x")]
    for t in texts:
        assert np.frombuffer(encode(t), np.uint16).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_wavelet_batches_give_what_single_texts_give(monkeypatch):
    import random

    rng, encode = random.Random(3), wavelet.library_encoder(LIBRARY)
    pieces = ["word", "Word,", "a", "\n", "\n\n", "  ", " ", "12", "don't", "é", "日本", "<|endoftext|>", "x.\ny", "\t", "\u00a0", ""]
    texts = [None, "", " ", "\n", "one", " lead", "trail ", "a  b"]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    wanted = [np.frombuffer(encode(t or ""), "<u2").tolist() + [7] for t in texts]
    for text_bytes, at_once, remembered in ((8_000_000, 1 << 20, 1 << 20), (300, 50, 400), (1, 1, 0)):
        monkeypatch.setattr(wavelet, "REMEMBERED_BYTES", remembered)
        monkeypatch.setattr(wavelet, "TEXT_BYTES", text_bytes)
        monkeypatch.setattr(wavelet, "IDS_AT_ONCE", at_once)
        found = []
        for part in (pa.array(texts, pa.string()), pa.array([], pa.string()), pa.array(texts * 2, pa.string()).slice(5, 9)):
            for ids, sizes in encode.batch(part, 7):
                found += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert found == wanted + (wanted * 2)[5:14]


def test_wavelet_shards_split_an_id_that_is_more_than_one():
    cuts, crc = np.array([3, 5, 5, 5, 9]), np.array([0, (1 << 32) - 1] * 3)
    shards = wavelet.shards_of(cuts, np.array([2, 4, 5, 5, 9, 10]), crc).tolist()
    assert shards == [0, 1, 1, 4, 4, 5]
    assert wavelet.shards_of(np.array([], np.int64), np.array([1]), np.array([9])).tolist() == [0]


def test_quantiles_are_exact(spark):
    import math

    rows = [(None if i % 7 == 0 else i * i % 101, 5 if i < 400 else i, None) for i in range(600)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    shares = [i / 64 for i in range(1, 64)]
    found = quantiles(df, ["a", "b", "c"], shares)
    for i, name in enumerate("abc"):
        known = sorted(r[i] for r in rows if r[i] is not None)
        assert found[name] == [known[max(0, math.ceil(s * len(known)) - 1)] for s in shares if known]


def test_simhash_blocks_grow_with_the_fingerprints():
    assert [simhash.blocks_for(n, 4) for n in (0, 1 << 30, 1 << 31, 1 << 40)] == [6, 6, 7, 8]
    assert simhash.blocks_for(9, 4, load=1) == 6 and simhash.blocks_for(1 << 22, 4, load=1) == 7


def test_wavelet_access_count_and_occurrence():
    r = np.random.default_rng(2)
    for ids in (r.integers(0, 50257, 3000), r.integers(0, 5, 2000), np.zeros(9, int), np.zeros(0, int)):
        _, _, m = wavelet.from_bytes(wavelet.to_bytes([1], [ids.size], ids.astype(np.uint16)))
        assert (m.all() == ids).all()
        for i in range(0, ids.size, 97):
            v = int(ids[i])
            where = np.flatnonzero(ids == v)
            assert m.access(i) == v and m.count(v) == where.size
            assert m.count(v, i) == (where < i).sum()
            assert [m.occurrence(v, k) for k in (0, where.size // 2, where.size - 1)] == [where[k] for k in (0, where.size // 2, -1)]
            assert m.occurrence(v, where.size) == -1 == m.occurrence(v, -1)
        assert m.count(60000) == 0


def test_empty_tables(spark, empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0 == exact_dedup.drop_duplicates(empty).count()
    assert bpe.encode_digests(empty, RANKS, P.PATTERN).count() == 0
    assert repetition.repetition_rules(empty).count() == 0 == repetition.keep_clean(empty).count()
    assert mixing.mix(empty).count() == 0 == mixing.mixed_documents(empty).count()
    assert hilbert.shard_rows(empty, [F.col("n_chars"), F.col("doc_id")]).count() == 0
    folder, manifest = wavelet.write_shards(empty, LIBRARY)
    assert wavelet.read_shards(spark, folder, manifest).count() == 0


def test_pipeline_is_brute_force(spark):
    import tiktoken

    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES][2] == "SimHash near-dedup"
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for kind in ("quality", "exact", "near"):
        if kind == "quality":
            kept = []
            for row in rows:
                n, _, _, _, inside, covered, longest = brute.repetition(row[1])
                bad = n < 50 or 100 * inside > 50 * n or 100 * covered > 30 * n or (100 * longest > 25 * n and longest >= 20)
                kept += [] if bad else [row]
            rows = kept
        elif kind == "exact":
            last = {}
            for row in rows:
                last[row[1]] = max(last.get(row[1], row), row, key=lambda r: r[0])
            rows = list(last.values())
        else:
            stay = {c for _, _, c in brute.components([r[:2] for r in rows])}
            rows = [r for r in rows if r[0] in stay]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    wanted = {d: (len(ids := lib.encode_ordinary(t)), brute.hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(t)) for d, t, _ in rows}
    found = queries.pipeline(spark, sf).collect()
    copies = Counter(r.doc_id for r in found)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == wanted[r.doc_id] for r in found)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = brute.targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    of = {d: (s, len(brute.words(t))) for d, t, s in rows}
    for s, target in targets.items():
        own = {d: n for d, (x, n) in of.items() if x == s}
        taken = sum(copies[d] * n for d, n in own.items())
        assert abs(target - taken) <= max(own.values()) / 2 + 1
        whole = int(target // sizes[s]) if sizes[s] else 0
        assert {copies[d] for d in own} <= {whole, whole + 1}


def test_pipeline_on_odd_rows_and_on_none(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.conftest import CLASHES, LONG, NEAR, SCHEMA, STORY

    other = " ".join(f"another{i}" for i in range(80))
    rows = [
        (1, STORY, "en", "a"),
        (2, STORY, "en", "a"),  # equal texts: the largest id stays
        (3, NEAR, "en", "a"),
        (3, NEAR, "en", "a"),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \n\t ", "en", "a"),
        (7, LONG, "fr", "a"),
        (7, LONG, "fr", "a"),  # a repeated row counts once
        (8, "too short", "en", "a"),
        (9, "the same words again and again " * 40, "en", "a"),
        (None, other, "en", "a"),
        (10, "unlike " + " ".join(f"tie{i}" for i in range(90)), None, None),
        (10, "unlike " + " ".join(f"knot{i}" for i in range(90)), None, None),  # one id, two texts
    ]
    df = spark.createDataFrame([(*r, len(r[1] or ""), *CLASHES.values()) for r in rows], SCHEMA)
    df.repartition(3).write.parquet(f"{tmp_path}/some/documents.parquet")
    near = {c for _, _, c in brute.components([(2, STORY), (3, NEAR)])}
    found = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    texts = {2: STORY, 3: NEAR, 7: LONG, None: other}
    assert {r.doc_id for r in found} == near | {7, None, 10}
    assert all(r.decoded_sha256 == brute.sha(texts[r.doc_id]) for r in found if r.doc_id != 10)
    assert len({r.decoded_sha256 for r in found if r.doc_id == 10}) == 2
    assert max(Counter((r.doc_id, r.decoded_sha256) for r in found).values()) <= 2  # the cap of the mix
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    index = hilbert.hilbert_index(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute_shards(rows, shards=16):
    """(doc_id, size, crc, hilbert, shard, slot) of (doc_id, text, source, lang) rows: quantiles, cells, curve, order."""
    import math
    import zlib

    def rank(values):
        known = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
        return [None if v is None else known.index(v) for v in values]

    size = [len((t or "").encode()) + 1 for _, t, _, _ in rows]
    columns = [rank([r[2] for r in rows]), rank([r[3] for r in rows]), size, [r[0] for r in rows]]
    cells = []
    for c in columns:
        known = sorted(v for v in c if v is not None)
        n = 1 << hilbert.BITS
        cuts = sorted({known[max(0, math.ceil(i / n * len(known)) - 1)] for i in range(1, n)}) if known else []
        cells.append([0 if v is None else sum(cut <= v for cut in cuts) for v in c])
    index = hilbert.hilbert_index(np.array(cells).T, hilbert.BITS).tolist()
    crc = [zlib.crc32((t or "").encode()) for _, t, _, _ in rows]
    order = sorted(zip(index, crc, [(r[0] is not None, r[0] or 0) for r in rows], size))
    out, total = [], len(rows)
    for place, (h, x, (known, d), n) in enumerate(order):
        shard = place * shards // total
        first = -(-shard * total // shards)
        out.append((d if known else None, n, x, h, shard, place - first))
    return out


@pytest.mark.parametrize("table", ["edge", "given"])
def test_hilbert_query_is_brute_force(request, spark, tmp_path, table):
    df = request.getfixturevalue(table)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in df.select("doc_id", "text", "source", "lang").collect()]
    found = queries.op7_hilbert_shards(spark, str(tmp_path)).collect()
    assert bag((r.doc_id, r.size, r.text_crc32, r.hilbert, r.shard, r.slot) for r in found) == bag(brute_shards(rows))
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}


def test_hilbert_query_on_no_rows(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op7_hilbert_shards(spark, str(tmp_path)).collect() == []
