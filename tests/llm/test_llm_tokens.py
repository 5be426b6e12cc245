"""Tokenising operators against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from callframe.llm import binary_output, bytebpe, encoding, packing, token_counts
from tests_llm_util import documents

JSON = bytebpe.vocabulary_path("byte_bpe_50k.json")
RANKS = bytebpe.vocabulary_path("byte_bpe_50k.tiktoken")


def fuzz(n, seed=1):
    rng = random.Random(seed)
    pool = list("abst'  \n\t rvemldSTREL019²½१ é中文字😀́ _-!?.,\x1c\x85　ſ͸՘") + ["<|endoftext|>", "'s", "'re", "'ll"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(n)] + [
        "", "a" * 9000, " " * 9000, "=" * 9001, "\n" * 50 + "x"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(JSON)


def ids_of(table, texts):
    return [flat[a:b].tolist() for _, flat, off in table.run(texts) for a, b in zip(off[:-1], off[1:])]


def test_piece_table_gives_the_librarys_ids(library):
    texts = fuzz(4000)
    assert ids_of(bytebpe.json_piece_table(JSON), texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_tables_and_steps_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bytebpe, "STEP", 500)
    bytebpe._powers.cache_clear()
    texts = fuzz(300, 2) + [" ".join(["word"] * 700)]
    table = bytebpe.json_piece_table(JSON, max_pieces=200)
    assert ids_of(table, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bytebpe._powers.cache_clear()


def test_code_point_classes_agree_with_the_library():
    from tokenizers import pre_tokenizers
    cut, table = pre_tokenizers.ByteLevel(add_prefix_space=False), bytebpe.class_table()
    points = [i for i in range(0, 0x3400) if table[i] != bytebpe.UNKNOWN and i != 32]
    for at in range(0, len(points), 2000):
        part = [chr(i) for i in points[at:at + 2000]]
        starts = {o[0] for _, o in cut.pre_tokenize_str("".join(f"\na{c}{c}1" for c in part))}
        for k, c in enumerate(part):
            kind = 1 if 5 * k + 2 not in starts else 2 if 5 * k + 4 not in starts else 3 if 5 * k + 3 in starts else 0
            assert kind == table[ord(c)], hex(ord(c))


def test_transducer_counts_like_the_library():
    machine, lib = token_counts.transducer(JSON), bytebpe.json_tokenizer(JSON, regex=False)
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdehinorst é日😀=-_ ") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    pieces += ["a" * 9000, "=" * 20001, " the" * 4000, "é" * 9000]
    assert [machine.count(p.encode()) for p in pieces] == [len(e.ids) for e in lib.encode_batch(pieces, add_special_tokens=False)]


def test_chunk_maps_compose_from_any_state():
    machine = token_counts.transducer(JSON)
    data = b"internationalisation" * 20
    whole = machine.run(data)
    for cut in (1, 7, 200, 399):
        left, right = (token_counts.ChunkMap(machine, x) for x in (data[:cut], data[cut:]))
        assert token_counts.ChunkMap(machine, None, (left, right)).at(0) == whole


def test_dropping_transitions_keeps_counts():
    full, small = token_counts.transducer(JSON), token_counts.transducer(JSON)
    small.max_arcs = 50
    words = [w.encode() for t in fuzz(300, 4) for w in t.split()]
    assert [small.count(w) for w in words] == [full.count(w) for w in words]


def test_counts_of_documents(spark, library):
    docs = documents(spark, fuzz(200, 5))
    want = {i: len(e.ids) for i, e in enumerate(library.encode_batch(fuzz(200, 5), add_special_tokens=False))}
    got = token_counts.count_tokens(docs).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_encoding_like_tiktoken_and_back(spark):
    import public_tokenizers
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})
    texts = fuzz(400, 6)
    docs = documents(spark, texts)
    trip = {r.doc_id: r for r in encoding.round_trip(docs).collect()}
    for i, t in enumerate(texts):
        ids = np.array(enc.encode_ordinary(t), "<u4")
        assert (trip[i].n_tokens, trip[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert trip[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    encoded = encoding.encode(docs, with_offsets=True)
    assert {r.doc_id: r.text for r in encoding.decode(encoded).collect()} == dict(enumerate(texts))
    for r in encoded.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.offsets == enc.decode_with_offsets(ids)[1] if ids else r.offsets == []


def test_packing_fills_every_sequence(spark, library):
    texts = fuzz(500, 7) + ["word " * 3000]
    pieces = packing.pack(documents(spark, texts), with_ids=True).collect()
    want = [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.ids_crc32 == zlib.crc32(p.ids) and p.length == len(ids) and p.doc_tokens == len(want[p.doc_id])
        by_doc.setdefault(p.doc_id, []).append((p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, parts in by_doc.items():
        assert [x for start, ids in sorted(parts) for x in ids] == want[i]
    assert len(by_doc) == len(texts)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & at - 1 == 0  # full or a power of two: nothing is padded


def test_packing_prefers_the_cheapest_sequence():
    pieces, n = packing.pack_block([900, 700, 300, 100, 48], 1024)
    assert n == 2 and sorted(pieces[:, 2].tolist(), reverse=True)[:2] == [900, 700]
    first = {tuple(p[:2]): p[3] for p in pieces.tolist()}
    assert first[0, 0] != first[1, 0]  # the second longest opens the other sequence


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        assert sorted(binary_output.feistel(np.arange(n), n)) == list(range(n))
    assert binary_output.feistel(np.arange(100), 100, 1).tolist() != binary_output.feistel(np.arange(100), 100, 2).tolist()


def test_shards_hold_every_id_once_and_resume(spark, tmp_path, library):
    texts = fuzz(300, 8)
    folder = str(tmp_path / "shards")
    rows = binary_output.materialise(documents(spark, texts).repartition(3), folder, length=64, per_shard=7).collect()
    n = len(rows)
    read = list(binary_output.read_slots(folder, 0, n, length=64, per_shard=7))
    assert len(read) == n and sorted(r.slot for r in rows) == list(range(n))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(read[r.slot].tobytes())
        assert r.byte_offset == r.slot % 7 * 128 and r.shard == r.slot // 7
    assert sum(r.n_tokens for r in rows) == sum(len(e.ids) + 1 for e in library.encode_batch(texts, add_special_tokens=False))
    for a, b in zip(binary_output.read_slots(folder, 10, 9, length=64, per_shard=7), read[10:19]):
        assert (a == b).all()


# ---- equal hashes of different pieces ---------------------------------------

def equal_hash_words():
    """Two words of 2,048 letters that agree in every polynomial modulo 2^64."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    return a, b


def test_words_of_equal_hash_keep_their_own_ids(spark):
    import hashlib
    import public_tokenizers
    from tokenizers import Tokenizer
    a, b = equal_hash_words()
    points = bytebpe.code_points(a + b)
    begin, end = np.array([0, 2048]), np.array([2048, 4096])
    hashes = bytebpe.piece_hashes(points, begin, end)
    assert hashes[0] == hashes[1] and a != b
    texts = [a, b, f"{a} {b} {a} {b}", f"x {b} {a}", b]
    docs = documents(spark, texts).coalesce(1)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [r.n_tokens for r in sorted(token_counts.count_tokens(docs).collect())] == list(map(len, ids))
    got = sorted(encoding.round_trip(docs).collect())
    assert [r.decoded_sha256 for r in got] == [hashlib.sha256(x.encode()).hexdigest() for x in texts]
    pieces = sorted(packing.pack(docs, with_ids=True).collect(), key=lambda r: (r.doc_id, r.start))
    for i, want in enumerate(ids):
        assert np.frombuffer(b"".join(r.ids for r in pieces if r.doc_id == i), "<u4").tolist() == [*want, 0]


def test_shards_hold_the_librarys_ids(spark, tmp_path, library):
    """Every task's stream, read back from the shards, is the library's ids of
    its texts in order, each closed by the end id."""
    texts = fuzz(120, 9) + [None, "", "same text", "same text"]
    docs = documents(spark, texts).repartition(4)
    folder = str(tmp_path / "shards")
    cut = binary_output.cut_sequences(docs, length=32).collect()
    rows = binary_output.materialise(docs, folder, length=32, per_shard=16).collect()
    read = list(binary_output.read_slots(folder, 0, len(rows), length=32, per_shard=16))
    assert sorted(bytes(r.ids) for r in cut) == sorted(x.tobytes() for x in read)
    want = sorted(tuple([*library.encode(t or "", add_special_tokens=False).ids, binary_output.END_ID]) for t in texts)
    got = []
    for part in {r.part for r in cut}:
        stream = np.concatenate([np.frombuffer(r.ids, "<u2")[:r.n_tokens] for r in sorted((r for r in cut if r.part == part), key=lambda r: r.number)])
        ends = np.flatnonzero(stream == binary_output.END_ID)
        got += [tuple(x.tolist()) for x in np.split(stream, ends + 1)[:-1]]
    # a text may hold the end id itself: then both sides are cut there
    assert sorted(x for t in want for x in _cut(t)) == sorted(got)


def _cut(ids):
    at = [i + 1 for i, x in enumerate(ids) if x == binary_output.END_ID]
    return [tuple(ids[a:b]) for a, b in zip([0, *at], at)]


def test_a_table_does_not_outlive_its_stage(spark):
    """Python workers stay for the next stage; the pieces of one stage do not."""
    from callframe.llm.bytebpe import shared_piece_table, vocabulary_path
    from callframe.llm.common import map_texts
    path = vocabulary_path("byte_bpe_50k.json")

    def tokenise():
        table = shared_piece_table(path)
        met = table.pieces

        def batch(ids, _, texts):
            for _run in table.run(texts):
                pass
            yield [ids, [met] * len(ids)]

        return batch

    def left(with_table):
        def task():
            from callframe.llm import common
            held = len(common._LEFT) if not with_table else 0
            return tokenise() if with_table else lambda ids, _, texts: [[ids, [held] * len(ids)]]
        docs = spark.createDataFrame([(i, f"some words {i}") for i in range(8)], "doc_id long, text string").coalesce(1)
        return {r.met for r in map_texts(docs, task, [("met", "bigint")]).collect()}

    assert left(True) == {0} and left(True) == {0} and left(False) <= {0, 1}
