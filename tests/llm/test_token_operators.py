import base64
import hashlib
import random
import uuid
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quillstone.llm import bpe_codec, bpe_ids, packing, pfor, token_files
from quillstone.llm.bpe_ids import Encoder

JSON = P.path("byte_bpe_50k.json")


#: The library as its file sets it up, apart from the code under test.
LIBRARY = Tokenizer.from_file(JSON)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(encoder, texts):
    ids, offsets = encoder(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in pairwise(offsets)]


def test_strings_of_added_tokens_are_the_librarys():
    assert library_ids("a b <|endoftext|> c") == [64, 275, 220, 50256, 269]
    texts = ["a b <|endoftext|> c", "x<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endof", "text|>", "it's <|endoftext|> 's."]
    assert encoded(Encoder(JSON), texts) == [library_ids(t) for t in texts]


@pytest.mark.parametrize("slice_bytes", [64, 4 << 20])
def test_units_give_the_librarys_ids(odd_documents, monkeypatch, slice_bytes):
    monkeypatch.setattr(bpe_ids, "SLICE", slice_bytes)
    monkeypatch.setattr(bpe_ids, "CACHE_UNITS", 300)
    rng = random.Random(slice_bytes)
    parts = [*"abcdeXYZ   \n\t.,'!?-019é ßÄ÷×日本ſʼ", "\u00a0", "\u0085", "\u3000", "\u2028", "\u1680", "\u200b", "\x1c", "\x0b", "😀", "\u0301", "'s", "'ll", "<|endoftext|>", " the", "ing", "\r\n", "  "]
    texts = [r.text for r in odd_documents.collect() if len(r.text or "") < 9000] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    encoder = Encoder(JSON)
    for _ in range(2):
        assert encoded(encoder, texts) == [library_ids(t) for t in texts]
    encoder.forget()
    assert encoded(encoder, []) == []


def test_other_pre_tokenisers_get_whole_texts():
    other = P.path("word_bpe_49k.json")
    texts = ["A cat, it's  there.", "", None, "x <|endoftext|> y"]
    assert encoded(Encoder(other), texts) == [Tokenizer.from_file(other).encode(t or "", add_special_tokens=False).ids for t in texts]


def test_codec_matches_tiktoken_and_round_trips(spark, odd_documents, no_documents):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    args = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    source = sorted((r.doc_id or -1, r.text or "") for r in odd_documents.collect())
    full = sorted((r.doc_id or -1, bytes(r.decoded).decode(), r.ids) for r in bpe_codec.encode_decode(odd_documents, *args).collect())
    assert [(d, t) for d, t, _ in full] == source
    assert all(ids == plain.encode_ordinary(t) for _, t, ids in full)
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_codec.digest(odd_documents, *args).collect())
    want = sorted((d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t, i in full)
    assert got == want
    assert bpe_codec.digest(no_documents, *args).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 1 << 32])
def test_pfor_round_trip_and_random_access(n, top):
    rng = np.random.default_rng(n + top)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.02] = (1 << 32) - 1
    data = pfor.encode(ids, [None, 7], np.array([n, 0]))
    segment = pfor.Segment(data)
    assert np.array_equal(segment.ids(), ids)
    assert segment.doc_ids == [None, 7]
    for i in range(len(segment.starts)):
        assert np.array_equal(segment.block(i), ids[i * 128 : (i + 1) * 128])


def test_token_files_read_back(spark, odd_documents, no_documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    token_files.write(odd_documents, f"{tmp_path}/f", JSON)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read(spark, f"{tmp_path}/f").collect())
    assert [g[1] for g in got] == sorted((r.doc_id for r in odd_documents.collect()), key=lambda d: (d is not None, d or 0))
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    want = sorted(zlib.crc32(np.array([*library_ids(r.text), 0], "<u4").tobytes()) for r in odd_documents.collect())
    assert sorted(g[3] for g in got) == want
    token_files.write(no_documents, f"{tmp_path}/g{uuid.uuid4().hex}", JSON)


def check_packed(rows, documents, capacity):
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in documents:
        ids = np.array([*library_ids(text), 2], "<u4")
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(docs[doc])):
            assert (piece, start, crc) == (k, at, zlib.crc32(ids[at : at + length].tobytes()))
            assert length == capacity or k == 0
            at += length
        assert at == len(ids)
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing(spark, odd_documents, no_documents):
    documents = odd_documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack(documents, JSON, capacity=64).collect()
    used, least = check_packed(rows, [(r.doc_id, r.text) for r in documents.collect()], 64)
    assert used <= least + 2
    assert packing.pack(odd_documents, JSON, capacity=64).count() >= odd_documents.count()
    assert packing.pack(no_documents, JSON).count() == 0


def test_fullest_is_a_true_maximum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 40)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1) if s + k * i <= room}
        chosen = packing.fullest(counts, room)
        assert sum(k * n for k, n in chosen.items()) == max(sums)
        assert all(n <= counts[k] for k, n in chosen.items())


def test_plan_uses_every_piece_once_and_fills_well():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        k = min(1024, int(rng.expovariate(1 / 300)) + 1)
        counts[k] = counts.get(k, 0) + 1
    used, bins = {}, 0
    for times, chosen in packing.plan(counts, 1024):
        assert sum(k * n for k, n in chosen) <= 1024
        bins += times
        for k, n in chosen:
            used[k] = used.get(k, 0) + times * n
    assert used == counts
    assert bins <= -(-sum(k * n for k, n in counts.items()) // 1024) * 1.02 + 1
