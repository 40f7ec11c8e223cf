"""BPE against the tokenizers library, and token-id files as an exact round trip."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratum.llm import token_files
from stratum.llm.bpe import WordBpe, encode_documents, merge
from stratum.llm.token_files import ByteBpe, read_file, read_token_files, with_crc, write_file, write_token_files

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "<|endoftext|>a<|startoftext|> b<|endoftext|>", "x" * 3000, "ab" * 2000 + "!" * 500, "a\n b", "a \xa0 \xa0",
       "İstanbul ΣΑΣ naïve café", "中文 и русский", "e\u0301", "can't I'LL 12½²", "\x1c\x1f\x85"]


def texts(n=1500):
    r = random.Random(4)
    alpha = list("abcXYZ 's've  0123²½ªµ\t\n\x1c\x85\xa0 İßÉΣσς中🙂<|>endoftext|.,-")
    return ODD + ["".join(r.choice(alpha) for _ in range(r.randint(0, 50))) for _ in range(n)]


def plain_merge(symbols, ranks):
    while True:
        found = [(ranks[a << 32 | b][0], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 32 | b in ranks]
        if not found:
            return symbols
        _, i = min(found)
        symbols[i:i + 2] = [ranks[symbols[i] << 32 | symbols[i + 1]][1]]


def test_segment_tree_merges_like_a_plain_search():
    r = random.Random(2)
    for _ in range(300):
        ranks, new = {}, 4
        for rank in range(r.randint(0, 12)):
            pair = r.randrange(new) << 32 | r.randrange(new)
            if pair not in ranks:
                ranks[pair] = (rank, new)
                new += 1
        word = [r.randrange(4) for _ in range(r.randint(0, 25))]
        assert merge(list(word), ranks, 12) == plain_merge(list(word), ranks)


def test_word_bpe_equals_the_library():
    own, lib = WordBpe(WORDS), Tokenizer.from_file(WORDS)
    for t in texts():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ids, repr(t)
        assert own.decode(own.encode(t)) == lib.decode(ids, skip_special_tokens=False)


def test_byte_bpe_equals_the_library():
    own, lib = ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    for t in texts():
        assert np.frombuffer(own.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_encoded_documents(spark):
    rows = [(1, None, "x"), (None, "Hello hello", "y"), (2, "Hello hello", "z"), (2, "Hello hello", "z")]
    got = encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids string"), WORDS).collect()
    lib = Tokenizer.from_file(WORDS)
    ids = lib.encode("Hello hello", add_special_tokens=False).ids
    assert sorted(len(r.ids) for r in got) == [0, 2, 2, 2] and got[1].ids == ids
    assert got[0].ids_sha256 == got[0].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[1].ids_sha256 == hashlib.sha256(struct.pack("<2I", *ids)).hexdigest()
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0


@pytest.mark.parametrize("kind", ["random", "same", "text", "short", "none"])
def test_file_round_trip(kind, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 512)
    r = np.random.default_rng(7)
    n = {"random": 3000, "same": 4000, "text": 5000, "short": 3, "none": 0}[kind]
    ids = {"random": r.integers(0, 65536, n), "same": np.full(n, 65535), "text": r.zipf(1.3, n) % 50000,
           "short": np.array([0, 50256, 1]), "none": np.zeros(0)}[kind].astype("<u4")
    cuts = np.sort(r.integers(0, n + 1, 5))
    docs = list(zip([3, None, 5, 6, 7, 2**62], [x.tobytes() for x in np.split(ids, cuts)]))
    count, raw = write_file(docs)
    assert count == n
    assert [(d, x.astype("<u4").tobytes()) for d, x in read_file(raw)] == docs
    if n > 100:
        for at in (10, len(raw) // 2, len(raw) - 3):
            bad = bytearray(raw)
            bad[at] ^= 1
            with pytest.raises(Exception):
                read_file(bytes(bad))


def test_repeats_compress():
    unit = np.random.default_rng(1).integers(0, 50000, 100).astype("<u4")
    _, raw = write_file([(1, np.tile(unit, 80).tobytes())])
    assert len(raw) < 2 * 8000 / 8


def mixed_languages(n=1_200_000):
    """Ids of texts of some 150 ids in four languages of 1,000 ids each, by Zipf's law."""
    r = np.random.default_rng(3)
    language = np.repeat(r.integers(0, 4, n // 150 + 1), 150)[:n]
    return (np.minimum(r.zipf(1.2, n), 1000) + 1000 * language).astype("<u4")


def test_languages_have_tables_of_their_own():
    ids = mixed_languages()
    own = np.bincount(ids % 1000)[np.bincount(ids % 1000) > 0] / len(ids)
    bits = -(own * np.log2(own)).sum()  # an id's bits if its language were known
    _, raw = write_file([(1, ids.tobytes())])
    assert len(raw) * 8 / len(ids) < bits + 1
    assert read_file(raw)[0][1].tobytes() == ids.tobytes()


def test_carries_and_short_last_blocks(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    r = np.random.default_rng(5)
    for n in [1, 63, 64, 65, 6400, 6401, 20_000]:
        ids = np.where(r.random(n) < 0.97, 7, r.integers(0, 1 << 16, n)).astype("<u4")
        _, raw = write_file([(1, ids.tobytes())])
        assert read_file(raw)[0][1].tobytes() == ids.tobytes()


def test_no_small_file_at_the_end_of_a_partition(spark, scratch, monkeypatch):
    # a file's steps are as many for few blocks as for many
    monkeypatch.setattr(token_files, "FILE_IDS", 100)
    df = spark.createDataFrame([(i, "the the the") for i in range(40)], "doc_id long, text string").coalesce(1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        files = write_token_files(df, f"{scratch}/files", BYTES).orderBy("number").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [f.n_ids for f in files] == [160]


def test_token_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 300)
    rows = [(i * 13 % 50, t) for i, t in enumerate(texts(40))] + [(None, "null id"), (1, None), (1, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    files = write_token_files(df, f"{scratch}/files", BYTES)
    got = with_crc(read_token_files(files)).orderBy("start").collect()
    lib = Tokenizer.from_file(BYTES)
    want = sorted((d is not None, d or 0, zlib.crc32(struct.pack(f"<{len(e) + 1}I", *e, 0)), len(e) + 1)
                  for d, t in rows for e in [lib.encode(t or "", add_special_tokens=False).ids])
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32, r.n_tokens) for r in got) == want
    assert [r.doc_id is not None and r.doc_id for r in got] == sorted(r.doc_id is not None and r.doc_id for r in got)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    empty = write_token_files(df.limit(0), f"{scratch}/none", BYTES)
    assert read_token_files(empty).count() == 0
