"""Token files and archives: exact round trips, damage, odd rows."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from censusmart.llm import token_codec, token_files, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 9000])
def test_codec_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.full(n, 50256), np.tile([5, 6, 7], n)[:n], (rng.pareto(0.6, n) * 9).astype(int) % 50257):
        blocks = token_codec.encode(ids.astype(np.int64), 50257)
        assert (token_codec.decode(blocks, n, 50257) == ids).all() and len(blocks) == -(-n // 4096)
    repeated = token_codec.encode(np.tile([5, 6, 7], 1400)[:4096].astype(np.int64), 50257)
    assert len(repeated[0]) < 1000
    with pytest.raises(ValueError):
        token_codec.encode(np.array([50257]), 50257)


def test_tokenizer_equals_library():
    from tokenizers import Tokenizer as Library

    tokenizer, library = token_files.Tokenizer(PATH), Library.from_file(PATH)
    texts = ["it's  we'll\n\n  z_ _a", "x\x1cy 12²½ ٣٤ 漢字", "<|endoftext|>", "a<|endoftext|> b <|endoftext|", "", "  ", "\n", "a\xa0b Ω’s", "Éß ñ " * 50, "a\t\tb\r\n c", "'s're 'LL"]
    assert [list(x) for x in tokenizer.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_damage_is_found():
    content = bytearray(token_files.pack(0, 0, [1, None], [np.array([5, 6], np.uint32), np.array([0], np.uint32)], 50257))
    assert token_files.unpack(bytes(content))[2] == [1, None]
    for at in (30, len(content) - 1):
        bad = bytearray(content)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            token_files.unpack(bytes(bad))


def test_token_index(spark):
    docs = [(3, "b c", 1), (1, "alpha beta " * 4000, 1), (2, None, 1), (None, "last", 1), (2, "x", 1), (2, "x", 1), (4, "", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, start int").repartition(3)
    got = sorted(token_files.token_index(spark, token_files.write_tokens(frame, PATH)).collect(), key=lambda r: r.start)
    tokenizer, at = token_files.Tokenizer(PATH), 0
    assert [r.doc_id for r in got] == [1, 2, 2, 2, 3, 4, None]
    sizes = {}
    for i, t, _ in docs:
        ids = np.append(tokenizer.encode([t or ""])[0], 0)
        sizes.setdefault(i, []).append((len(ids), token_codec.checksum(ids)))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in sizes[r.doc_id]
        at += r.n_tokens
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_index(spark, token_files.write_tokens(empty, PATH)).count() == 0


def test_archive_round_trip(spark):
    long, other = "long ä " * 400, "other " * 300
    pages = [(1, "http://a/ü\r\nx", long), (5, "http://b", long), (5, "http://b", long), (3, None, long), (None, "u", long), (7, "u", None),
             (8, "u", ""), (9, "u", "short"), (10, "u", "short"), (11, "u", other), (12, "u", "x" * 200_000)]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string").repartition(2)
    got = warc.read_archive(spark, warc.write_archive(frame)).collect()
    expected = []
    for page, _, html in pages:
        body = (html or "").encode()
        revisit = html == long and page != 5
        expected.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(empty)).count() == 0


def test_archive_file_with_and_without_dictionary():
    records = [warc.record(i, "u", f"<p>page {i} of many</p>".encode() * 9, 9 * len(f"<p>page {i} of many</p>"), hashlib.sha1(f"<p>page {i} of many</p>".encode() * 9).digest(), None) for i in range(500)]
    content = warc.archive(records)
    assert int.from_bytes(content[:4], "little") == 0x184D2A5D and list(warc.records_of(content)) == records
    assert list(warc.records_of(warc.archive(records[:1]))) == records[:1]
    with pytest.raises(ValueError):
        list(warc.records_of(content[:-3]))
    with pytest.raises(ValueError):
        warc.parse(records[0].replace(b"page 0", b"page 1", 1))


@pytest.mark.parametrize("n", [63 * 4096 + 9, 64 * 4096, 64 * 4096 + 5, 65 * 4096 + 1])
def test_codec_many_blocks(n):
    """Blocks share one model; before, each learned its own, step by step in both directions, and took a fifth more."""
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.6, n) * 9).astype(int) % 50257
    ids[1::2] = np.where(rng.random(len(ids[1::2])) < 0.7, ids[:-1:2][:len(ids[1::2])] * 7 % 50257, ids[1::2])
    blocks = token_codec.encode(ids, 50257)
    assert (token_codec.decode(blocks, n, 50257) == ids).all() and len(blocks) == -(-n // 4096)
    assert sum(map(len, blocks)) < 0.95 * n


def test_codec_damage_raises_no_other_error():
    rng = np.random.default_rng(1)
    content = token_files.pack(0, 0, [1], [(rng.pareto(0.6, 9000) * 9).astype(np.uint32) % 50257], 50257)
    for at in rng.integers(0, len(content), 60):
        bad = bytearray(content)
        bad[at] ^= 1 << at % 8
        with pytest.raises(ValueError):
            token_files.unpack(bytes(bad))


def test_tokenizer_chunks_equal_library():
    from tokenizers import Tokenizer as Library

    rng, library = np.random.default_rng(3), Library.from_file(PATH)
    parts = [" ", " ", " ", "a", "b", "é", "Ω", "漢", "'", "s", "'s", "1", "²", "٣", "\n", "\t", "\xa0", "　", " ", "​", "᠎", "\x85", "\x1c",
             "﻿", "!", ",", "_", "́", "😀", "Ġ", "\xad", "ll", "\x7f", "\0"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 25))) for _ in range(4000)]
    got = token_files.Tokenizer(PATH).encode(texts)
    assert [list(x) for x in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_known_chunks_do_not_go_to_the_library_again():
    """Before, texts with characters beyond Latin ones went to it whole, every time."""
    tokenizer = token_files.Tokenizer(PATH)
    texts = ["Ω αβγ δεζ, it's\n\n  a  test. 漢字 ", "αβγ test."]
    first = [list(x) for x in tokenizer.encode(texts)]
    tokenizer.library = tokenizer.merger = None
    assert [list(x) for x in tokenizer.encode(texts)] == first
