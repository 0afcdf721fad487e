"""The BPE transducer and the plane files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, planes
from millrace.session import scratch_path
from tests.llm.helpers import SMALL, by_id, documents, frame, sha


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.default_vocabulary()


@pytest.fixture(scope="module")
def coder(vocabulary):
    return bpe.Transducer(vocabulary)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    pick = random.Random(7)
    texts = [
        "", " ", "<|endoftext|>a<|endoftext|>", "a" * 20_000, " " * 70_000 + "b", "aaab" * 4000, "日本語テキスト" * 2000, "😀👍🏽" * 2000,
        "x\n\n\n  y\t\t z", "don't we'll I'd 'S 'Re", "1²³ \x1c\x1d a\x85b\xa0c", "\x00\x01\x7f", "tail ", "tail \n ", "՘x⃝", "é" * 300,
    ]
    texts += ["".join(pick.choice("abtheing  \n'sé1.") for _ in range(pick.randrange(5, 4000))) for _ in range(30)]
    texts += ["".join(pick.choice("abtheing") for _ in range(pick.randrange(5000, 20_000))) for _ in range(6)]
    anything = lambda: chr(pick.choice([pick.randrange(1, 0x500), pick.randrange(0x500, 0xD800), pick.randrange(0xE000, 0x1FFFF)]))
    return texts + ["".join(anything() for _ in range(200)) for _ in range(60)]


def test_ids_and_text_equal_the_library(coder, library):
    for text in odd_texts():
        ids = [i for part in coder.encode(text) for i in part]
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:60]
        decoder = coder.decoder()
        assert "".join(decoder.feed([i]) for i in ids) + decoder.end() == library.decode(ids, skip_special_tokens=False)


def test_decoder_of_broken_bytes(coder, library):
    pick = random.Random(3)
    for _ in range(50):
        ids = [pick.randrange(256) for _ in range(20)]
        decoder = coder.decoder()
        assert "".join(map(decoder.feed, ([i] for i in ids))) + decoder.end() == library.decode(ids, skip_special_tokens=False)


def test_lookahead_is_sufficient_and_output_is_bounded(coder):
    """Tokens that end a lookahead before the end of a beginning are those of the whole, wherever it is cut."""
    pick = random.Random(11)
    letters = "".join(pick.choice("abtheingr") for _ in range(6000)).encode()
    whole = coder.merge_window(letters)
    ends = np.cumsum([coder.length_of[i] for i in whole])
    for cut in (1500, 2500, 3999, 5000):
        known = coder.merge_window(letters[:cut])
        stable = [i for i, end in zip(known, np.cumsum([coder.length_of[i] for i in known])) if end <= cut - coder.lookahead]
        assert stable == whole[: len(stable)] and len(stable) >= int(np.searchsorted(ends, cut - coder.lookahead)) - 1
    parts = list(coder.stream(letters[i : i + 100] for i in range(0, 6000, 100)))
    assert [i for part in parts for i in part] == whole and max(map(len, parts)) <= coder.window


@pytest.mark.parametrize("blank", [" ", "\t", "\n"])
def test_a_million_blanks_reach_the_files(spark, vocabulary, library, blank):
    text = blank * 1_000_000 + "b"
    path = scratch_path(spark, "blanks")
    planes.write_ids(frame(spark, [(1, text), (2, "a b")]), vocabulary, path)
    got = by_id(planes.document_digests(spark, path))
    ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
    assert (got[1].n_tokens, got[1].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes())) and got[2].n_tokens == 3


def test_a_vocabulary_without_merges_keeps_every_byte(vocabulary):
    import json

    bare = json.loads(vocabulary)
    bare["model"]["merges"] = []
    bare = json.dumps(bare)
    text = "abcdefghij" * 1000
    ids = [i for part in bpe.Transducer(bare).encode(text) for i in part]
    assert ids == Tokenizer.from_str(bare).encode(text, add_special_tokens=False).ids and len(ids) == len(text)


def test_lookahead_of_small_merge_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    # ab, then c before ab, then d before what begins with c
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"c", b"a"), (b"d", b"ca")]) == 3


def test_short_and_long_merging_agree(coder):
    pick = random.Random(5)
    for _ in range(300):
        data = bytes(pick.choice(b"abtheing \xc3\xa9") for _ in range(pick.randrange(1, 60)))
        assert coder.merge_short(data) == coder.merge_window(data)


def test_unsupported_vocabularies_are_refused(vocabulary):
    with pytest.raises(ValueError):
        bpe.Transducer(vocabulary.replace('"ByteLevel","add_prefix_space":false', '"ByteLevel","add_prefix_space":true').replace(
            '"add_prefix_space": false', '"add_prefix_space": true'))


def expected(library, rows):
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    return {i: (len(x), sha(",".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}


def test_round_trip_of_documents(spark, vocabulary, library):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    got = by_id(bpe.op2_bpe_round_trip(spark, SMALL))
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in got.items()} == expected(library, rows)


def test_encode_and_decode_tables(spark, vocabulary, library):
    rows = [(1, "Hello there"), (2, None), (3, ""), (None, "x"), (3, "again"), (4, "é" * 100_000)]
    df = frame(spark, [(*r, b"0") for r in rows], "doc_id long, text string, ids binary")
    encoded = bpe.encode_documents(df, vocabulary)
    back = bpe.decode_documents(encoded, vocabulary).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert bpe.round_trip(df.filter("false"), vocabulary).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    random_ids = np.random.default_rng(1).integers(0, 1 << 32, 1000, dtype=np.uint32)
    for ids in (random_ids, random_ids[:1], random_ids[:0], np.arange(77, dtype=np.uint32), np.full(5, 2**32 - 1, np.uint32)):
        assert (planes.unpack(planes.pack(ids, kind)) == ids).all()


def test_joined_checksums():
    data = bytes(range(256)) * 40
    for cut in (0, 1, 7, 1000, len(data)):
        assert planes.join_crc32(zlib.crc32(data[:cut]), zlib.crc32(data[cut:]), len(data) - cut) == zlib.crc32(data)


def check_files(spark, vocabulary, library, rows, **options):
    path = scratch_path(spark, "ids")
    planes.write_ids(frame(spark, rows), vocabulary, path, **options)
    got = sorted(planes.document_digests(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return path


def test_files_of_documents(spark, vocabulary, library):
    rows = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    check_files(spark, vocabulary, library, rows)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_documents_across_blocks(spark, vocabulary, library, kind):
    rows = [(1, None), (2, "word " * 500), (3, ""), (4, "a b c <|endoftext|> ՘"), (5, "many words " * 300)]
    path = check_files(spark, vocabulary, library, rows, block_ids=64, planes=kind)
    blocks = planes.read_blocks(spark, path)
    assert blocks.filter("n_ids > 64").isEmpty() and blocks.count() > 15


def test_files_of_nothing_and_of_null_ids(spark, vocabulary):
    path = scratch_path(spark, "ids")
    planes.write_ids(frame(spark, []), vocabulary, path)
    assert planes.document_digests(spark, path).count() == 0
    path = scratch_path(spark, "ids")
    planes.write_ids(frame(spark, [(None, "b"), (1, "x"), (1, "x")]), vocabulary, path)
    assert [r.doc_id for r in sorted(planes.document_digests(spark, path).collect(), key=lambda r: r.start)] == [None, 1, 1]


def test_plain_texts_meet_no_pattern_and_no_list(vocabulary, library, monkeypatch):
    """Texts of Latin letters that are shorter than a long blank are neither searched nor turned into Python numbers."""
    ids_of = planes.Ids(vocabulary)
    texts = ["", "plain words, 12 of them", "Größe übermäßig ÿ", "a" * 1000 + " " * 1000, "<|endoftext|> x", "later letters: ԱՖ"]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids_of(t).tolist() for t in texts] == wanted

    def unwanted(*_, **__):
        raise AssertionError("costly way taken")

    monkeypatch.setattr(ids_of, "long_blank", None)
    monkeypatch.setattr(ids_of.fast, "encode", unwanted)
    assert [ids_of(t).tolist() for t in texts] == wanted
    monkeypatch.setattr(ids_of, "unsettled", None)
    assert [ids_of(t).tolist() for t in texts[:-1]] == wanted[:-1]
