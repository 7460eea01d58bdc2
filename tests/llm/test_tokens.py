import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rankflow.llm import token_ids as module
from rankflow.llm.packing import batches, pack, packed_digest
from rankflow.llm.token_files import decode_block, encode_segment, from_planes, read_token_files, to_planes, write_token_files
from rankflow.llm.token_ids import WordEncoder, token_ids
from rankflow.sources.workspace import new_folder, stored
from tests.conftest import TESTDATA

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None, "", " ", "\n\n", "Hello, World!", "it's we'll 12345", "<|endoftext|> and a<|startoftext|>b", "ΟΔΟΣ Σ σς İstanbul ﬁ ① é é ́x",
    "tab\tand\x0bvt \x1c fs\x1d \x85 nbsp\xa0x　y z", "mark \x01 here\x01there", "日本語テキスト🙂👩‍👩‍👧", "x" * 300 + " " + "longword" * 2000, "a" * 64, "word " * 9000,
]
ROWS = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (None, "no id"), (6, " ")]
SCHEMA = "doc_id bigint, text string, ids string, n_tokens int, shard int, start int"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_ids_are_those_of_the_library(spark):
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_ids(frame(spark), PATH).collect())
    want = Counter((i, len(library_ids(t)), np.array(library_ids(t), dtype="<u4").tobytes()) for i, t in ROWS)
    assert got == want


def test_every_kind_of_word_in_one_batch():
    words = [w for t in TEXTS if t for w in t.split(" ")]
    words += [a + b + c for a in ("", "don't", "Été", "x1", "(word", "İi", "ABC", "ﬁ") for b in ("", ".", "!!", "'", "'s", "_", "<|endoftext|>", "|>", "…") for c in ("", ",", "z")]
    text = " ".join(words)
    for encode in (WordEncoder(PATH).encode,) * 2:
        assert encode(["", text, text]) == [b"", *[np.array(library_ids(text)[:-1], dtype="<u4").tobytes()] * 2]


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(module, "RECURRING_WORDS", 3)
    monkeypatch.setattr(module, "NEW_WORDS", 2)
    encode = WordEncoder(PATH).encode
    for text in ("one two three four", "five six seven one", "one two", "it's x1 ÉTÉ été", "x" * 99 + " \x01 y", "one five"):
        assert encode([text, text + " x"])[0] == np.array(library_ids(text)[:-1], dtype="<u4").tobytes()


def test_tokenizers_that_keep_blanks_are_refused():
    with pytest.raises(ValueError, match="one by one"):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(rows, source, max_length=2048):
    by_doc = {}
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= max_length and r.offset == 0 and 1 << r.bucket == r.length
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = Counter()
    for doc_id, text in source:
        ids = library_ids(text)
        start = 0
        for length in [max_length] * (len(ids) // max_length) + [1 << k for k in range(max_length.bit_length() - 2, -1, -1) if len(ids) >> k & 1]:
            want[(doc_id, start, length, crc(ids[start : start + length]), len(ids))] += 1
            start += length
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want


@pytest.mark.parametrize("max_length", [2048, 16, 1])
def test_pieces_are_binary_digits(spark, max_length):
    rows = ROWS if max_length > 1 else ROWS[:6]
    check_pieces(packed_digest(pack(frame(spark, rows), PATH, max_length=max_length)).collect(), rows, max_length)


def test_packing_of_the_supplied_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    check_pieces(packed_digest(pack(docs, PATH)).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("tokens", [4096, 64, 1])
def test_batches_are_rectangles_and_depend_on_the_rows_alone(spark, tokens):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").unionByName(frame(spark).select("doc_id", "text"))
    pieces = stored(pack(docs, PATH, max_length=512), "pieces")
    seen = []
    for partitions in (1, 5):
        rows = batches(pieces.repartition(partitions), tokens=tokens).collect()
        seen.append(Counter((r.batch, r.place, r.doc_id, r.start, bytes(r.ids)) for r in rows))
    assert seen[0] == seen[1] and len(rows) == pieces.count()
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r.batch, []).append(r)
    assert sorted(by_batch) == list(range(len(by_batch)))
    short = []
    for batch in sorted(by_batch):
        held = by_batch[batch]
        assert sorted(r.place for r in held) == list(range(len(held))) and len({r.length for r in held}) == 1
        if len(held) < max(1, tokens // held[0].length):
            short.append(held[0].length)
        assert len(held) <= max(1, tokens // held[0].length)
    lengths = [by_batch[b][0].length for b in sorted(by_batch)]
    assert lengths == sorted(lengths) and len(short) == len(set(short))


def test_batches_of_no_pieces(spark):
    assert batches(pack(frame(spark).where("false"), PATH)).count() == 0


def test_lengths_must_be_powers_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        pack(frame(spark), PATH, max_length=1000)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1003, dtype=np.uint32)
    assert (from_planes(to_planes(ids, planes), len(ids), planes) == ids).all()
    index, data = encode_segment(ids, planes, block=100)
    assert (decode_block(3, index, data, len(ids), planes, 100) == ids[300:400]).all()
    assert (decode_block(10, index, data, len(ids), planes, 100) == ids[1000:]).all()


@pytest.mark.parametrize(("planes", "shards", "segment"), [("byte", 1, 1 << 18), ("bit", 5, 50), ("byte", 40, 1)])
def test_files_give_back_the_ids_in_order(spark, planes, shards, segment):
    path = new_folder(spark, "tokens")
    write_token_files(frame(spark), path, PATH, planes=planes, block=64, segment=segment, shards=shards)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in read_token_files(spark, path).collect()]
    want, before = [], 0
    for doc_id, text in sorted(ROWS, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = library_ids(text)
        want.append((doc_id, before, len(ids), np.array(ids, dtype="<u4").tobytes()))
        before += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_table(spark):
    empty, path = frame(spark).where("false"), new_folder(spark, "tokens")
    assert pack(empty, PATH).count() == 0
    write_token_files(empty, path, PATH)
    assert read_token_files(spark, path).count() == 0
