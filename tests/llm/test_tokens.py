"""Token ids, token files and packing against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from quirefold.llm import eliasfano, packing, tokenfiles
from quirefold.llm.tokens import Encoder, byte_bpe, encoder

EDGE = ["", " ", "a", "  two  spaces", "line\n break \n x", "<|endoftext|> is a token", "hi <|endoftext|> there", "x<|endoftext|>,y <|endoftext|>", "é ß 中文 😀", "don't we'll", "word " * 5000]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(byte_bpe())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text) for k, text in enumerate(EDGE)] + [(100, None), (101, "again"), (101, "again"), (None, "no id")]
    return spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, start string")


def test_ids_equal_the_tokenizers(plain):
    draw = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "Zq", "9", "'s", ".", "é", "中", "\x1c", "\x85", "\xa0", " ?", "\r\n", "😀", "​"]
    texts = EDGE + ["".join(draw.choices(parts, k=draw.randrange(40))) for _ in range(2000)]
    for text in texts:
        assert np.frombuffer(encoder(byte_bpe()).ids(text), "<u4").tolist() == plain(text), repr(text)


def test_elias_fano_round_trip():
    draw = np.random.default_rng(3)
    for values in ([], [0], [5], [0, 0, 0], [1, 1 << 40], np.cumsum(draw.integers(0, 3000, 5000)), np.sort(draw.integers(0, 60, 3000))):
        packed = eliasfano.EliasFano.from_bytes(eliasfano.EliasFano.encode(np.array(values, "<u8")).to_bytes())
        assert packed.decode().tolist() == list(values)
        assert [packed.select(i) for i in range(len(values))] == list(values)
    dense = np.cumsum(draw.integers(1, 3000, 20000))
    bits = 8 * len(eliasfano.EliasFano.encode(dense.astype("<u8")).to_bytes()) / len(dense)
    assert bits < 2.2 + np.log2(1500)
    with pytest.raises(ValueError, match="decrease"):
        eliasfano.EliasFano.encode(np.array([2, 1], "<u8"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_all_ids_in_order(spark, docs, plain, tmp_path):
    manifest = tokenfiles.write_token_files(docs, f"file://{tmp_path}/ids", byte_bpe())
    rows = sorted(tokenfiles.read_token_files(manifest).collect(), key=lambda r: r.start)
    wanted = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start = 0
    for row, doc in zip(rows, wanted, strict=True):
        ids = [*plain(doc.text), 0]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_no_documents_no_files(docs, tmp_path):
    manifest = tokenfiles.write_token_files(docs.limit(0), f"{tmp_path}/none", byte_bpe())
    assert tokenfiles.read_token_files(manifest).count() == 0


def check_pieces(rows, texts, plain, longest=2048):
    """Every id of every document once, sequences gapless and not too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = [*plain(texts[doc]), 1]
        at = 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == crc(ids[at : at + piece.length])
            at += piece.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at and piece.length > 0
            at += piece.length
        assert at <= longest
        padding += 0 if at & (at - 1) == 0 else longest - at
    return padding, len(by_sequence)


def test_packing_places_every_id_once(docs, plain):
    rows = docs.filter("doc_id <> 101").union(docs.filter("doc_id = 101").limit(1))
    found = packing.pack(rows, byte_bpe(), with_ids=False).collect()
    check_pieces(found, {r.doc_id: r.text for r in rows.collect()}, plain)


def test_packing_wastes_little(spark, plain):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    found = packing.pack(rows, byte_bpe()).collect()
    texts = {r.doc_id: r.text for r in rows.collect()}
    padding, _ = check_pieces(found, texts, plain)
    assert padding < 2048
    assert {r.context for r in found} == set(packing.TIERS)
    assert all(crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in found)


def test_packing_bounds_its_buffer(plain):
    documents = [((k,), np.arange(k * 7 % 3000 + 1, dtype="<u4").tobytes()) for k in range(400)]
    lists = list(packing.sequences(documents, packing.TIERS, 20_000))
    assert len(lists) > 10
    sizes = [sum(p[3] for p in pieces) for done in lists for _, pieces in done]
    assert sum(sizes) == sum(len(ids) // 4 for _, ids in documents)
    assert all(size in packing.TIERS for size in sizes[:-1])


def test_step_groups_are_balanced():
    sizes = [2048] * 100 + [256] * 400 + [1024] * 57
    groups = packing.step_groups(sizes, 2048, 10)
    loads = defaultdict(int)
    for size, group in zip(sizes, groups, strict=True):
        loads[group] += size
    assert max(loads.values()) - min(loads.values()) <= 2048
    assert min(loads) == 10


def test_nothing_to_pack(docs):
    assert packing.pack(docs.limit(0), byte_bpe()).count() == 0


def test_words_with_punctuation_and_line_feeds_take_the_short_way():
    encode = Encoder(byte_bpe())
    texts = ["Start les&&& an.\nSur%%% été,\nLE!! end.", "don't a's x\n\ny z\r\nw <|endoftext|> a<|endoftext|>b ²x tab\tc", "one\ntwo"]
    assert [encode.ids(t) for t in texts] == [encode.encode([t])[0] for t in texts]
    asked = []
    slow, encode.encode = encode.encode, lambda some: asked.extend(some) or slow(some)
    encode.ids("Begin les&&& in.\nOn%%% oté,\nla!! fin.")
    assert not asked  # the tails are known, the rest is letters
