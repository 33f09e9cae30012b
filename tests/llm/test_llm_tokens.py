import random
import unicodedata
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, documents, edge_docs, empty_docs
from tokenizers import Tokenizer

from quarry.llm import byte_bpe, queries, token_count, token_store

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTS = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    [" ", "  ", "\n", "\r\n ", "'s", "don't", "the", "ing", "<|endoftext|>", "<|startoftext|>", "éü", "aaaa", "12", ".,", " "])), max_size=9)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tik(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ids, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return token_count.Counter(COUNTS)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_codec_equals_library(codec, tik, parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    ids = codec.encode(text)
    assert ids == tik.encode_ordinary(text)
    assert codec.decode(ids) == text


def test_transducer_long_runs_and_state_reset(codec, tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_STATES", 50)
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choice("aab") for _ in range(rnd.randint(1, 80)))
        assert codec.encode(text) == tik.encode_ordinary(text)
    assert len(codec.transducer.pending) < 500


def test_utf8_machine_holds_back_unfinished_characters():
    data = "aé€😀b".encode()
    for cut in range(len(data) + 1):
        m = byte_bpe.Utf8()
        first, second = m.feed(data[:cut]), m.feed(data[cut:])
        first.decode(), second.decode()
        assert first + second == data and not m.held


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 7))
def test_counts_equal_library_for_any_chunks(counter, parts, chunk):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    expected = len(LIBRARY.encode(text, add_special_tokens=False).ids)
    assert counter.text_count(text) == expected
    assert counter.count(text, chunk) == expected


LIBRARY = Tokenizer.from_file(COUNTS)


def test_chunk_maps_compose_associatively(counter):
    text = "the cat sat on the mat.\nIt's   12 o'clock <|endoftext|> now and then again"
    a, b, c = (counter.chunk_map(t) for t in (text[:20], text[20:41], text[41:]))
    left, right = counter.compose(counter.compose(a, b), c), counter.compose(a, counter.compose(b, c))
    total = lambda m: counter.text_count(m.head) + m.n + counter.text_count(m.tail or "")
    assert total(left) == total(right) == counter.text_count(text)


def test_op8_whole_table(spark, tik):
    rows = queries.QUERIES["op8_byte_bpe"](spark, SF).collect()
    text = documents().set_index("doc_id").text
    import hashlib
    assert len(rows) == len(text)
    for r in rows:
        ids = tik.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_op9_whole_table(spark):
    rows = queries.QUERIES["op9_token_counts"](spark, SF).collect()
    text = documents().set_index("doc_id").text
    for r in rows:
        n = len(LIBRARY.encode(text[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 1024)


def test_op4_files_hold_the_library_ids_in_order(spark):
    rows = queries.QUERIES["op4_token_store"](spark, SF).collect()
    t = Tokenizer.from_file(WORDS)
    text = documents().set_index("doc_id").text
    start = 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = [*t.encode(text[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def word_ids(encoder, texts):
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    assert len(sizes) == len(texts) and sizes.sum() == len(ids)
    return [a.tolist() for a in np.split(ids, np.cumsum(sizes)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=4))
def test_word_ids_equal_library(texts):
    texts = ["".join(p).encode("utf-8", "ignore").decode() for p in texts]
    t = Tokenizer.from_file(WORDS) if not hasattr(test_word_ids_equal_library, "t") else test_word_ids_equal_library.t
    test_word_ids_equal_library.t = t
    for got, text in zip(word_ids(token_store.encoder(WORDS), texts), texts, strict=True):
        assert got == t.encode(text, add_special_tokens=False).ids


def test_store_edge_rows_and_pruning(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    token_store.write_ids(edge_docs(spark), WORDS, path, end_id=2)
    stored = token_store.read_ids(spark, path)
    rows = stored.orderBy("start").collect()
    assert len(rows) == 12 and rows[0].doc_id is None
    assert [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert all(b.start == a.start + a.n_tokens for a, b in pairwise(rows))
    assert {r.doc_id: r.ids for r in rows if r.doc_id in (1, 2, 3)} == {1: [2], 2: [2], 3: [2]}
    plan = stored.where("doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan
    token_store.write_ids(empty_docs(spark), WORDS, f"{tmp_dir}/none", end_id=2)
    assert token_store.read_ids(spark, f"{tmp_dir}/none").count() == 0


def test_token_operators_edge_rows(spark):
    enc = byte_bpe.encode(edge_docs(spark), RANKS, public_tokenizers.PATTERN)
    n = {r.doc_id: r.n_tokens for r in enc.collect()}
    assert len(n) == 11 and n[1] == n[2] == 0 and n[7] > 20_000
    counts = token_count.count_tokens(edge_docs(spark), COUNTS).collect()
    assert len(counts) == 12
    by = {r.doc_id: r for r in counts}
    assert (by[1].n_bytes, by[1].n_tokens, by[7].over_limit) == (0, 0, True)
    assert enc.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert byte_bpe.encode(empty_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_count.count_tokens(empty_docs(spark), COUNTS).count() == 0


def test_store_ids_of_every_letter_beside_a_mark():
    """All alphabetic characters, alone and in words, before and after marks: as the library gives them."""
    import sys

    from tokenizers import Tokenizer

    from quarry.llm import token_store

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_store.Encoder(path)
    letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha() and not 0x3400 <= c <= 0xD7A3 and c < 0x1F000]
    odd = [c for c in letters if len(c.lower()) > 1 or unicodedata.normalize("NFC", c) != c]
    assert "\u0130" in odd
    texts = [" ".join(f"{c}, a{c}. {c}b {c}\u0301," for c in letters[i:i + 50]) for i in range(0, len(letters), 50)]
    texts += [f"{c}," for c in odd] + [f"x{c}y. {c}" for c in odd]
    got = word_ids(own, texts)
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [t for t, g, w in zip(texts, got, want) if g != w] == []


def test_other_operators_give_codecs_back():
    """A worker that goes on with another operator's task holds no codec of an earlier one."""
    class Taken:
        def mapInArrow(self, fn, schema):
            return list(fn(iter([])))

    byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    byte_bpe.small_batches(Taken(), lambda batches: iter(batches), "x long", codecs=True)
    assert byte_bpe.codec.cache_info().currsize == 1
    byte_bpe.small_batches(Taken(), lambda batches: iter(batches), "x long")
    assert byte_bpe.codec.cache_info().currsize == 0
