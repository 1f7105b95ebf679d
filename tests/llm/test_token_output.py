import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import prose
from tokenizers import Tokenizer

from leafmill.llm import frames, token_output
from leafmill.llm.scratch import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
FULL = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return token_output.Encoder(PATH, 2)


def direct(text):
    return [*FULL.encode(text or "", add_special_tokens=False).ids, 2]


def split(encoder, texts):
    texts = ["" if t is None else t for t in texts]
    ids, counts = encoder(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aBcÉéßİıΣσς ñ.,!?'’́  \x1c\x85\t\n1２%#×÷»«\U0001f600<|>startofx", max_size=40), min_size=1, max_size=4))
def test_same_ids_as_the_whole_text(encoder, texts):
    assert split(encoder, texts) == [direct(t) for t in texts]


def test_special_strings_and_forgetting(encoder, monkeypatch):
    texts = ["it's <|endoftext|> now", "<|ENDOFTEXT|>", "we'll can't THE, the. The!", "", None, prose(1, 3000)]
    assert split(encoder, texts) == [direct(t) for t in texts]
    monkeypatch.setattr(token_output, "_CACHE_WORDS", 10)
    assert split(encoder, texts) == [direct(t) for t in texts]


def test_known_checksums():
    data = b"123456789" + bytes(32) + bytes(range(256)) * 20
    spans = [(0, 9), (9, 41), (41, len(data)), (41, 45)]
    starts, ends = np.array(spans).T

    def slow(raw):
        c = 0xFFFFFFFF
        for b in raw:
            c ^= b
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    got = frames.crc32c(np.frombuffer(data, np.uint8), starts, ends).tolist()
    assert got[:2] == [0xE3069283, 0x8A9136AA] and got == [slow(data[a:b]) for a, b in spans]


def test_files(spark, docs, odd_rows):
    df = docs(odd_rows, clash=True)
    path = new_path(spark, "test-tokens")
    token_output.write(df, path, PATH, file_bytes=100_000)
    index = token_output.write_index(spark, path, new_path(spark, "test-index"))
    got = token_output.positions(index).orderBy("start").collect()
    assert [r.doc_id is None for r in got] == sorted((i is None for i, *_ in odd_rows), reverse=True)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    expected = sorted(((i, len(direct(t)), zlib.crc32(np.array(direct(t), "<u4"))) for i, t, *_ in odd_rows), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == expected
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    some = token_output.read_records(spark, path, index.where("doc_id in (7, 9)")).collect()
    assert sorted((r.doc_id, r.ids) for r in some) == sorted((i, direct(t)) for i, t, *_ in odd_rows if i in (7, 9))


def test_empty(spark, docs):
    path = new_path(spark, "test-tokens")
    token_output.write(docs([]), path, PATH)
    assert token_output.positions(token_output.write_index(spark, path, new_path(spark, "test-index"))).count() == 0


def test_flipped_bytes_are_found():
    frame = frames.encode(np.array([5]), np.array([False]), np.arange(10, dtype="<u2"), np.array([10]))[0].as_py() + b"\n"
    for at in range(len(frame) - 1):
        broken = bytearray(frame)
        broken[at] ^= 4
        data = np.frombuffer(bytes(broken), np.uint8)
        with pytest.raises(ValueError, match="checksum"):
            frames.check(data, np.array([0]), np.array([len(data)]))
