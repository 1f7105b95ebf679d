import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0bé \U0001f600.", max_size=60)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_split_and_hash(texts):
    w = words.split(pa.array(texts, pa.string()))
    expected = [x for t in texts for x in WORD.findall(t or "")]
    raw = w.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(w.starts, w.ends)] == expected
    assert w.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]
    for seed in (0, 1):
        of = {}
        for word, h in zip(expected, w.hashes(seed).tolist()):
            assert of.setdefault(word, h) == h
        assert len(set(of.values())) == len(of)


def test_windows_stay_inside_texts_and_hash_by_content():
    w = words.split(pa.array(["a b c d", "a b", None, "b c d a b c"]))
    at = w.windows(3)
    assert at.tolist() == [0, 1, 6, 7, 8, 9]
    h = words.span_hashes(w.hashes(), at, at + 3, 0).tolist()
    assert h[1] == h[2] and h[0] == h[5] and len(set(h)) == 4


def test_stretches_do_not_show(monkeypatch):
    values = np.arange(1, 400, dtype=np.uint64)
    starts = np.arange(0, 390)
    whole = words.span_hashes(values, starts, starts + 7, 1)
    monkeypatch.setattr(words, "_STRETCH", 16)
    assert (words.span_hashes(values, starts, starts + 7, 1) == whole).all()
