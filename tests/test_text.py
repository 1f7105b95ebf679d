import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leafmill.functions import text as T
from leafmill.functions.core import WS


def test_decode(column):
    data = [b"plain", "é漢".encode(), b"\xef\xbb\xbfbom", b"a\xffb", b"\xe2\x82", b"", "\ufeff\ufeffx".encode()]
    got = column([bytearray(b) for b in data], "binary", T.decode_text)
    assert got == ["plain", "é漢", "bom", "a\ufffdb", "\ufffd", "", "\ufeffx"]


def test_clean(column):
    cases = {
        "a\r\nb\rc\r\r\nd": "a\nb\nc\n\nd",
        "a\t\tb\tc": "a b c",
        "a  \nb \t \nc": "a\nb\nc",
        "a\n\nb": "a\n\nb",
        "a\n\n\nb\n\n\n\nc": "a\n\nb\n\nc",
        "\u00a0\ufeff x \u3000\n": "x",
        "a \u2028b": "a\u2028b",
        "in  side": "in  side",
        "a\n \n \n\nb": "a\n\nb",
        "": "",
    }
    assert column(list(cases), "string", T.clean_text) == list(cases.values())


def test_counts_and_sizes(column):
    texts = ["", "\x00\x01\x1f", "a\u00a0b", " one  two\tthree\n", "a\x01b", "\u0085", "\u2003x\u200by\u3000"]
    assert column(texts, "string", T.word_count) == [0, 0, 2, 3, 2, 1, 1]
    sizes = [0, 1023, 1024, 1280, 1048575, 1048576, 3 * 1048576 + 52429]
    assert column(sizes, "bigint", T.size_label) == ["0 B", "1023 B", "1.0 KB", "1.3 KB", "1024.0 KB", "1.0 MB", "3.1 MB"]
    assert column([0, 999, 1000, 1234567], "bigint", T.int_label) == ["0", "999", "1,000", "1,234,567"]


def test_truncation(column):
    texts = ["x" * 9, "x" * 10, "x" * 11]
    note = "x" * 10 + "\n\n[... truncated at 10 chars. Total available: 11 chars]"
    got = column(texts, "string", lambda c: T.truncate_note(c, 10))
    assert [tuple(r) for r in got] == [
        ("x" * 9, False, 9, 9),
        ("x" * 10, False, 10, 10),
        (note, True, 11, len(note)),
    ]
    got = column(texts, "string", lambda c: T.truncate_plain(c, 10))
    assert [tuple(r) for r in got] == [("x" * 9, False, 9, 9), ("x" * 10, False, 10, 10), ("x" * 10, True, 11, 10)]
    for unlimited in (0, -1):
        for fn in (T.truncate_note, T.truncate_plain):
            got = column(texts, "string", lambda c: fn(c, unlimited))
            assert [tuple(r) for r in got] == [(t, False, len(t), len(t)) for t in texts]


def test_strip_markup(column):
    xml = '<?xml version="1.0"?>\n<r>\n  <a x="1">one</a>\n \n\n<b>two &amp; three</b><![CDATA[x]]>\n</r>'
    assert column([xml], "string", T.strip_markup) == ["one\n two &amp; three"]


_ALPHABET = st.sampled_from(list("ab \t\r\n\x00\x1f\u00a0\u0085\u2028\u3000\ufeffé漢"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(_ALPHABET, max_size=30), min_size=40, max_size=40))
def test_properties(column, texts):
    cleaned = column(texts, "string", T.clean_text)
    assert column(cleaned, "string", T.clean_text) == cleaned
    counts = column(texts, "string", T.word_count)
    assert counts == column(cleaned, "string", T.word_count)
    assert counts == [len(re.findall(f"[^\x00-\x20{WS}]+", t)) for t in texts]
    for t, r in zip(texts, column(texts, "string", lambda c: T.truncate_note(c, 7))):
        assert r.truncated == (r.total_chars > 7) and r.total_chars == len(t) and r.returned_chars == len(r.text)
