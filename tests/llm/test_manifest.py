"""The Merkle manifest against a plain Python tree."""

import hashlib
import zlib

import pytest
from llm_data import prose, rows_of

from leafmill.llm import manifest as mf


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute(rows, fanout=16):
    """{row index: (doc_id, leaf, subroot, root, proof, folded_root, verified)} for (doc_id, text, lang, source, n_chars)."""

    def leaf(doc_id, text, lang, source, n_chars):
        return H("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([H("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
        return levels

    def climb(levels, at, own):
        siblings, folded = [], own
        for nodes in levels[:-1]:
            start = at - at % fanout
            run = nodes[start : start + fanout]
            siblings += [d for j, d in enumerate(run) if start + j != at]
            folded = H("".join(folded if start + j == at else d for j, d in enumerate(run)))
            at //= fanout
        return siblings, folded

    by_source = {}
    for i, (doc_id, text, lang, source, n_chars) in enumerate(rows):
        by_source.setdefault(source, []).append((doc_id, leaf(doc_id, text, lang, source, n_chars), i))
    sources = sorted(by_source, key=lambda s: (s is not None, s.encode() if s is not None else b""))
    trees, places = {}, {}
    for s in sources:
        ordered = sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in ordered])
        for at, x in enumerate(ordered):
            places[x[2]] = (s, at)
    top = tree([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    out = {}
    for i, (doc_id, text, lang, source, n_chars) in enumerate(rows):
        s, at = places[i]
        own = trees[s][0][at]
        flip = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        changed = leaf(doc_id, None if text is None else text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), lang, source, n_chars) if flip else own
        low, folded = climb(trees[s], at, changed)
        high, folded = climb(top, sources.index(s), folded)
        _, plain = climb(trees[s], at, own)
        out[i] = (doc_id, own, trees[s][-1][0], root, H("".join(low + high)), folded, folded == root)
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def check(docs, rows, fanout, monkeypatch, clash=False):
    monkeypatch.setattr(mf, "FANOUT", fanout)
    got = rows_of(mf.manifest(docs(rows, clash=clash)), *COLUMNS)
    want = sorted(brute([(*r, *(None, None)[len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows], fanout).values(), key=repr)
    assert got == want


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_odd_rows(docs, odd_rows, fanout, monkeypatch):
    """Nulls everywhere, repeated rows, very long texts, null source first, clashing names."""
    check(docs, odd_rows, fanout, monkeypatch, clash=True)


def test_many_levels_and_sources(docs, monkeypatch):
    rows = [(i, f"Text {i} " + prose(i, 20) + (" UPPER" if i % 3 else ""), "en", f"s{i % 7}" if i % 11 else None) for i in range(300)]
    rows += [(1000 + i, "Lone ONE", "en", f"lone{i}") for i in range(5)]  # sources of one leaf
    rows += [(5, "Text 5", "en", "s5"), (None, "Nulled ID", "en", "s1")]
    check(docs, rows, 3, monkeypatch)
    check(docs, rows, 16, monkeypatch)


def test_single_and_empty(docs, spark, monkeypatch):
    check(docs, [(7, "Only One", "en", "a")], 16, monkeypatch)
    out = mf.manifest(docs([(7, "Only One", "en", "a")])).first()
    assert out.leaf == out.subroot == out.root and out.proof_sha256 == H("")
    assert mf.manifest(docs([]).where("doc_id > 0")).count() == 0


def test_sample_table(spark, monkeypatch):
    """All of sf0.001 against the plain tree."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in table.collect()]
    got = rows_of(mf.manifest(table), *COLUMNS)
    assert got == sorted(brute(rows).values(), key=repr)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
