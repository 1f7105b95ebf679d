import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import prose, rows_of

from leafmill.llm import ngram_join, substrings
from leafmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def groups(rows, similar=75):
    sets = [shingles(t) for _, t, *_ in rows]
    of = list(range(len(rows)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= similar * len(a | sets[j]):
                of[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, *_) in enumerate(rows)), key=repr)


def edited(text, seed, n):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**9)}"
    return " ".join(w)


def check(docs, rows):
    assert rows_of(ngram_join.join(docs(rows, clash=True)), "doc_id", "n_shingles", "component_id") == groups(rows)


def test_odd_rows(docs, odd_rows):
    check(docs, odd_rows)


def test_empty(docs):
    assert ngram_join.join(docs([])).count() == 0


def test_families_of_all_sizes(docs):
    rng = random.Random(4)
    rows = []
    for f in range(60):
        text = prose(f, rng.choice([1, 3, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200, 600]))
        for k in range(rng.randrange(1, 6)):
            n = len(text.split())
            copy = edited(text, f * 100 + k, rng.randrange(0, 1 + n // 18))
            rows.append((len(rows), copy.upper() if k == 2 else copy))
    check(docs, rows)


@pytest.mark.parametrize("edits", [2, 4, 5])
def test_large_family_at_the_edge(docs, edits):
    # Far more near copies than a key may have; at 4 and 5 edits many pairs lie about the threshold.
    text = prose(77, 120)
    rows = [(i, edited(text, i, edits)) for i in range(150)] + [(1000 + i, text) for i in range(80)]
    check(docs, rows + [(5000 + i, prose(300 + i, 100)) for i in range(20)])


def test_common_passage_links_nothing_by_itself(docs):
    passage = prose(9, 30)
    check(docs, [(i, prose(i, 12 + i % 50) + " " + passage) for i in range(120)])


def test_every_similar_pair_shares_a_key():
    rng = random.Random(1)
    for _ in range(150):
        base = prose(rng.random(), rng.choice([4, 6, 9, 15, 30, 70, 200]))
        pair = [base, edited(base, rng.random(), rng.randrange(0, 2 + len(base.split()) // 25))]
        a, b = map(shingles, pair)
        if not a & b or 100 * len(a & b) < 75 * len(a | b):
            continue
        sets = ngram_join.Sets(pa.array(pair), 5)
        keys = [set(), set()]
        for lower in (False, True):
            doc, key, *_ = ngram_join.keys_of(sets, np.array([True, True]), lower, 0.75)
            for d, k in zip(doc.tolist(), key.tolist()):
                keys[d].add(k)
        assert keys[0] & keys[1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)] + [(2000, 2000 + i) for i in range(1, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000} | {2000 + i: 2000 for i in range(300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(rows, length):
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, *_), w in zip(rows, words):
        gone = {i + k for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for k in range(length)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(docs, odd_rows):
    passage = prose(3, 60)
    rows = [r for r in odd_rows if r[0] not in (4, 5)] + [
        (20, prose(20, 50) + " " + passage + " " + prose(21, 50)),
        (21, passage.replace(" ", "\n") + " tail"),
        (22, prose(22, 10) + " " + " ".join(passage.split()[5:39]) + " x"),
        (23, prose(23, 10) + " " + " ".join(passage.split()[5:40]) + " x"),
        (24, "For " * 90),
        (25, "a b c " * 30 + prose(25, 40)),
        (26, prose(26, 34)),
        (27, prose(26, 34)),
        (28, prose(28, 35)),
        (28, prose(28, 35)),
        (28, prose(29, 80)),
        (29, prose(29, 80).upper()),
        (30, prose(30, 40) + " " + prose(31, 40) + " " + prose(30, 40)),
    ]
    got = rows_of(substrings.remove(docs(rows, clash=True)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == removed(rows, 35)


def test_repeats_at_random(docs):
    rng = random.Random(2)
    parts = [prose(i, rng.randrange(10, 60)) for i in range(25)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))) for i in range(120)]
    got = rows_of(substrings.remove(docs(rows)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == removed(rows, 35)
    assert substrings.remove(docs([])).count() == 0


def test_null_ids_are_keyed_by_text(docs):
    """Rows without ids are as many keys as distinct texts: results as with ids, and no join of all null rows."""
    passage = prose(9, 60)
    rows = [(None, prose(100 + i, 20) + " " + passage + " " + prose(200 + i, 20)) for i in range(150)]
    rows += [(None, prose(300 + i, 80)) for i in range(150)]
    rows += [(None, None), (None, ""), (None, rows[0][1])]
    got = rows_of(substrings.remove(docs(rows)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == removed(rows, 35)
    check(docs, rows)
    keyed = docs(rows).select(substrings._doc_key()).distinct().count()
    assert keyed == len({r[1] for r in rows})
