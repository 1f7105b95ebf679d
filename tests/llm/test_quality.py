import re
from collections import Counter

import numpy as np
import pytest
from llm_data import prose

from leafmill.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {i + k for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def test_statistics_of_odd_rows(docs, odd_rows):
    rows = [*odd_rows, (20, "a b\na b\n\n \na b c d e\na b c d e x", "en", "a"), (21, "For " * 40, "en", "a"), (22, "# | <x>", "en", "a")]
    got = quality.judge(docs(rows, clash=True)).collect()
    assert len(got) == len(rows)
    key = lambda i, s: (repr(i), s)
    assert sorted(key(r.doc_id, tuple(r[c] for c in quality.STATS)) for r in got) == sorted(key(r[0], brute(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_empty(docs):
    got = quality.judge(docs([]))
    assert got.count() == 0 and {"doc_id", "kept", "base_failed", *quality.STATS} <= set(got.columns)


def test_outliers_go_and_clean_documents_stay(docs):
    clean = [(i, prose(i, 60 + i % 300), "en", f"s{i % 3}") for i in range(600)]
    junk = [(1000 + i, " ".join(f"w{(i * 31 + k) % 977} #%" for k in range(80)), "en", "s1") for i in range(20)]
    kept = {r.doc_id for r in quality.judge(docs(clean + junk)).where("kept").collect()}
    assert kept == {i for i, *_ in clean}


def test_one_dimension_alone_can_reject(docs):
    # Lengths of the source differ by a fifth; one document is four hundred times as long and has nothing else odd.
    rows = [(i, prose(i, 60 + i % 15, 100_000), "en", "s") for i in range(600)]
    got = {r.doc_id: r for r in quality.judge(docs([*rows, (1000, prose(5, 26_000, 10_000_000), "en", "s")])).collect()}
    assert not got[1000].base_failed and not got[1000].kept
    assert sum(got[i].kept for i in range(600)) >= 598


def test_robust_estimate_is_near_the_bulk(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (4000, 5)) * [3, 2, 1, 1, 1] + 5, np.full((600, 5), 60.0)])
    rows = spark.createDataFrame(
        [("g", i % 8, *map(float, r)) for i, r in enumerate(x)] + [("all", i % 8, *map(float, r)) for i, r in enumerate(x)],
        "g string, salt int, x0 double, x1 double, x2 double, x3 double, x4 double",
    )
    p = quality.robust_groups(rows).where("g = 'g'").first()
    assert all(abs(p[f"m{i}"] - 5) < 0.3 for i in range(5))
    assert p["p00"] == pytest.approx(1 / (9 + quality.FLOORS[0] ** 2), rel=0.3)


def test_chi2():
    assert quality.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
