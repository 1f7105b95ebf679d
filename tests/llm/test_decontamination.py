import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import clashing, prose, rows_of

from leafmill.llm import decontamination as dec


def distances(item, text):
    """Least edit distance of the item to any substring, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=20), st.text("abc", max_size=60), st.integers(0, 6))
def test_bit_parallel_distance(item, text, budget):
    budget = min(budget, len(item) - 1)  # the empty substring is no occurrence
    got, best = dec.Pattern(item).best(text, budget), distances(item, text)
    assert (got[0] if got else None) == (best if best <= budget else None)


@pytest.mark.parametrize("seed", range(30))
def test_no_occurrence_within_budget_is_missed(seed):
    rng = random.Random(seed)
    items = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(20, 70))).strip() for _ in range(4)]
    texts = []
    for _ in range(12):
        item = list(rng.choice(items))
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["x"], ["a", "b"]])
        texts.append("".join(rng.choice("abcd ") for _ in range(30)) + "".join(item) + "dcba " * 4)
    m = dec.Matcher(list(enumerate(items)), 0.1)
    for text in map(dec.normal, texts):
        expected = {}
        for k, item in enumerate(map(dec.normal, items)):
            d = distances(item, text)
            if d <= int(len(item) * 0.1):
                expected[k] = d
        assert {k: d for k, d, _, _ in m.find(text)} == expected


ITEM = "What is the name of the river that runs through the old town of Prague and under its stone bridge?"


def planted():
    edited = ITEM.replace("river", "rivr").replace("stone", "stony")
    return [
        (1, prose(1, 50) + " " + ITEM + " " + prose(2, 50)),
        (2, ITEM.upper().replace(" ", "\n ")),
        (3, prose(3, 20) + " " + edited),
        (4, ITEM[: len(ITEM) // 2] + " " + prose(4, 60)),
        (5, prose(5, 200)),
    ]


def test_planted_passages(spark, docs):
    items = spark.createDataFrame([(10, ITEM), (11, ITEM), (12, None), (13, "  "), (14, prose(9, 30))], "item_id long, text string")
    for block in (1 << 20, 64):
        got = dec.leaks(docs(planted(), clash=True), clashing(items), block_bytes=block)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, i) for d in (1, 2, 3) for i in (10, 11)}
        assert {r.doc_id: r.distance for r in got.collect()} == {1: 0, 2: 0, 3: 2}


def test_odd_rows_and_empty_tables(spark, docs, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    df = docs(odd_rows, clash=True)
    assert dec.leaks(df, none).count() == 0 and dec.leaks(docs([]), items).count() == 0
    found = rows_of(dec.leaks(df, items), "doc_id", "item_id")
    assert found == [(7, 1), (7, 1), (None, 1)]
    kept = dec.decontaminate(df, items)
    assert kept.columns == df.columns and kept.count() == len(odd_rows) - 3
    assert dec.decontaminate(df, none).count() == len(odd_rows)
