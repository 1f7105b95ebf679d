import random

import numpy as np
import pyarrow as pa
import pytest
from llm_data import prose
from pyspark.sql import functions as F

from leafmill.llm import toxicity as tox

INSULTS = ["blockhead", "nitwit", "scoundrel"]


def bad(seed, insult=None, n=40):
    rng = random.Random(seed)
    w = prose(seed, n, 600).split()
    w.insert(rng.randrange(n), insult or INSULTS[seed % 3])
    return " ".join(w) + "."


@pytest.fixture(scope="module")
def model():
    return tox.train([bad(i) for i in range(150)], [prose(5000 + i, 40, 600) for i in range(400)])


def predicted(model, texts):
    return (model.score(tox.document_maximum(pa.array(texts, pa.string()), model.table(), model.bias)) >= 0.5).tolist()


def test_held_out_documents(model):
    toxic = predicted(model, [bad(1000 + i) for i in range(60)])
    clean = predicted(model, [prose(9000 + i, 40, 600) for i in range(60)])
    assert sum(toxic) >= 58 and sum(clean) <= 1


def test_bent_insults(model):
    texts = [prose(1, 30, 600) + f" {x} " + prose(2, 30, 600) for x in ("BLOCKHEAD!!", "block-head", "n i t w i t", "scoun0drel", "nit.wit")]
    assert all(predicted(model, texts))


def test_odd_texts(model):
    texts = [None, "", " \n", "###", "x" * 50_000, prose(3, 20_000, 600) + " nitwit"]
    assert predicted(model, texts) == [False, False, False, False, False, True]
    assert len(predicted(model, [])) == 0


def test_folded_table_equals_landmark_kernel():
    marks = [b"blockhead", b"nitwit", b"w12"]
    base = tox._Landmarks(marks)
    alpha = np.array([0.5, -1.0, 2.0])
    table = np.zeros(tox._TABLE)
    places, values = base.fold(alpha)
    table[places] = values
    strings = [b"blockhead", b"blokhead", b"nit", b"w12", b"zzz", b"a"]
    assert tox._values(strings, table, -0.25) == pytest.approx(base.kernel(strings) @ alpha - 0.25, abs=1e-5)


def test_kernel_is_larger_for_nearer_strings():
    k = tox._Landmarks([b"scoundrel"]).kernel([b"scoundrel", b"scou0ndrel", b"scandal", b"table"])[:, 0]
    assert k[0] > k[1] > k[2] > k[3] == 0


def test_untrained_models_call_nothing_toxic():
    for toxic, clean in (([], []), (["nitwit"], []), ([], ["x"]), (["a b c"], ["a b c"])):
        assert predicted(tox.train(toxic, clean), ["nitwit", "a b c"]) == [False, False]


def test_fit_and_score(spark, docs, odd_rows):
    rows = [(i, bad(i) if i % 3 == 0 else prose(i, 40, 600)) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(600)] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    df = docs(rows, clash=True)
    model = tox.fit(df, labels)
    got = tox.score(df, model).withColumn("held", tox.held_out()).where("held").collect()
    assert len(got) > 60 and np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    odd = docs(odd_rows, clash=True)
    assert tox.score(odd, model).count() == len(odd_rows)
    kept = tox.without_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert tox.score(docs([]), model).count() == 0
    assert tox.fit(docs([]), labels).places.size == 0
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (tox.fit(df, flipped).values == model.values).all()


def test_insults_split_by_blanks(model):
    texts = [prose(1, 30, 600) + f" {x} " + prose(2, 30, 600) for x in ("n  i  t  w  i  t", "s\tc o  u n\nd r e l", "nit wit", "scoun drel")]
    assert all(predicted(model, texts))
    # A line break of another kind of blank is no part of a word, and an empty line parts sentences.
    assert not any(predicted(model, [prose(1, 30, 600) + f" {x} " + prose(2, 30, 600) for x in ("n i", "scou\n\nnd")]))


def test_sentences_of_ordinary_words():
    # Every word of the phrase is common in clean documents; only the phrase tells.
    def text(seed, toxic):
        rng = random.Random(seed)
        lines = [[f"w{rng.randrange(200)}" for _ in range(8)] for _ in range(5)]
        for line in lines:
            line.insert(rng.randrange(9), rng.choice(["nobody", "wants", "here"]))
        if toxic:
            lines[rng.randrange(5)][3:3] = ["nobody", "wants", "you", "here"]
        else:
            lines[rng.randrange(5)][3:3] = ["you"]
        return " ".join(" ".join(line) + "." for line in lines)

    model = tox.train([text(i, True) for i in range(150)], [text(1000 + i, False) for i in range(300)])
    assert sum(predicted(model, [text(5000 + i, True) for i in range(50)])) >= 48
    assert sum(predicted(model, [text(7000 + i, False) for i in range(50)])) <= 2
    # Not across the end of a sentence.
    assert predicted(model, ["w1 w2 w3 nobody wants you here w4.", "w1 w2 w3 nobody wants. You w7. Here w4."]) == [True, False]


def test_letters_beyond_ascii_differ():
    points = np.array([ord(x) for x in "дурюсéßü"])
    assert len(set(tox._classes(points).tolist())) == len(points)
    a, b = (tox._Landmarks(["дурак".encode()]).kernel([x.encode()])[0, 0] for x in ("дурак", "шыфжц"))
    assert a > 0.5 and b == 0


def test_a_few_wrong_labels_change_little():
    # Two in a hundred clean labels stand on toxic documents; each insult is thus in some clean-labelled document.
    toxic, clean = [bad(i) for i in range(150)], [prose(5000 + i, 40, 600) for i in range(400)]
    model = tox.train(toxic, clean + [bad(3000 + i) for i in range(9)])
    assert sum(predicted(model, [bad(1000 + i) for i in range(60)])) >= 58
    assert sum(predicted(model, [prose(9000 + i, 40, 600) for i in range(60)])) <= 1


def test_long_labelled_texts_stay_within_the_character_bound(spark, docs):
    """Labelled texts of a megabyte: the fit runs in a task and passes over what its character bound leaves out."""
    rows = [(i, bad(i) if i % 3 == 0 else prose(i, 40, 600)) for i in range(300)]
    rows += [(1001, prose(7, 200_000, 600)), (1002, (bad(3) + " ") * 20_000)]  # about a megabyte each
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(300)] + [(1001, 0, 0), (1002, 0, 1)], "doc_id long, quality int, toxic int")
    df = docs(rows)
    small = tox.fit(df, labels, most_chars=300_000)
    whole = tox.fit(df, labels)
    for model in (small, whole):
        got = tox.score(df, model).withColumn("held", tox.held_out()).where("held AND doc_id < 300").collect()
        assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in got]) > 0.9
