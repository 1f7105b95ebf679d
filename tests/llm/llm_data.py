"""Rows and helpers of the tests of this folder."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or in their results.
CLASHES = (
    "size shard slot law key range sub row score predicted held_out copies taken target pattern order bin salt g kept base hash0 hash1 "
    "cuts id rep component_id n_words distance item_id label toxic words bucket"
).split()


def clashing(df):
    """The table with columns of many names that operators use."""
    return df.withColumns({c: F.lit(-7) for c in CLASHES if c not in df.columns})


def prose(seed, n, vocabulary=4000):
    """n words drawn by a seed."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
