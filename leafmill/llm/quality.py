"""Quality by robust multivariate outliers.

Five statistics of every whole text are transformed to a vector. Per language and source, the minimum covariance
determinant estimate of centre and scatter is found by concentration steps over all documents: distances, the share
of the rows that lie nearest, their moments, again. Each step is two aggregations of narrow rows with partial sums, so
a source that holds a third of all rows is no hot task. Documents whose squared Mahalanobis distance exceeds the
cut-off are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm import words
from leafmill.llm.scratch import keep

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"

DIMS = ("x0", "x1", "x2", "x3", "x4")
# Standard deviation of a dimension in which the nearest rows do not differ at all, so that it can be inverted: a few
# symbols, a repeated line or a repeated passage are no outlier by themselves. It fades as the estimate itself grows to it.
FLOORS = (0.02, 0.02, 0.3, 0.35, 0.35)
# Share of the pooled robust scatter that is added to that of each group.
_RIDGE = 0.01
_PAIRS = list(combinations_with_replacement(range(len(DIMS)), 2))
_POOLED = "all"
_SALTS = 8


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _repeated(w: words.Words, length: int) -> np.ndarray:
    """For each word, whether a window over it occurs twice or more in its text."""
    at = w.windows(length)
    row = w.rows()[at].astype(np.uint64)
    value = words.span_hashes(w.hashes(), at, at + length, 0)
    value = words.mix(value ^ words.mix(row + np.uint64(1)))
    _, which, n = np.unique(value, return_inverse=True, return_counts=True)
    hits = at[n[which] > 1]
    cover = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + length, -1)
    return np.cumsum(cover[:-1]) > 0


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and STATS (long) of every whole text; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            w = words.split(text)
            points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
            out = [
                w.counts,
                _sums(points[w.ends] - points[w.starts], w.first),
                _sums(_IS_SYMBOL[w.data], w.offsets),
                np.array([_dup_lines(t) for t in pc.fill_null(text, "").to_pylist()], np.int64),
                _sums(_repeated(w, 5), w.first),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(x.astype(np.int64)) for x in out],
                ["doc_id", "lang", "source", *STATS],
            )

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in STATS)
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text").mapInArrow(
        run, schema
    )


def vector() -> list[Column]:
    """Log length, log mean word length, symbols a word, repeated lines, share of repeated words."""
    n = F.col("n_words") + F.lit(1.0)
    return [
        F.log(n),
        F.log((F.col("word_chars") + 5) / n),
        F.log1p(10.0 * F.col("n_symbols") / n),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.log1p(10.0 * F.col("n_repeat_words") / n),
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function for odd k."""
    p = math.erf(math.sqrt(x / 2))
    for j in range(1, k, 2):
        p -= (x / 2) ** (j / 2) * math.exp(-x / 2) / math.gamma(j / 2 + 1)
    return p


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return lo


def distance() -> Column:
    """Squared Mahalanobis distance of DIMS under the group's centre m* and precision p**."""
    gap = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(DIMS)]
    out = F.lit(0.0)
    for i, j in _PAIRS:
        out = out + F.col(f"p{i}{j}") * gap[i] * gap[j] * (1.0 if i == j else 2.0)
    return out


_PARAMS = "g string, n double, " + ", ".join(f"m{i} double" for i in range(len(DIMS))) + "".join(f", p{i}{j} double" for i, j in _PAIRS)


def _precision(center: np.ndarray, scatter: np.ndarray, pooled: np.ndarray) -> dict:
    scatter = scatter + _RIDGE * pooled
    inverse = np.linalg.inv(scatter + np.diag(np.maximum(0.0, np.square(FLOORS) - np.diag(scatter))))
    return {f"m{i}": center[i] for i in range(len(DIMS))} | {f"p{i}{j}": inverse[i, j] for i, j in _PAIRS}


def _concentrate(moments: DataFrame, scale: float, prior: float) -> DataFrame:
    """Group parameters from the moments of its nearest rows; small groups are drawn to the pooled estimate.

    prior is the number of pooled pseudo-documents, so the weight falls smoothly as a group grows.
    """
    k = len(DIMS)

    def estimate(row: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        center = np.array([row[f"s{i}"] for i in range(k)]) / row["n"]
        scatter = np.zeros((k, k))
        for i, j in _PAIRS:
            scatter[i, j] = scatter[j, i] = row[f"q{i}{j}"] / row["n"] - center[i] * center[j]
        return center, scatter * scale

    pooled = moments.where(F.col("g") == _POOLED).toPandas()  # one row

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        center0, scatter0 = estimate(pooled.iloc[0])
        for frame in frames:
            out = []
            for _, row in frame.iterrows():
                center, scatter = estimate(row)
                if row["g"] != _POOLED:
                    share = prior / (row["n"] + prior)
                    gap = (center - center0)[:, None]
                    scatter = (1 - share) * scatter + share * scatter0 + share * (1 - share) * gap * gap.T
                    center = (1 - share) * center + share * center0
                out.append({"g": row["g"], "n": row["n"], **_precision(center, scatter, scatter0)})
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PARAMS.split(", ")])

    return moments.mapInPandas(run, _PARAMS)


def _with(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the columns of their group, which is repeated per salt so that no group is one task."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.join(salted, ["g", "salt"])


def _moved(new: DataFrame, old: DataFrame) -> bool:
    """Whether the centre of any group moved by more than a hundredth of its spread; quantiles are no more exact."""
    gaps = [
        F.abs(new[f"s{i}"] / new["n"] - old[f"s{i}"] / old["n"])
        > 0.01 * F.sqrt(F.greatest(new[f"q{i}{i}"] / new["n"] - F.pow(new[f"s{i}"] / new["n"], 2), F.lit(FLOORS[i] ** 2)))
        for i in range(len(DIMS))
    ]
    return not new.join(old, new["g"] == old["g"]).where(reduce(or_, gaps)).isEmpty()


def robust_groups(rows: DataFrame, share: float = 0.75, steps: int = 20, prior: float = 50.0) -> DataFrame:
    """Centre and precision per group g over rows (g, salt, DIMS), each row also counted in the pooled group.

    Starts from medians and median absolute deviations, then takes concentration steps until the nearest rows stay the same,
    at most that many. With share of the rows kept in
    a step, scatter is rescaled to be consistent for normal data.
    """
    k = len(DIMS)
    median = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(DIMS)])
    spread = _with(rows, median).groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(k)],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i, x in enumerate(DIMS)],
    )
    params = spread.select(
        "g",
        *[f"m{i}" for i in range(k)],
        *[(1 / F.greatest(F.pow(1.4826 * F.col(f"d{i}"), 2), F.lit(FLOORS[i] ** 2)) if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in _PAIRS],
    )
    cut = chi2_quantile(share, k)
    scale = share / chi2_cdf(cut, k + 2)
    before = None
    for step in range(steps):
        far = _with(rows, params).select("g", "salt", *DIMS, distance().alias("d"))
        near = far.groupBy("g").agg(F.percentile_approx("d", share, 1000).alias("limit"))
        moments = (
            _with(far, near)
            .where("d <= limit")
            .groupBy("g")
            .agg(
                F.count("*").cast("double").alias("n"),
                *[F.sum(x).alias(f"s{i}") for i, x in enumerate(DIMS)],
                *[F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"q{i}{j}") for i, j in _PAIRS],
            )
        )
        moments = keep(moments, f"quality-{step}")
        params = _concentrate(moments, scale, prior)
        if before is not None and not _moved(moments, before):
            break
        before = moments
    return params


def judge(docs: DataFrame, tail: float = 1e-4, share: float = 0.75, steps: int = 20, prior: float = 50.0) -> DataFrame:
    """Every row of docs (doc_id, text, lang, source) with its statistics and verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (fewer than 10 words, or over 20 % of
    the words in repeated 5-word windows), distance (squared Mahalanobis) and kept. tail is the chance that a normal
    vector is rejected. Null languages or sources are groups of their own; a null text has no words and fails the base
    rules. An empty table gives no rows; other columns are ignored.
    """
    group = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), c), F.lit("null")) for c in ("lang", "source")])
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = keep(
        statistics(docs).select(
            "*", base_failed.alias("base_failed"), *[x.alias(d) for d, x in zip(DIMS, vector(), strict=True)], group.alias("g")
        ),
        "quality-statistics",
    ).withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(_SALTS)).cast("int"))
    if stats.isEmpty():
        return stats.select("doc_id", *STATS, "base_failed", F.lit(0.0).alias("distance"), F.lit(True).alias("kept"))
    rows = stats.withColumn("g", F.explode(F.array("g", F.lit(_POOLED)))).select("g", "salt", *DIMS)
    params = robust_groups(rows, share, steps, prior)
    limit = chi2_quantile(1 - tail, len(DIMS))
    return _with(stats, params.drop("n")).select(
        "doc_id",
        *STATS,
        "base_failed",
        distance().alias("distance"),
        (~F.col("base_failed") & (distance() <= limit)).alias("kept"),
        "lang",
        "source",
    )
