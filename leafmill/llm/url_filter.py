"""URL filters: fixed host/path rules, else naive Bayes over host words found by unigram Viterbi segmentation.

A url's host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; its path follows up to `?`,
`#` or the end; a null url or one without `://` has both empty. A rule (host, path) fits a url whose host is the rule's
or a subdomain of it and whose path starts with the rule's path; of several, the longest rule (host and path together)
wins, then the earlier one. Rows without a rule get the model's verdict.

The model, all on Spark:

- Unigram counts of ASCII words in every text of the corpus (`documents`); a word's score is its log share, an unknown
  single letter scores log(unknown / total). Hosts are cut into letter runs (digit runs become `#`), each distinct run
  into all substrings of at most `longest` letters, which are joined with the counts; a Viterbi pass per run (a task per
  group of one run's edges) picks the segmentation of highest total score.
- Training rows are the pages that a rule decides; tokens are `h:` plus host words and `p:` plus path words (letters, or
  `#` for digits). Multinomial naive Bayes with add-one smoothing: a token's weight is its log-likelihood ratio, a page's
  score the log prior ratio plus the weights of its known tokens; score > 0 blocks.
- Tables of distinct runs, hosts and tokens are joined to the many rows that share them by broadcast only below
  `broadcast_rows` rows (counted first), else by a join salted over `salt` tasks, so a host that a third of the pages
  share is spread.

Edge cases: null url: empty host and path; rules need a path that starts with theirs, so `http://x.org` (empty path) fits
no rule; null page_id or repeated rows are kept as rows; an empty table gives no rows; with no pages decided by a rule
the prior is even and all tokens weigh 0, so the verdict is allow. Other columns are ignored.
"""

from __future__ import annotations

import math
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep

# The rules (verdict, host, path), in this order.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """rule string (host + path) and its verdict, null where none fits."""
    fits = []
    for i, (verdict, rh, rp) in enumerate(RULES):
        on_host = (host == rh) | host.endswith("." + rh)
        fits.append((-(len(rh) + len(rp)), i, on_host & path.startswith(rp), rh + rp, verdict))
    fits.sort()
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, _, fit, text, say in reversed(fits):
        rule, verdict = F.when(fit, F.lit(text)).otherwise(rule), F.when(fit, F.lit(say)).otherwise(verdict)
    return rule, verdict


def attach(big: DataFrame, small: DataFrame, key: str, broadcast_rows: int, salt: int) -> DataFrame:
    """Left join of big with small (unique key): broadcast when small has at most broadcast_rows rows, else salted."""
    if small.count() <= broadcast_rows:
        return big.join(F.broadcast(small), key, "left")
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    spread = big.withColumn("_salt", (F.abs(F.xxhash64(F.rand(7))) % salt).cast("int"))
    return spread.join(salted, [key, "_salt"], "left").drop("_salt")


def vocabulary(documents: DataFrame) -> tuple[DataFrame, int]:
    """(word, score) over ASCII words of every text, and the total count."""
    words = documents.select(F.explode(F.regexp_extract_all(F.lower(F.col("text")), F.lit("[a-z]+"), 0)).alias("word"))
    counts = keep(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "url-vocabulary")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select("word", F.log(F.col("n") / F.lit(max(total, 1))).alias("score")), total


def viterbi(length: int, edges: list[tuple[int, int, float]]) -> list[str] | list[tuple[int, int]]:
    """Best cut of positions 0..length into spans (start, end) given scored edges (start, span length, score)."""
    best, back = [0.0] + [-math.inf] * length, [0] * (length + 1)
    by_end: dict[int, list[tuple[int, float]]] = {}
    for i, n, s in edges:
        by_end.setdefault(i + n, []).append((i, s))
    for end in range(1, length + 1):
        for start, s in by_end.get(end, ()):
            if best[start] + s > best[end] or (best[start] + s == best[end] and start < back[end]):
                best[end], back[end] = best[start] + s, start
    spans, end = [], length
    while end > 0:
        spans.append((back[end], end))
        end = back[end]
    return spans[::-1]


def segment(runs: DataFrame, vocab: DataFrame, total: int, longest: int = 24, unknown: float = 0.01) -> DataFrame:
    """(run, words) for distinct letter runs: the highest-scoring segmentation into corpus words."""
    spans = runs.select(
        "run", F.explode(F.sequence(F.lit(0), F.length("run") - 1)).alias("i")
    ).select("run", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("i")))).alias("n"))
    spans = spans.withColumn("word", F.expr("substring(run, i + 1, n)"))
    unknown_score = math.log(unknown / max(total, 1))
    edges = spans.join(vocab, "word", "left").select(
        "run", "i", "n", F.coalesce("score", F.when(F.col("n") == 1, F.lit(unknown_score))).alias("score")
    ).where(F.col("score").isNotNull())

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        run = frame.run.iloc[0]
        spans = viterbi(len(run), list(zip(frame.i.tolist(), frame.n.tolist(), frame.score.tolist())))
        return pd.DataFrame({"run": [run], "words": [[run[a:b] for a, b in spans]]})

    return edges.groupBy("run").applyInPandas(best, "run string, words array<string>")


def judge(
    pages: DataFrame,
    documents: DataFrame,
    longest: int = 24,
    broadcast_rows: int = 500_000,
    salt: int = 64,
) -> DataFrame:
    """page_id, url, host, path, rule, verdict, rule_verdict, score and host_words of every row of pages (page_id, url)."""
    url = F.col("url").cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"))
    base = base.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"))
    base = keep(base.select("*", rule.alias("rule"), said.alias("rule_verdict"), F.monotonically_increasing_id().alias("rid")), "url-base")

    vocab, total = vocabulary(documents)
    hosts = base.select("host").distinct()
    host_runs = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+|[0-9]+"), 0)).alias("at", "run"))
    letters = host_runs.where(F.col("run").rlike("^[a-z]")).select("run").distinct()
    segmented = keep(segment(letters, vocab, total, longest), "url-segments")
    host_words = attach(host_runs, segmented, "run", broadcast_rows, salt).select(
        "host", "at", F.when(F.col("run").rlike("^[0-9]"), F.array(F.lit("#"))).otherwise(F.col("words")).alias("words")
    )
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])
    host_words = keep(host_words.groupBy("host").agg(F.flatten(in_order).alias("host_words")), "url-host-words")
    path_words = F.transform(
        F.regexp_extract_all(F.lower("path"), F.lit("[a-z]+|[0-9]+"), 0), lambda w: F.when(w.rlike("^[0-9]"), F.lit("#")).otherwise(w)
    )
    tokens = F.concat(
        F.transform(F.coalesce("host_words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w)),
        F.transform(path_words, lambda w: F.concat(F.lit("p:"), w)),
    )
    rows = keep(attach(base, host_words, "host", broadcast_rows, salt).select("*", tokens.alias("tokens")), "url-rows")

    labelled = rows.where(F.col("rule").isNotNull())
    counts = labelled.select(
        (F.col("rule_verdict") == "block").cast("int").alias("y"), F.explode("tokens").alias("token")
    ).groupBy("token").agg(F.sum("y").alias("b"), F.sum(1 - F.col("y")).alias("a"))
    counts = keep(counts, "url-token-counts")
    stats = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("a").alias("ta"), F.sum("b").alias("tb")).first()
    docs = labelled.agg(F.sum((F.col("rule_verdict") == "block").cast("int")).alias("nb"), F.count(F.lit(1)).alias("n")).first()
    v, ta, tb = stats.v or 0, stats.ta or 0, stats.tb or 0
    nb, n = docs.nb or 0, docs.n or 0
    prior = math.log((nb + 1) / (n + 2)) - math.log((n - nb + 1) / (n + 2))
    weights = counts.select(
        "token", (F.log((F.col("b") + 1) / F.lit(tb + v)) - F.log((F.col("a") + 1) / F.lit(ta + v))).alias("weight")
    )
    undecided = rows.where(F.col("rule").isNull()).select("rid", F.explode("tokens").alias("token"))
    scored = attach(undecided, weights, "token", broadcast_rows, salt).groupBy("rid").agg(
        F.sum(F.coalesce("weight", F.lit(0.0))).alias("evidence")
    )
    out = rows.join(scored, "rid", "left")
    score = F.lit(prior) + F.coalesce("evidence", F.lit(0.0))
    return out.select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(score > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "rule_verdict",
        F.when(F.col("rule").isNull(), score).alias("score"),
        F.coalesce("host_words", F.array().cast("array<string>")).alias("host_words"),
    )
