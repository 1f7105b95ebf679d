"""URL filters: parts and rules against plain Python, Viterbi against enumeration, naive Bayes against counting."""

import itertools
import math
import re
from collections import Counter

import pytest

from leafmill.llm import url_filter as uf


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path


def rule(host, path):
    fits = [(-(len(h) + len(p)), i, h + p, v) for i, (v, h, p) in enumerate(uf.RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (min(fits)[2], min(fits)[3]) if fits else (None, None)


URLS = [
    None,
    "",
    "no-scheme.org/a",
    "http://x.org",
    "http://x.org/",
    "HTTPS://Blog.Example.ORG/es/1?q=/de/#f",
    "https://example.org/en/12",
    "https://sub.example.org/en/2",
    "https://notexample.org/es/",
    "ftp://a.com/fr/x",
    "ftp://a.com/de",
    "http://a.com/de/",
    "http://xcom/de/",
    "http://ÄÖ.com/fr/ü",
    "http://host:8080/path?x#y",
    "http://a.net?b://c",
    "://only/de/",
    "http://a.org#/x",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    docs = spark.createDataFrame([(1, "the example of a blog")], "doc_id long, text string")
    got = {r.page_id: r for r in uf.judge(df, docs).collect()}
    for i, u in enumerate(URLS):
        host, path = parts(u)
        assert (got[i].host, got[i].path) == (host, path), u
        assert (got[i].rule, got[i].rule_verdict) == rule(host, path), u
        assert got[i].verdict == (got[i].rule_verdict or ("block" if got[i].score > 0 else "allow"))


def brute_segment(run, scores, unknown):
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        words, start = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                words.append(run[start:k])
                start = k
        words.append(run[start:])
        total = 0.0
        for w in words:
            s = scores.get(w, unknown if len(w) == 1 else None)
            if s is None:
                break
            total += s
        else:
            if best is None or total > best[0] + 1e-12:
                best = (total, words)
    return best[1]


@pytest.mark.parametrize("run", ["blogexample", "thethe", "abc", "x", "examplenetwork", "aaaa"])
def test_viterbi_is_best(spark, run):
    text = "blog example the net work network a an ex ample the the"
    counts = Counter(text.split())
    total = sum(counts.values())
    scores = {w: math.log(n / total) for w, n in counts.items()}
    unknown = math.log(0.01 / total)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    vocab, n = uf.vocabulary(docs)
    got = uf.segment(spark.createDataFrame([(run,)], "run string"), vocab, n).first().words
    assert got == brute_segment(run, scores, unknown)


def test_bayes_by_counting(spark):
    """Scores of undecided pages equal naive Bayes counted by hand over the rule-decided pages."""
    urls = [
        "http://news.example.org/en/1", "http://blog.example.org/es/2", "http://shop.com/de/3", "http://shop.com/fr/4",
        "http://news.com/fr/5", "http://blog.net/de/6", "http://news.net/fr/7", "http://x.io/", None, "http://shop.com/de/3",
    ]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(3)
    docs = spark.createDataFrame([(1, "news blog shop net com org example"), (2, None), (3, "")], "doc_id long, text string")
    rows = {r.page_id: r for r in uf.judge(df, docs, broadcast_rows=0, salt=3).collect()}  # the salted path

    def tokens(r):
        return ["h:" + w for w in r.host_words] + ["p:" + ("#" if w[0].isdigit() else w) for w in re.findall(r"[a-z]+|[0-9]+", r.path.lower())]

    decided = [r for r in rows.values() if r.rule]
    a, b = Counter(), Counter()
    for r in decided:
        (b if r.rule_verdict == "block" else a).update(tokens(r))
    vocab = set(a) | set(b)
    nb = sum(r.rule_verdict == "block" for r in decided)
    prior = math.log((nb + 1) / (len(decided) + 2)) - math.log((len(decided) - nb + 1) / (len(decided) + 2))
    for r in rows.values():
        if r.rule:
            assert r.score is None and r.verdict == r.rule_verdict
            continue
        want = prior + sum(
            math.log((b[t] + 1) / (sum(b.values()) + len(vocab))) - math.log((a[t] + 1) / (sum(a.values()) + len(vocab)))
            for t in tokens(r) if t in vocab
        )
        assert r.score == pytest.approx(want)
        assert r.verdict == ("block" if want > 0 else "allow")


def test_empty_and_clashing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty, docs).count() == 0
    df = spark.createDataFrame([(1, "http://a.org/x", 5, "z", 9)], "page_id long, url string, rid int, host string, _salt int")
    (row,) = uf.judge(df, docs.withColumn("word", docs.text)).collect()
    assert (row.host, row.rule, row.verdict) == ("a.org", "org/", "allow")
