"""Documents from page rows that an upstream extractor delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.functions.text import clean_text
from leafmill.operators.documents import document
from leafmill.operators.envelope import envelope
from leafmill.options import ParseOptions

# Pages of one document that are joined in one task; longer documents are joined in two steps.
PAGES_PER_GROUP = 512

# Metadata field and the document information key it comes from.
INFO_KEYS = {"title": "Title", "author": "Author", "created": "CreationDate", "modified": "ModDate"}


def assemble_pages(pages: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """parsed: from path, page_no, text and an info map.

    Page runs of bounded length are joined first, so that a document that holds a large part of
    all pages is spread over many tasks and only its joined runs meet at the end.  A page limit
    is applied before anything is collected, and the planner trims each partition to the limit
    ahead of the shuffle.
    """
    limit = opts.max_pages if opts.max_pages and opts.max_pages > 0 else None
    run = F.floor(F.col("page_no") / PAGES_PER_GROUP)
    sums = [F.count(F.lit(1)).alias("pages"), F.sum(F.octet_length("text")).cast("bigint").alias("file_size")]
    info = [F.max(F.col("info")[k]).alias(f) for f, k in INFO_KEYS.items()]

    def joined(key: str):
        """Texts of a group in the order of the key."""
        ordered = F.sort_array(F.collect_list(F.struct(key, "text")))
        return F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text")

    if limit is None:
        # One scan: a run's text and sums together, then those of a path.
        runs = pages.groupBy("path", run.alias("_run")).agg(joined("page_no"), *sums, *info)
        found = runs.groupBy("path").agg(
            joined("_run"), *[F.sum(c).alias(c) for c in ("pages", "file_size")], *[F.max(f).alias(f) for f in INFO_KEYS]
        )
    else:
        rank = F.row_number().over(W.partitionBy("path").orderBy("page_no", "text"))
        shown = pages.select("path", "page_no", "text").withColumn("_rank", rank).filter(F.col("_rank") <= limit)
        texts = shown.groupBy("path", run.alias("_run")).agg(joined("page_no")).groupBy("path").agg(joined("_run"))
        found = pages.groupBy("path").agg(*sums, *info).join(texts, "path", "left")
    doc = document(
        "pdf",
        clean_text(F.col("text")),
        format="PDF",
        **{f: F.col(f) for f in ["pages", *INFO_KEYS]},
    )
    documents = found.select(
        "path", F.element_at(F.split("path", r"[/\\]"), -1).alias("file_name"), "file_size", doc.alias("doc")
    )
    return envelope(documents, opts)
