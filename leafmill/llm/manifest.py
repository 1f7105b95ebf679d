"""Merkle manifest of a documents table, with a proof per document checked by a recursive query.

Every row is a leaf: H over doc_id, source, lang, n_chars and text, each written as `-` when null and else as its UTF-8
byte count, a colon and its value (integers in decimal); H is the lowercase hex SHA-256 of the concatenated inputs, digests
taken as their hex text. Per source, leaves ascend by doc_id; every FANOUT consecutive nodes of a level (the last run may
be shorter, even one) become the H of their digests, until one node is left: the source's subroot (a lone leaf is its own
subroot). Subroots, ordered by source (null first, UTF-8 bytewise), form the top tree in the same way; its last node is
the root.

How it runs:

- Positions are gapless per tree without a window over a whole source: rows are range-partitioned and sorted by
  (source, doc_id, leaf), numbered inside each partition, and offset by the counts of the partitions before. A source
  that holds a third of all rows is spread over many tasks like any other range.
- Each level is one aggregation of at most FANOUT rows per group over the level below, written to the shared folder as
  parent-linked node rows (tree, source, level, pos, digest) and group rows (the children of one parent, with the
  coordinates of the parent's own group). Levels shrink by FANOUT, so all levels above the leaves cost a fifteenth of it.
- The climb is a recursive SQL query: it starts at every leaf and joins, step by step, the group of its current node,
  folding the (possibly tampered) digest with the node's siblings; at a subroot it continues in the top tree. A step's
  row holds ids, position and one digest, and only each leaf's last step is kept.
- The proof's siblings are appended top-down instead, once per node rather than once per leaf: the root's tail is
  empty, a node's tail is its siblings followed by its parent's tail. Tails are built level by level down to the nodes
  above the leaves; a leaf's proof is the hash of its siblings and its parent's tail, joined by parent (16 leaves a key).

Edge cases: a null doc_id sorts first in its source and is never tampered; rows equal in doc_id are ordered by leaf
digest, so repeated rows give equal results in any order; null source is a tree of its own, first among sources; null
text, lang or n_chars hash as `-`; an empty table gives no rows; columns beyond the five are ignored, also when their
names clash with internal ones. A single document overall is leaf, subroot and root, with the proof H of the empty text.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafmill.llm.scratch import keep

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:`, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Lowercase hex leaf digest of one row."""
    return F.sha2(F.concat(*(_field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def tampered(doc_id: Column) -> Column:
    """True where 5 divides the unsigned CRC-32 of the decimal doc_id (never for a null doc_id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def levels(n: int) -> int:
    """Rounds of grouping until one node of n is left."""
    rounds = 0
    while n > 1:
        n, rounds = -(-n // FANOUT), rounds + 1
    return rounds


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with pos, gapless from 0 per (gn, source) in the given order, and n, the size of that group.

    Range partitioning spreads a large group over many tasks; each task numbers its sorted rows, and the counts of the
    partitions before give the offset. Only (partition, group) counts are aggregated beside the rows.
    """
    key = [F.col("gn"), F.col("source").asc_nulls_first(), *order]
    ranged = keep(
        rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("mid", F.monotonically_increasing_id()),
        "manifest-ranged",
    )
    part = F.shiftright("mid", 33)
    spans = ranged.groupBy(part.alias("part"), "gn", "source").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("gn", "source")
    spans = spans.select(
        "part",
        F.col("gn").alias("s_gn"),
        F.col("source").alias("s_source"),
        "first",
        (F.sum("rows").over(group.orderBy("part")) - F.col("rows")).alias("before"),
        F.sum("rows").over(group).alias("n"),
    )
    on = (part == spans["part"]) & (ranged["gn"] == spans["s_gn"]) & ranged["source"].eqNullSafe(spans["s_source"])
    joined = ranged.join(spans, on)
    return joined.select(
        *[ranged[c] for c in rows.columns], (F.col("mid") - F.col("first") + F.col("before")).alias("pos"), "n", F.col("mid").alias("lid")
    )


def _build(nodes: DataFrame, tree: int, depth: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels above nodes (gn, source, level, pos, n, digest) of one kind of tree, for depth rounds.

    Returns node rows of every level and group rows (tree, gn, source, level, parent, digest of the parent, children).
    """
    all_nodes, groups = [nodes], []
    for _ in range(depth):
        open_ = nodes.where(F.col("n") > 1)
        grouped = open_.groupBy("gn", "source", "level", F.floor(F.col("pos") / FANOUT).alias("parent")).agg(
            F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("children")
        )
        digest = F.unhex(F.sha2(F.array_join(F.transform("children", lambda x: F.lower(F.hex(x["digest"]))), ""), 256))
        built = keep(
            grouped.select(
                F.lit(tree).alias("tree"),
                "gn",
                "source",
                "level",
                "parent",
                F.ceil(F.col("n") / FANOUT).cast("long").alias("parent_n"),
                digest.alias("digest"),
                "children",
            ),
            "manifest-groups",
        )
        groups.append(built)
        nodes = built.select(
            "gn", "source", (F.col("level") + 1).alias("level"), F.col("parent").alias("pos"), F.col("parent_n").alias("n"), "digest"
        )
        all_nodes.append(nodes)
    return all_nodes, groups


def _climb(spark, seed: DataFrame, groups: DataFrame) -> DataFrame:
    """The recursive query: from every leaf up through its groups, folding its digest with the siblings of each step.

    Returns the last step of every leaf: lid, folded root and subroot.
    """
    tag = uuid.uuid4().hex[:12]
    seed_view, groups_view = f"manifest_seed_{tag}", f"manifest_groups_{tag}"
    seed.createOrReplaceTempView(seed_view)
    groups.createOrReplaceTempView(groups_view)
    return spark.sql(
        f"""
        WITH RECURSIVE climb(lid, total, tree, cgn, csource, level, pos, folded, subroot, step) AS (
          SELECT lid, total, tree, cgn, csource, level, pos, folded, subroot, 0 FROM {seed_view}
          UNION ALL
          SELECT c.lid, c.total, g.next_tree, g.next_gn, g.next_source, g.next_level, g.next_pos,
                 unhex(sha2(array_join(transform(g.children, x -> lower(hex(IF(x.pos = c.pos, c.folded, x.digest)))), ''), 256)),
                 IF(c.tree = 0 AND g.next_tree = 1, g.digest, c.subroot),
                 c.step + 1
          FROM climb c JOIN {groups_view} g
            ON g.tree = c.tree AND g.gn = c.cgn AND g.source <=> c.csource AND g.level = c.level AND g.parent = floor(c.pos / {FANOUT})
        )
        SELECT lid, folded, subroot FROM climb WHERE step = total
        """
    )


def _siblings(children: Column, pos: Column) -> Column:
    """Digests of the other children, concatenated in order (binary)."""
    others = F.filter(children, lambda x: x["pos"] != pos)
    return F.aggregate(others, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["digest"]))


def _descend(groups: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes of the level below groups (gn, source, level, parent, children) with their proof tail: siblings in the
    group, then the tail of the parent (above: gn, source, pos, tail)."""
    parent = above.select(F.col("gn").alias("p_gn"), F.col("source").alias("p_source"), F.col("pos").alias("p_pos"), "tail")
    on = (groups["gn"] == parent["p_gn"]) & groups["source"].eqNullSafe(parent["p_source"]) & (groups["parent"] == parent["p_pos"])
    joined = groups.join(parent, on).select("gn", "source", "children", "tail", F.explode("children").alias("child"))
    return joined.select(
        "gn", "source", F.col("child.pos").alias("pos"), F.concat(_siblings(F.col("children"), F.col("child.pos")), "tail").alias("tail")
    )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row of docs.

    docs: doc_id, source, lang, n_chars, text (other columns ignored). folded_root is the root recomputed from the
    tampered leaf (text with A-Z lower-cased where `tampered(doc_id)`, else the leaf itself) and the original siblings;
    verified says whether it equals root. All digests are lowercase hex.
    """
    spark = docs.sparkSession
    cols = [docs[c] for c in FIELDS]
    doc_id = cols[0].cast("long")
    leaf = leaf_of(doc_id, *cols[1:])
    changed = leaf_of(doc_id, cols[1], cols[2], cols[3], lower_ascii(cols[4]))
    rows = docs.select(
        F.lit(0).alias("gn"),
        cols[1].cast("string").alias("source"),
        doc_id.alias("doc_id"),
        F.unhex(leaf).alias("digest"),
        F.unhex(F.when(tampered(doc_id), changed).otherwise(leaf)).alias("folded"),
    )
    leaves = keep(_numbered(rows, [F.col("doc_id").asc_nulls_first(), F.col("digest")]).withColumn("level", F.lit(0)), "manifest-leaves")
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        return spark.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    node_levels, source_groups = _build(leaves.select("gn", "source", "level", "pos", "n", "digest"), 0, levels(most))
    subroots = reduce(DataFrame.unionByName, node_levels).where(F.col("n") == 1)
    tops = _numbered(
        subroots.select(F.lit(1).alias("gn"), F.lit(None).cast("string").alias("source"), F.col("source").alias("s"), "digest"),
        [F.col("s").asc_nulls_first()],
    ).select(F.col("s").alias("source"), "pos", "n", "digest")
    n_sources = tops.agg(F.max("n")).first()[0]
    top_levels, top_groups = _build(
        tops.select(F.lit(1).alias("gn"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("level"), "pos", "n", "digest"),
        1,
        levels(n_sources),
    )
    root = F.lit(reduce(DataFrame.unionByName, top_levels).where(F.col("n") == 1).first()["digest"])
    top_pos = tops.select(F.col("source").alias("t_source"), F.col("pos").alias("t_pos"))

    def to_top(frame: DataFrame, source: str, ready: Column) -> DataFrame:
        """Where ready (at most one row per source), the climb goes on at the subroot's place in the top tree."""
        done = frame.where(ready)
        joined = done.join(top_pos, done[source].eqNullSafe(top_pos["t_source"])).drop("t_source")
        return joined.unionByName(frame.where(~ready).withColumn("t_pos", F.lit(None).cast("long")))

    step_up = to_top(
        reduce(DataFrame.unionByName, source_groups) if source_groups else spark.createDataFrame([], source_groups_schema()),
        "source",
        F.col("parent_n") == 1,
    )
    up = F.col("parent_n") == 1
    source_steps = step_up.select(
        "tree",
        "gn",
        "source",
        "level",
        "parent",
        "digest",
        "children",
        F.when(up, 1).otherwise(0).alias("next_tree"),
        F.when(up, 1).otherwise(F.col("gn")).alias("next_gn"),
        F.when(up, F.lit(None)).otherwise(F.col("source")).cast("string").alias("next_source"),
        F.when(up, 0).otherwise(F.col("level") + 1).alias("next_level"),
        F.when(up, F.col("t_pos")).otherwise(F.col("parent")).alias("next_pos"),
    )
    top_steps = [
        g.select(
            "tree", "gn", "source", "level", "parent", "digest", "children",
            F.lit(1).alias("next_tree"), F.lit(1).alias("next_gn"), F.lit(None).cast("string").alias("next_source"),
            (F.col("level") + 1).alias("next_level"), F.col("parent").alias("next_pos"),
        )
        for g in top_groups
    ]
    groups = keep(reduce(DataFrame.unionByName, [source_steps, *top_steps]), "manifest-steps")

    lone = F.col("n") == 1
    seeded = to_top(leaves, "source", lone)
    depth = F.lit(levels(n_sources)) + _levels_of(F.col("n"))
    seed = seeded.select(
        "lid",
        depth.alias("total"),
        F.when(lone, 1).otherwise(0).alias("tree"),
        F.when(lone, 1).otherwise(F.col("gn")).alias("cgn"),
        F.when(lone, F.lit(None)).otherwise(F.col("source")).cast("string").alias("csource"),
        F.lit(0).alias("level"),
        F.when(lone, F.col("t_pos")).otherwise(F.col("pos")).alias("pos"),
        "folded",
        F.when(lone, F.col("digest")).alias("subroot"),
    )

    previous = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # every leaf climbs the whole way; rows grow with depth only
    try:
        climbed = keep(_climb(spark, seed, groups), "manifest-climb")
    finally:
        if previous is None:
            spark.conf.unset("spark.sql.cteRecursionRowLimit")
        else:
            spark.conf.set("spark.sql.cteRecursionRowLimit", previous)

    # Proof tails top-down: the root's is empty; a node's is its siblings, then its parent's tail.
    above = top_levels[-1].where(F.col("n") == 1).select("gn", "source", "pos", F.lit(b"").cast("binary").alias("tail"))
    for g in reversed(top_groups):
        above = keep(_descend(g, above), "manifest-tails")
    subroot_tails = keep(
        above.join(tops.select(F.col("pos").alias("t_pos"), F.col("source").alias("s"), F.col("n").alias("_"), "digest"), F.col("pos") == F.col("t_pos"))
        .select(F.lit(0).alias("gn"), F.col("s").alias("source"), "tail"),
        "manifest-subroot-tails",
    )
    depths = subroots.select(F.col("gn").alias("d_gn"), F.col("source").alias("d_source"), F.col("level").alias("depth"))
    on = (subroot_tails["gn"] == depths["d_gn"]) & subroot_tails["source"].eqNullSafe(depths["d_source"])
    subroot_tails = subroot_tails.join(depths, on).select("gn", "source", "depth", "tail")
    tails = None
    for level in range(len(source_groups) - 1, 0, -1):
        here = subroot_tails.where(F.col("depth") == level + 1).select("gn", "source", F.lit(0).cast("long").alias("pos"), "tail")
        here = here if tails is None else here.unionByName(tails)
        tails = keep(_descend(source_groups[level], here), "manifest-tails")
    first = subroot_tails.where(F.col("depth") == 1).select("gn", "source", F.lit(0).cast("long").alias("pos"), "tail")
    first = first if tails is None else first.unionByName(tails)

    hexed = lambda c: F.lower(F.hex(c))
    proofs = []
    if source_groups:
        parent = first.select(F.col("gn").alias("p_gn"), F.col("source").alias("p_source"), F.col("pos").alias("p_pos"), "tail")
        g0 = source_groups[0]
        low = g0.join(parent, (g0["gn"] == parent["p_gn"]) & g0["source"].eqNullSafe(parent["p_source"]) & (g0["parent"] == parent["p_pos"]))
        low = low.select(F.col("gn").alias("g_gn"), F.col("source").alias("g_source"), F.col("parent").alias("g_parent"), "children", "tail")
        many = leaves.where(~lone)
        on = (many["gn"] == low["g_gn"]) & many["source"].eqNullSafe(low["g_source"]) & (F.floor(many["pos"] / FANOUT) == low["g_parent"])
        proofs.append(
            many.join(low, on).select("lid", "doc_id", "digest", F.concat(_siblings(F.col("children"), F.col("pos")), "tail").alias("path"))
        )
    alone = leaves.where(lone)
    own = subroot_tails.select(F.col("source").alias("o_source"), "tail")
    proofs.append(alone.join(own, alone["source"].eqNullSafe(own["o_source"])).select("lid", "doc_id", "digest", F.col("tail").alias("path")))
    proven = reduce(DataFrame.unionByName, proofs)
    out = proven.join(climbed, "lid")
    return out.select(
        "doc_id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(root).alias("root"),
        F.sha2(hexed(F.col("path")), 256).alias("proof_sha256"),
        hexed(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def _levels_of(n: Column) -> Column:
    """levels() as a column: rounds of grouping until one node of n is left."""
    return reduce(lambda a, b: a + b, [F.when(n > FANOUT**k, 1).otherwise(0) for k in range(16)])


def source_groups_schema() -> str:
    return (
        "tree int, gn int, source string, level int, parent long, parent_n long, digest binary, "
        "children array<struct<pos:long,digest:binary>>"
    )
