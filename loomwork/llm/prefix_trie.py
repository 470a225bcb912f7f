"""The trie of the prefixes of sequences, built and summed by van Emde Boas recursion.

A node of depth d is a distinct sequence of first d items; its name is the smallest sequence that begins with it, which is
unique at its depth. Nothing is done depth by depth:

1. A problem is a part of the trie between two depths: sequences that share a tree at its top, cut to its height. All
   problems of one height are rows of one table and worked on together. Each is cut at half its height. Sequences of one
   tree whose items up to the cut are equal (by 128-bit prints of stretches of items) get one name, the smallest of them.
   The upper trie goes on with one row for each name, the lower forests with the sequences below their cut prefixes.
2. When the height is one, the rows are the edges of the trie, each with the number of sequences behind it.
3. Totals go up in the reverse order. When two halves are put together, the sum of every lower tree is added to all nodes
   on the path of its cut prefix in the upper trie. The paths of twice the height are those of both halves.

Sequences of n items take about 2 log n rounds of joins and aggregations. An item takes part in a row for each height at
most. Names come from aggregations with map-side minima joined back, so a prefix that most sequences share is no single
task's work.

Defined results: an empty sequence ends at the root; without sequences there is no trie; equal sequences are all members
of their nodes. Numbers of sequences must be unique and not NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.positions import numbered
from loomwork.staging import discard, staged

TOTALS = ["n_leaves", "saved"]


def stretches(items: DataFrame, levels: int) -> DataFrame:
    """``seq, level, stretch, f1, f2``: prints of the stretches of 2^level items that cuts compare.

    ``items`` has ``seq, at`` (from 1 on), ``n`` (items of the sequence), ``h1, h2``.
    """
    def stretch(level: Column) -> Column:
        return F.call_function("shiftright", F.col("at") - 1, level)

    # Only the upper halves of problems are compared, and only by sequences that fill them.
    wanted = F.filter(
        F.sequence(F.lit(0), F.lit(levels - 1)),
        lambda k: (stretch(k) % 2 == 0) & (F.call_function("shiftleft", stretch(k) + 1, k) <= F.col("n")),
    )
    rows = items.select("seq", "at", "h1", "h2", F.explode(wanted).alias("level"))
    prints = [F.bit_xor(F.xxhash64("at", h)).alias(f) for h, f in (("h1", "f1"), ("h2", "f2"))]
    return rows.groupBy("seq", "level", stretch(F.col("level")).alias("stretch")).agg(*prints)


def _named(problems: DataFrame, prints: DataFrame, level: int) -> DataFrame:
    """Problems of height 2^(level + 1) with ``name``, the prefix at their cut of each sequence that reaches it."""
    half = 1 << level
    long = problems.where(F.col("len") >= half)
    here = prints.where(F.col("level") == level).select(F.col("seq").alias("rep"), (F.col("stretch") * half).alias("top"), "f1", "f2")
    printed = long.join(here, ["rep", "top"])
    key = ["top", "tree", "f1", "f2"]
    names = printed.groupBy(*key).agg(F.min("rep").alias("name"))
    met = printed.join(names, key).select("top", "tree", "rep", "len", "weight", "name")
    short = problems.where(F.col("len") < half).withColumn("name", F.lit(None).cast("long"))
    return staged(met.unionByName(short), in_loop=True)


def _halves(cut: DataFrame, half: int) -> DataFrame:
    """The problems of half the height: upper tries and lower forests."""
    columns = ["top", "tree", "rep", "len", "weight"]
    reached = cut.where("name is not null")
    upper = reached.groupBy("top", "tree", F.col("name").alias("rep")).agg(F.lit(half).cast("long").alias("len"), F.sum("weight").alias("weight"))
    below = reached.where(F.col("len") > half)
    lower = below.select((F.col("top") + half).alias("top"), F.col("name").alias("tree"), "rep", (F.col("len") - half).alias("len"), "weight")
    return upper.select(*columns).unionByName(lower).unionByName(cut.where("name is null").select(*columns))


def _grafted(totals: DataFrame, paths: DataFrame, half: int) -> DataFrame:
    """Add the sums of the lower trees of problems of height 2 * ``half`` to the nodes above them."""
    under = totals.where((F.col("depth") - 1) % (2 * half) == half)
    trees = under.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(*(F.sum(c).alias(c) for c in TOTALS))
    above = paths.join(trees, ["depth", "node"]).select(F.col("on_depth").alias("depth"), F.col("on_node").alias("node"), *TOTALS)
    parts = totals.unionByName(above, allowMissingColumns=True)
    others = [c for c in totals.columns if c not in ("depth", "node", *TOTALS)]
    return staged(parts.groupBy("depth", "node").agg(*(F.max(c).alias(c) for c in others), *(F.sum(c).alias(c) for c in TOTALS)), in_loop=True)


def _longer(paths: DataFrame, cut: DataFrame, half: int) -> DataFrame:
    """Paths of 2 * ``half`` nodes up from those at the foot of a problem of that height."""
    foot = cut.where(F.col("len") == 2 * half)
    cuts = foot.select((F.col("top") + 2 * half).alias("foot"), F.col("rep").alias("at_foot"), (F.col("top") + half).alias("depth"), F.col("name").alias("node"))
    upper = paths.join(cuts, ["depth", "node"]).select(F.col("foot").alias("depth"), F.col("at_foot").alias("node"), "on_depth", "on_node")
    return staged(paths.where(F.col("depth") % (2 * half) == 0).unionByName(upper), in_loop=True)


def trie(items: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes and where the sequences end.

    ``sequences`` has ``seq`` and ``n``; ``items`` has ``seq, at`` (from 1 to n), ``h1, h2`` (two hashes of the item) and
    ``weight`` (a number). Nodes: ``depth, node, parent, n_seqs, n_children, n_leaves, saved``, where ``saved`` sums, over the
    node and all below it, the weight of the last item times the number of sequences that need not hold it again.
    Ends: ``depth, node, seq``.
    """
    size = sequences.agg(F.max("n"), F.min("seq"), F.count("*")).first()
    longest, root = size[0] or 0, size[1]
    levels = longest.bit_length()
    seqs = sequences.select(F.col("seq").alias("rep"), F.col("n").alias("len"))
    lengths = sequences.select("seq", "n")
    prints = staged(stretches(items.select("seq", "at", "h1", "h2").join(lengths, "seq"), max(levels, 1)), in_loop=True)
    first = F.lit(root).cast("long")
    problems = seqs.where("len > 0").select(F.lit(0).cast("long").alias("top"), first.alias("tree"), "rep", "len", F.lit(1).cast("long").alias("weight"))
    ends = [seqs.where("len = 0").select(F.lit(0).cast("long").alias("depth"), first.alias("node"), F.col("rep").alias("seq"))]
    cuts = {}
    for level in reversed(range(levels)):
        half = 1 << level
        cut = cuts[half] = _named(problems, prints, level)
        ends.append(cut.where(F.col("len") == half).select((F.col("top") + half).alias("depth"), F.col("name").alias("node"), F.col("rep").alias("seq")))
        problems = _halves(cut, half)
    edges = problems.select((F.col("top") + 1).alias("depth"), F.col("rep").alias("node"), F.col("tree").alias("parent"), F.col("weight").alias("n_seqs"))
    weights = items.select(F.col("at").alias("depth"), F.col("seq").alias("node"), F.col("weight").alias("last"))
    nodes = staged(edges.join(weights, ["depth", "node"]), in_loop=True)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, ["depth", "node"], "left").select(
        "depth", "node", "parent", "n_seqs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"), ((F.col("n_seqs") - 1) * F.col("last")).alias("saved"),
    )
    totals = staged(known, in_loop=True)
    paths = staged(totals.select("depth", "node", F.col("depth").alias("on_depth"), F.col("node").alias("on_node")), in_loop=True)
    for half, cut in sorted(cuts.items()):
        grafted = _grafted(totals, paths, half)
        discard(totals)
        totals = grafted
        if 2 * half in cuts:
            longer = _longer(paths, cut, half)
            discard(paths)
            paths = longer
    top = totals.where("depth = 1").agg(F.count("*").alias("n_children"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS))
    whole = top.where(F.lit(size[2] > 0)).select(
        F.lit(0).cast("long").alias("depth"), first.alias("node"), F.lit(None).cast("long").alias("parent"), F.lit(size[2]).cast("long").alias("n_seqs"),
        "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved",
    )
    return totals.unionByName(whole), reduce(DataFrame.unionByName, ends)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of nodes and members: each node's digest, member by member, so no group is held."""
    at, digest = None, sha256()

    def told(found: list[tuple[tuple[int, int], str]]) -> pa.RecordBatch:
        columns = [pa.array([key[k] for key, _ in found], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([x for _, x in found], pa.string())], ["depth", "node", "ends_sha256"])

    for batch in batches:
        depth, node, seq = (batch.column(c).to_numpy() for c in ("depth", "node", "seq"))
        starts = np.flatnonzero(np.concatenate(([True], (depth[1:] != depth[:-1]) | (node[1:] != node[:-1])))) if len(seq) else []
        found = []
        for begin, end in zip(starts, [*starts[1:], len(seq)]):
            key, text = (int(depth[begin]), int(node[begin])), ",".join(map(str, seq[begin:end].tolist()))
            if key == at:
                digest.update(b"," + text.encode())
            else:
                if at is not None:
                    found.append((at, digest.hexdigest()))
                at, digest = key, sha256(text.encode())
        yield told(found)
    if at is not None:
        yield told([(at, digest.hexdigest())])


def ends_digest(ends: DataFrame) -> DataFrame:
    """``depth, node, ends_sha256``: the digest of the numbers of the sequences that end at a node, rising, joined by commas.

    A digest is made in order, so one task makes each, in constant memory.
    """
    ordered = ends.repartition("depth", "node").sortWithinPartitions("depth", "node", "seq")
    return ordered.mapInArrow(_digests, "depth long, node long, ends_sha256 string")


def rebuilt(conversations: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: ``items`` and ``sequences`` for ``trie``.

    A conversation c of ``conv_id, turn, role, text`` takes the first h turns of conversation ``c - c % family`` in place of
    its own first h, where h is the CRC-32 of its number modulo ``most``. Turns without a number come first, equal ones
    follow each other by role and text; a NULL role or text is empty; rows without ``conv_id`` take no part.
    """
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("seq"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    ordered = numbered(said, "at", F.asc_nulls_first("seq"), F.asc_nulls_first("turn"), "role", "text").select(
        "seq", "at", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.octet_length("text").cast("long").alias("weight"),
    )
    turns = staged(ordered)
    sizes = turns.groupBy("seq").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    head = (F.crc32(F.col("seq").cast("string")) % most).alias("h")
    source = (F.col("seq") - F.col("seq") % family).alias("source")
    of_source = sizes.select(F.col("seq").alias("source"), F.col("start").alias("source_start"), F.col("size").alias("source_size"))
    plans = sizes.select("seq", "start", "size", head, source).join(of_source, "source", "left")
    taken = F.least("h", F.coalesce("source_size", F.lit(0)))
    plans = staged(plans.withColumn("taken", taken).withColumn("n", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))))
    facts = ["h1", "h2", "weight"]
    starts = turns.join(sizes.select("seq", "start"), "seq").where(F.col("at") - F.col("start") < most)
    starts = starts.select(F.col("seq").alias("source"), (F.col("at") - F.col("start")).alias("place"), *facts)
    heads = starts.join(plans.select("source", "seq", "h"), "source").where("place < h").select("seq", (F.col("place") + 1).alias("at"), *facts)
    own = turns.join(plans.select("seq", "start", "h", "taken"), "seq").where(F.col("at") - F.col("start") >= F.col("h"))
    tails = own.select("seq", (F.col("at") - F.col("start") - F.col("h") + F.col("taken") + 1).alias("at"), *facts)
    return staged(heads.unionByName(tails)), plans.select("seq", "n")
