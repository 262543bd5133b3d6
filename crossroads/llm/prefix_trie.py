"""The prefix trie of conversations, with subtree totals from running sums along its paths.

A node is a distinct beginning of ``depth`` turns (role and text); its members are the conversations that
begin so. Beginnings are told apart by 128 bits: the exclusive-or of two hashes of each turn and its place,
taken as a running value, so a conversation of any length spreads over tasks. A node is named by its smallest
member and its depth.

Totals over subtrees need no walk over levels. A conversation that names a node, as its smallest member, names every
node below it on its own path: what it names is the end of its path. So each node lies on the path of exactly one
conversation that names it, and the nodes below v are the nodes named by v's members at v or deeper. A running sum from
the end of each path, over the nodes it names, says what a member adds to v; a sum over the members is v's total. The
number of jobs does not depend on the depth or the width of the trie.

Defined cases: a null role or text is empty; turns come in order of ``turn`` (null first), ties by role and the
md5 of the text; equal rows are separate turns; rows without a conv_id belong to no conversation and are not read;
no conversations give no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossroads.llm.frames import joined_to_unique, partitions, stored
from crossroads.operators import prefix

KEY = ["depth", "p1", "p2"]
#: Ids in a block of the text that ends_sha256 is taken of.
IDS = 8192


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, digest, chars): the turns of each conversation, numbered from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("md5"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )
    return prefix.numbered(rows, ["conv_id"], ["turn", "role", "md5"]).select("conv_id", "idx", "digest", "chars")


def rebuilt(numbered: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, depth, digest, chars) after each conversation has taken the beginning of the first of its hundred.

    The first h turns come from conversation c - c % ``every`` (all if it has fewer, none if it is not there), the rest
    are its own after the first h; h is the crc32 of the decimal c modulo ``most``. ``numbered`` should be stored.
    """
    donor = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = numbered.select("conv_id").distinct().select("conv_id", donor.alias("donor"), h.alias("h"))
    given = numbered.filter((F.col("conv_id") == donor) & (F.col("idx") < most - 1)).select(F.col("conv_id").alias("donor"), "idx", "digest", "chars")
    taken = convs.join(given, "donor").filter("idx < h").select("conv_id", "idx", "digest", "chars")
    own = numbered.filter(F.col("idx") >= h)
    # stored: running values read their input several times, and one over another would multiply the plan
    both = stored(taken.unionByName(own), "both")
    return prefix.numbered(both, ["conv_id"], ["idx"], "depth", cut_by=both.select("conv_id", "idx")).select(
        "conv_id", (F.col("depth") + 1).alias("depth"), "digest", "chars")


def members(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, chars, last) of a stored table: a row for each beginning of each conversation, with its own and its parent's name."""
    own = [F.xxhash64("depth", "digest").alias("h1"), F.xxhash64(F.lit("second"), "digest", "depth").alias("h2")]
    rows = sequences.select("conv_id", "depth", "chars", *own)
    run = prefix.running(
        rows, ["conv_id"], ["depth"], {"p1": ("xor", F.col("h1")), "p2": ("xor", F.col("h2"))}, backward={"left": ("sum", F.lit(1))},
        cut_by=sequences.select("conv_id", "depth"))
    return run.select(
        "conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"),
        "chars", (F.col("left") == 1).alias("last"),
    )


def nodes(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node, the root included: its name, its parent's, members and the length of its last text."""
    below = rows.groupBy(*KEY).agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"), "conv_id", "n_convs", zero.alias("chars"))
    return below.withColumn("depth", F.col("depth").cast("long")).unionByName(root)


def subtree_sums(paths: DataFrame, tree: DataFrame, values: list[str]) -> DataFrame:
    """(depth, p1, p2, *values): sums over subtrees, their top included.

    ``paths`` has a row for each conversation and each node on its path: conv_id, depth, p1, p2. ``tree`` has a row for each
    node: conv_id, depth and the values, longs. conv_id and depth are unique in both, so no key of the join is large.
    """
    known = tree.select("conv_id", "depth", *values)
    own = stored(paths.join(known, ["conv_id", "depth"], "left").select("conv_id", *KEY, *[F.coalesce(v, F.lit(0)).alias(v) for v in values]), "own")
    # quantiles come from the narrow columns alone
    below = prefix.running(
        own, ["conv_id"], ["depth"], {}, backward={f"below_{v}": ("sum", F.col(v)) for v in values}, cut_by=own.select("conv_id", "depth"))
    return below.groupBy(*KEY).agg(*[F.sum(f"below_{v}").alias(v) for v in values])


def ends(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of nodes where conversations end: the digest of their ids, ascending.

    Ids are range-partitioned by node and id and joined to blocks of text there, so the ids of a node that ends very many
    conversations are sorted by many tasks; one task then reads the blocks of a node in order and hashes them as they come.
    """
    zero = F.lit(0).cast("long")
    ended = rows.filter("last").select(F.col("depth").cast("long").alias("depth"), "p1", "p2", "conv_id")
    turnless = ids.filter("turnless").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id")
    n = partitions(rows.sparkSession)
    placed = ended.unionByName(turnless).repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")

    def runs(batches: Iterator[pa.RecordBatch], value: str) -> Iterator[tuple[tuple, list]]:
        for batch in batches:
            at, last = [], None
            for *key, v in zip(*[batch.column(c).to_pylist() for c in (*KEY, value)]):
                if key != last and at:
                    yield tuple(last), at
                    at = []
                last = key
                at.append(v)
            if at:
                yield tuple(last), at

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, found in runs(batches, "conv_id"):
            cuts = [found[i:i + IDS] for i in range(0, len(found), IDS)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k] * len(cuts), pa.int64()) for k in key], pa.array([c[0] for c in cuts], pa.int64()),
                 pa.array([",".join(map(str, c)) for c in cuts], pa.string())], [*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        told = lambda: pa.RecordBatch.from_arrays(
            [*[pa.array([k], pa.int64()) for k in now], pa.array([state.hexdigest()], pa.string())], [*KEY, "ends_sha256"])
        for key, found in runs(batches, "ids"):
            if key != now:
                if state:
                    yield told()
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(found).encode())
        if state:
            yield told()

    blocks = placed.mapInArrow(pack, "depth long, p1 long, p2 long, first long, ids string")
    return blocks.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame, rebuild=rebuilt) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuild`` makes the sequences (conv_id, depth, digest, chars) out of the numbered turns; None takes them as they are.
    saved_tokens sums (n_convs - 1) times the length of the last text over the subtree, n_leaves counts its childless nodes.
    """
    numbered = stored(turns(conversations), "turns")
    sequences = rebuild(numbered) if rebuild else numbered.select("conv_id", (F.col("idx") + 1).alias("depth"), "digest", "chars")
    rows = stored(members(stored(sequences, "sequences")), "members")
    ids = numbered.select("conv_id").distinct().join(
        rows.filter("depth = 1").select("conv_id", F.lit(False).alias("t")), "conv_id", "left").select("conv_id", F.col("t").isNull().alias("turnless"))
    named = stored(nodes(rows, ids), "nodes")
    parents = named.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    children = named.filter("q1 is not null").groupBy("depth", "q1", "q2").agg(F.count("*").alias("k")).select(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), "k")
    linked = joined_to_unique(named, parents, ["depth", "q1", "q2"]).join(children, KEY, "left").withColumn("k", F.coalesce("k", F.lit(0)))
    linked = stored(linked, "linked")
    zero = F.lit(0).cast("long")
    top = ids.select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    sums = subtree_sums(top.unionByName(rows.select("conv_id", F.col("depth").cast("long").alias("depth"), "p1", "p2")), linked.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"), (F.col("k") == 0).cast("long").alias("n_leaves"),
    ), ["saved_tokens", "n_leaves"])
    none = hashlib.sha256().hexdigest()
    return linked.join(sums, KEY).join(ends(rows, ids), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("k").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
