"""Trie of conversation prefixes, with sums over subtrees by an Euler tour.

Conversations become rows of turn digests. Running sums of hashes of digest and
place name each prefix, so a node is a group of equal names. Every node has an arc
that enters it and one that leaves it; the arcs form a list, which is ranked in
blocks. A subtree is what stands between its two arcs, so leaves and savings below
a node are differences of the sums that come with the ranks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.llm.keyed import join_keyed
from cellsift.llm.scan import running
from cellsift.llm.tour import BLOCK_ROWS, ranked
from cellsift.sources.scratch import cut_lineage

#: A conversation begins with turns of the first conversation of its hundred: fewer than this.
SHARED_TURNS = 6
HUNDRED = 100
#: Names of prefixes are four sums of 32-bit hashes.
LANES = [f"s{k}" for k in range(4)]
NAME = ["depth", *LANES]
#: Ends of a node are joined in chunks of ids that agree but for so many bits.
CHUNK_BITS = 12


def _shared(conv: str) -> F.Column:
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % SHARED_TURNS).cast("long")


def rebuilt(conversations: DataFrame, kept: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(conv, pos, digest, chars)`` of each rebuilt turn, from 1, and ``conv`` of every conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("_turn"), role.alias("_role"), text.alias("_text"),
        F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("i"),
    )
    # The place of a turn is a running count.
    order = [F.col(c).asc_nulls_first() for c in ("_turn", "_role", "_text")]
    own = running(turns, ["conv"], order, ["i"], kept)
    own = own.withColumns({"base": F.col("conv") - F.col("conv") % HUNDRED, "h": _shared("conv")})
    own = cut_lineage(own, "turns", kept)
    # How many of its first turns the first conversation of a hundred can give.
    offer = F.max(F.when(F.col("conv") == F.col("base"), F.least("i", F.lit(SHARED_TURNS - 1).cast("long"))))
    hundreds = own.groupBy("base").agg(F.count("*").alias("n"), F.coalesce(offer, F.lit(0).cast("long")).alias("offer"))
    rest = join_keyed(own.where("i > h"), hundreds, "base", "n")
    rest = rest.select("conv", (F.least("h", "offer") + F.col("i") - F.col("h")).alias("pos"), "digest", "chars")
    convs = own.select("conv", "base", "h").distinct()
    given = own.where((F.col("conv") == F.col("base")) & (F.col("i") < SHARED_TURNS))
    given = given.select("base", F.col("i").alias("pos"), "digest", "chars")
    # At most a hundred conversations meet at most five turns.
    taken = convs.where("h > 0").join(given, "base").where("pos <= h").select("conv", "pos", "digest", "chars")
    return taken.unionByName(rest), convs.select("conv")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each name whose chunks come one after another."""
    name, sha = None, None

    def row() -> pa.RecordBatch:
        columns = dict(zip(NAME, ([x] for x in name)))
        return pa.RecordBatch.from_pydict(columns | {"ends_sha256": [sha.hexdigest()]})

    for batch in batches:
        for *key, part in zip(*(c.to_pylist() for c in batch.columns)):
            if key != name:
                if name is not None:
                    yield row()
                name, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(part.encode())
    if name is not None:
        yield row()


def ends(last: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that end at each name.

    Ids are sorted and joined in chunks of 4096 at most, anywhere; only the
    digest itself, which has to read them in turn, streams through one task.
    """
    chunks = last.groupBy(*NAME, F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids")
    )
    dealt = chunks.repartition(*NAME).sortWithinPartitions(*NAME, "chunk").select(*NAME, "ids")
    return dealt.mapInArrow(_digests, ", ".join(f"{c} long" for c in NAME) + ", ends_sha256 string")


def _arcs(nodes: DataFrame) -> DataFrame:
    """Two arcs of each node, each with its successor; weights stand at the entering ones."""
    leaf, down = F.col("n_children") == 0, 2 * F.col("depth")
    none = F.lit(0).cast("long")
    step = F.lit(1).cast("long")
    enter = F.struct(
        F.col("conv_id").alias("a"), down.alias("b"),
        F.when(leaf, F.col("conv_id")).otherwise(F.col("first_child")).alias("sa"),
        F.when(leaf, down + 1).otherwise(down + 2).alias("sb"),
        step.alias("steps"), leaf.cast("long").alias("leaves"), F.col("saves").alias("saved"),
    )
    last = F.col("next").isNull()
    leave = F.struct(
        F.col("conv_id").alias("a"), (down + 1).alias("b"),
        F.when(last, F.col("parent_conv_id")).otherwise(F.col("next")).alias("sa"),
        F.when(last, F.when(F.col("parent_conv_id").isNotNull(), down - 1)).otherwise(down).alias("sb"),
        step.alias("steps"), none.alias("leaves"), none.alias("saved"),
    )
    return nodes.select(F.inline(F.array(enter, leave)))


def prefix_trie(conversations: DataFrame, kept: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``, and ``n_nodes`` of the subtree with the places ``enter_at`` and
    ``exit_at`` of the node's arcs in the tour. A node is the smallest id of a
    conversation that starts with it, and its depth.

    Turns are ordered by ``turn``, null first; equal ones by role and text. A null
    role or text is an empty one. Rows without ``conv_id`` belong to no
    conversation, as nothing can be rebuilt without a number, and are left out.
    Repeated rows are repeated turns. An empty table has no nodes; other columns are
    ignored. A conversation may have any number of turns, and a node any number of
    children and members: no group of either is held by one task.
    """
    turns, convs = rebuilt(conversations, kept)
    lanes = [F.shiftrightunsigned(F.xxhash64(F.lit(k), "digest", "pos"), 32) for k in range(len(LANES))]
    turns = turns.withColumn("depth", F.col("pos"))
    turns = turns.withColumns(dict(zip(LANES, lanes)) | {f"own_{c}": x for c, x in zip(LANES, lanes)})
    summed = cut_lineage(running(turns, ["conv"], [F.col("pos")], LANES, kept), "prefixes", kept)

    parent = F.struct((F.col("depth") - 1).alias("depth"), *((F.col(c) - F.col(f"own_{c}")).alias(c) for c in LANES))
    step = F.struct(parent.alias("parent"), "digest", "chars")
    nodes = summed.groupBy(F.struct(*NAME).alias("name")).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min(step).alias("step"), F.max(step).alias("most")
    )
    # Equal names with equal last turns and parents of equal names: by induction, equal prefixes.
    torn = F.raise_error(F.lit("two prefixes share a name"))
    nodes = nodes.withColumn("n_convs", F.when(F.col("step") == F.col("most"), F.col("n_convs")).otherwise(torn.cast("long")))
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in NAME))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = nodes.select("name", "step.parent", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("step.chars")).alias("saves"))
    nodes = nodes.unionByName(
        root.select(zero.alias("name"), F.lit(None).cast(nodes.schema["parent"].dataType).alias("parent"), "conv_id", "n_convs",
                    F.lit(0).cast("long").alias("saves"))
    )
    nodes = cut_lineage(nodes, "nodes", kept)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child")
    )
    nodes = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = cut_lineage(nodes, "families", kept)
    parents = nodes.where("n_children > 0").select(
        F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings")
    )
    below = join_keyed(nodes.where("parent is not null"), parents, "parent", "siblings").drop("siblings")
    below = below.withColumn("depth", F.col("name.depth")).drop("parent")
    # Backwards, the row before is the next sibling.
    below = running(below, ["depth", "parent_conv_id"], [F.desc("conv_id")], [], kept, lag="conv_id")
    below = below.withColumnRenamed("_former", "next")
    top = nodes.where("parent is null").drop("parent").withColumns(
        {"parent_conv_id": F.lit(None).cast("long"), "depth": F.lit(0).cast("long"), "next": F.lit(None).cast("long")}
    )
    nodes = cut_lineage(below.unionByName(top), "siblings", kept)

    places = ranked(_arcs(nodes), ["steps", "leaves", "saved"], kept, block_rows)
    leaves_ = F.col("b") % 2 == 1
    spans = places.groupBy(F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth")).agg(
        *(F.sum(F.when(~leaves_, F.col(c))).alias(f"in_{c}") for c in ("steps", "leaves", "saved")),
        *(F.sum(F.when(leaves_, F.col(c))).alias(f"out_{c}") for c in ("steps", "leaves", "saved")),
    )
    last = convs.select("conv", zero.alias("z")).unionByName(
        summed.groupBy("conv").agg(F.max(F.struct(*NAME)).alias("z"))
    )
    last = last.groupBy("conv").agg(F.max("z").alias("z")).select("conv", "z.*")
    digests = ends(last).select(F.struct(*NAME).alias("name"), "ends_sha256")
    out = nodes.join(digests, "name", "left").join(spans, ["conv_id", "depth"])
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("out_leaves") - F.col("in_leaves")).alias("n_leaves"),
        (F.col("out_saved") - F.col("in_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ((F.col("out_steps") - F.col("in_steps") + 1) / 2).cast("long").alias("n_nodes"),
        F.col("in_steps").alias("enter_at"), F.col("out_steps").alias("exit_at"),
    )
