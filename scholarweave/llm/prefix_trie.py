"""Trie of the prefixes that conversations share, with totals over every subtree.

**Turns to nodes.** Turns are put in order by a range partitioning and numbered within their
conversation. A turn is known by 128 bits of hash of its role and text, and a prefix by the
exclusive or of the hashes of its turns with their places, so that the key of every prefix
is a running ``bit_xor`` in which parts of a long conversation can be worked on apart. Equal
prefixes are one node; a node's parent has the key without the last turn.

**Totals by parallel tree contraction.** Rounds alternate two steps, each one join of the
nodes with messages that partial aggregation has combined:

- *Rake*: every leaf is taken off and adds its total to its parent.
- *Compress*: of a chain of nodes with a single child, those are taken out whose coin shows
  one and whose parent's coin shows zero, which no two neighbours do. The child takes the
  grandparent as its parent and keeps what lay between as a value of its edge.

A node knows its number of children and the exclusive or of their ids, which is the child's
id once there is one, so messages always go to single nodes and a node with very many
children is never a join key of theirs. A chain shrinks by a quarter a round, so the number
of rounds grows with the logarithm of the depth. Then the compressed nodes are
re-expanded, last round first: a node's total is its own value, what lay on the edge of the
child it had, and that child's total, known from a later round.

Every round is a stored table of nodes still there, leaves raked and nodes compressed.

Defined results: rows without a conversation id take no part. Turns without a number come
first; turns of one number go by the hash of role and text, equal rows stay as often as they
are there. A null role or text is empty. A text of any length is read whole. A conversation
may hold most rows: its turns are worked on in parts. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarweave.llm import texts
from scholarweave.llm.spread import join_unique
from scholarweave.workspace import materialise

#: Turns of one conversation that are numbered or hashed as one part.
PART_BITS = 10
#: Ids of conversations that end in one node, as one text to hash.
PAGE_BITS = 8

_ID = ["a", "b"]
_PARENT = ["pa", "pb"]


def _xor(left: Column | str, right: Column | str) -> Column:
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    return F.coalesce(left, F.lit(0)).bitwiseXOR(F.coalesce(right, F.lit(0)))


def numbered_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, x, y, n_bytes) of every turn, and (conv_id, length) of every conversation."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    turns = df.where(F.col("`conv_id`").isNotNull()).select(
        F.col("`conv_id`").cast("bigint").alias("conv_id"), F.col("`turn`").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit("second"), role, text).alias("y"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "x", "y"]
    # Equal rows are told apart by chance only to let a range end between them.
    split = turns.withColumn("_chance", F.rand(7))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = materialise(
        split.repartitionByRange(parts, *order, "_chance").sortWithinPartitions(*order, "_chance")
        .drop("_chance").withColumn("_at", F.monotonically_increasing_id()),
        "turns",
    )
    piece = F.shiftright("_at", 33)
    sizes = stored.groupBy(piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each shuffle partition.
    offsets = sizes.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = stored.withColumn("_piece", piece).join(F.broadcast(offsets), "_piece").withColumn(
        "_row", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    )
    conversations = materialise(
        rows.groupBy("conv_id").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("length")), "conversations"
    )
    part = lambda row: F.shiftright(row, PART_BITS)
    spans = conversations.select(
        "conv_id", "first", F.explode(F.sequence(part("first"), part(F.col("first") + F.col("length") - 1))).alias("_part")
    )
    placed = rows.withColumn("_part", part("_row")).join(spans, ["conv_id", "_part"]).select(
        "conv_id", (F.col("_row") - F.col("first") + 1).alias("place"), "x", "y", "n_bytes"
    )
    return materialise(placed, "placed"), conversations.select("conv_id", "length")


def shared_beginnings(
    placed: DataFrame, conversations: DataFrame, family: int = 5, most: int = 9
) -> tuple[DataFrame, DataFrame]:
    """Give each conversation c the first turns of c - c % family, then its own later ones.

    The number of turns is crc32(c) % most. What :func:`numbered_turns` returns, changed.
    """
    wanted = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = conversations.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    plan = conversations.withColumn("wanted", wanted).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    plan = plan.join(base, "base", "left").withColumn("taken", F.least("wanted", F.coalesce("base_length", F.lit(0))))
    plan = materialise(plan, "beginnings")
    taken = placed.where((F.col("place") < most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    heads = taken.join(plan.select("conv_id", "base", "taken"), "base").where("place <= taken")
    # Spans of a conversation's own turns, so that a long one is not one key.
    part = F.shiftright("place", PART_BITS)
    spans = plan.select("conv_id", "wanted", "taken", F.explode(F.sequence(F.lit(0), F.shiftright("length", PART_BITS))).alias("_part"))
    tails = placed.withColumn("_part", part).join(spans, ["conv_id", "_part"]).where("place > wanted").withColumn(
        "place", F.col("place") - F.col("wanted") + F.col("taken")
    )
    names = ["conv_id", "place", "x", "y", "n_bytes"]
    length = F.col("taken") + F.greatest(F.lit(0), F.col("length") - F.col("wanted"))
    return heads.select(*names).unionByName(tails.select(*names)), plan.select("conv_id", length.alias("length"))


def prefix_steps(placed: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, n_bytes): the node that each turn leads to, and its parent."""
    hashed = placed.select(
        "conv_id", F.col("place").alias("depth"), F.shiftright(F.col("place") - 1, PART_BITS).alias("_part"), "n_bytes",
        F.xxhash64("place", "x", "y").alias("t"), F.xxhash64(F.lit("second"), "y", "place", "x").alias("u"),
    )
    inside = Window.partitionBy("conv_id", "_part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = hashed.groupBy("conv_id", "_part").agg(F.bit_xor("t").alias("t"), F.bit_xor("u").alias("u"))
    # One row for each part of a conversation that has more than one.
    later = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "_part", F.bit_xor("t").over(later).alias("_t"), F.bit_xor("u").over(later).alias("_u")).where("_part > 0")
    running = hashed.select("*", F.bit_xor("t").over(inside).alias("_a"), F.bit_xor("u").over(inside).alias("_b"))
    keyed = running.join(before, ["conv_id", "_part"], "left").withColumns({"a": _xor("_a", "_t"), "b": _xor("_b", "_u")})
    return keyed.select("conv_id", "depth", "a", "b", _xor("a", "t").alias("pa"), _xor("b", "u").alias("pb"), "n_bytes")


def _coin(first: str, second: str, round_: int) -> Column:
    return F.xxhash64(F.lit(round_), first, second).bitwiseAND(1)


def _rake(nodes: DataFrame, values: list[str]) -> DataFrame:
    """The nodes that are no leaves, with what their leaves add."""
    leaf = (F.col("n") == 0) & F.col("pa").isNotNull()
    sent = nodes.where(leaf).groupBy(F.col("pa").alias("_a"), F.col("pb").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor("a").alias("_ca"), F.bit_xor("b").alias("_cb"),
        *[F.sum(F.col(v) + F.col(f"edge_{v}")).alias(f"_{v}") for v in values],
    )
    left = nodes.where(~leaf).join(sent, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
    return left.select(
        *_ID, *_PARENT, (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"), _xor("ca", "_ca").alias("ca"), _xor("cb", "_cb").alias("cb"),
        *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values], *[f"edge_{v}" for v in values],
    )


def _compress(nodes: DataFrame, values: list[str], round_: int) -> DataFrame:
    """The nodes that stay (state 0), and a record of each one taken out (state 2): its child
    stands as its parent, its values are what its total has beside the child's."""
    chosen = (F.col("n") == 1) & F.col("pa").isNotNull() & (_coin("a", "b", round_) == 1) & (_coin("pa", "pb", round_) == 0)
    chain = nodes.where(chosen)
    nothing = F.lit(None).cast("bigint")
    to_child = chain.select(
        F.col("ca").alias("_a"), F.col("cb").alias("_b"), F.col("pa").alias("_pa"), F.col("pb").alias("_pb"),
        F.col("a").alias("_va"), F.col("b").alias("_vb"), nothing.alias("_ca"), nothing.alias("_cb"),
        *[F.col(v).alias(f"_{v}") for v in values], *[F.col(f"edge_{v}").alias(f"_edge_{v}") for v in values],
    )
    to_parent = chain.select(
        F.col("pa").alias("_a"), F.col("pb").alias("_b"), *[nothing.alias(c) for c in ("_pa", "_pb", "_va", "_vb")],
        _xor("a", "ca").alias("_ca"), _xor("b", "cb").alias("_cb"),
        *[nothing.alias(f"_{v}") for v in values], *[nothing.alias(f"_edge_{v}") for v in values],
    )
    # At most one message of a chosen parent reaches a node, so a maximum is that one's value.
    sent = to_child.unionByName(to_parent).groupBy("_a", "_b").agg(
        *[F.max(c).alias(c) for c in ("_pa", "_pb", "_va", "_vb")], *[F.bit_xor(c).alias(c) for c in ("_ca", "_cb")],
        *[F.max(f"_{v}").alias(f"_{v}") for v in values], *[F.max(f"_edge_{v}").alias(f"_edge_{v}") for v in values],
    )
    met = nodes.where(~chosen | F.col("pa").isNull()).join(sent, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
    zero = F.lit(0).cast("bigint")
    moved = F.col("_va").isNotNull()
    stays = F.struct(
        F.lit(0).alias("state"), "a", "b", F.when(moved, F.col("_pa")).otherwise(F.col("pa")).alias("pa"),
        F.when(moved, F.col("_pb")).otherwise(F.col("pb")).alias("pb"), "n", _xor("ca", "_ca").alias("ca"), _xor("cb", "_cb").alias("cb"),
        *[F.col(v).alias(v) for v in values],
        *[(F.col(f"edge_{v}") + F.coalesce(f"_{v}", zero) + F.coalesce(f"_edge_{v}", zero)).alias(f"edge_{v}") for v in values],
    )
    gone = F.struct(
        F.lit(2).alias("state"), F.col("_va").alias("a"), F.col("_vb").alias("b"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        zero.alias("n"), zero.alias("ca"), zero.alias("cb"),
        *[(F.col(f"_{v}") + F.col(f"edge_{v}")).alias(v) for v in values], *[zero.alias(f"edge_{v}") for v in values],
    )
    return met.select(F.explode(F.when(moved, F.array(stays, gone)).otherwise(F.array(stays))).alias("r")).select("r.*")


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(a, b, values): sums over the subtree of each node, itself included.

    ``tree`` is a stored table of nodes with the id (a, b), the parent's id (pa, pb), null for
    a root, the number n of children and the exclusive or (ca, cb) of their ids.
    """
    zero = F.lit(0).cast("bigint")
    state = ["a", "b", "pa", "pb", "n", "ca", "cb", *values, *[f"edge_{v}" for v in values]]
    nodes = tree.select("a", "b", "pa", "pb", "n", "ca", "cb", *values, *[zero.alias(f"edge_{v}") for v in values])
    rounds: list[DataFrame] = []
    while not nodes.where(F.col("pa").isNotNull()).isEmpty():
        raked = nodes.where((F.col("n") == 0) & F.col("pa").isNotNull()).select(F.lit(1).alias("state"), *state)
        after = _compress(_rake(nodes, values), values, len(rounds))
        rounds.append(materialise(after.unionByName(raked), "contracted"))
        nodes = rounds[-1].where("state = 0").select(*state)
    roots = nodes.select(*_ID, *values)
    known = [roots]
    for done in reversed(rounds):
        # Of one round, a compressed node's child is still there after it, so its total is known.
        later = _union(known)
        child = later.select(F.col("a").alias("pa"), F.col("b").alias("pb"), *[F.col(v).alias(f"_{v}") for v in values])
        expanded = done.where("state = 2").join(child, _PARENT).select(
            *_ID, *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in values]
        )
        known.append(materialise(expanded, "expanded"))
        known.append(done.where("state = 1").select(*_ID, *values))
    return _union(known)


def _union(tables: list[DataFrame]) -> DataFrame:
    while len(tables) > 1:
        tables = [t[0].unionByName(t[1]) if len(t) == 2 else t[0] for t in (tables[i : i + 2] for i in range(0, len(tables), 2))]
    return tables[0]


def hashed_members(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): hash of the ascending, comma-joined ids of the rows of each node.

    Ids are sorted and joined in pages of a range of ids; the pages of a node run through
    one hash in their order, a batch at a time.
    """
    page = F.shiftright("conv_id", PAGE_BITS)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    pages = ends.groupBy("a", "b", page.alias("page")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(ids.encode())
            yield _hashes(done)
        yield _hashes([] if node is None else [(*node, state.hexdigest())])

    return pages.repartition("a", "b").sortWithinPartitions("a", "b", "page").select("a", "b", "ids").mapInArrow(
        run, "a long, b long, ends_sha256 string"
    )


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    a, b, digest = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())], ["a", "b", "ends_sha256"])


def trie(placed: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node of the trie of the given sequences, as :func:`numbered_turns` returns them.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that need no second reading) and ends_sha256.
    """
    texts.with_workers(placed.sparkSession)
    steps = materialise(prefix_steps(placed), "steps")
    lengths = materialise(conversations, "lengths")
    none = F.lit(None).cast("bigint")
    inner = steps.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("n_bytes").alias("n_bytes"),
    )
    zero = F.lit(0).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", zero.alias("depth"), none.alias("pa"), none.alias("pb"), zero.alias("n_bytes")
    )
    nodes = materialise(inner.unionByName(root), "nodes")
    children = nodes.where(F.col("pa").isNotNull()).groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb")
    )
    tree = nodes.join(children, _ID, "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("n", "ca", "cb")}
        | {"n_leaves": F.when(F.col("n").isNull(), 1).otherwise(0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}
    )
    tree = materialise(tree, "tree")
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])

    named = join_unique(
        nodes.where(F.col("pa").isNotNull()).select(*_ID, *_PARENT),
        nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id")),
        _PARENT, F.xxhash64(*_ID),
    ).select(*_ID, "parent_conv_id")
    ended = steps.join(lengths.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]).select(*_ID, "conv_id")
    ended = ended.unionByName(lengths.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    return (
        tree.select(*_ID, "conv_id", "depth", "n_convs", F.col("n").alias("n_children"))
        .join(totals, _ID).join(named, _ID, "left").join(hashed_members(ended), _ID, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
