"""Trie of conversation prefixes, built by blocks of turns.

A node is a distinct sequence of first turns; its members are the conversations
that start with it. Grouping every turn of every conversation would exchange as
many rows as there are turns. Here conversations are cut into blocks of BLOCK
turns and grouped by the digests at the ends of successive blocks first. Where all
conversations that enter a block leave it by the same turns, the nodes inside are
known from the block; where one conversation is alone, its nodes are its own.
Only in blocks whose siblings diverge are rows of single turns grouped.

The digest of a prefix is the sum, over its turns, of a hash of place and turn:
four lanes modulo 2**32, so that running sums give the digests of all prefixes.

Values over subtrees need no walk up the tree. Every node belongs to its
smallest member, the nodes a conversation owns are the deepest ones of its path,
and so the sums over a subtree are sums over the members of its top
(:func:`nodes`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import slices, task_count
from stratagate.operators.sizing import broadcast_if_small
from stratagate.session import written

BLOCK = 4
#: Turns of one conversation that a running sum goes through at once; whole blocks.
CHUNK = 1024
#: Ids of a node's members joined into one text, as a power of two.
IDS_BITS = 12
LANES = 4
_LANE = 0xFFFFFFFF
NO_IDS = hashlib.sha256(b"").hexdigest()

#: The workload's rebuilding: conversations of one group take up to so many first
#: turns from the group's first one.
GROUP, MOST_GRAFTED = 100, 5


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, tokens): role and text by digest, and its code points."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.concat_ws(":", F.length(role), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(said.cast("binary"), 256), 1, 32).alias("digest"),
        F.length(text).cast("long").alias("tokens"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, place, digest, tokens): turns of a conversation numbered from 1.

    Rows are sorted over ranges of (conv_id, turn, digest), numbered inside each
    range, and the counts of earlier ranges are added, which only conversations
    in several ranges have: at most as many as there are ranges.
    """
    spark = rows.sparkSession
    order = ["conv_id", "turn", "digest"]
    # repeated rows differ by their number, so they are dealt out too
    ranged = written(
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(task_count(spark), *order, "_row")
        .withColumn("_range", F.spark_partition_id()),
        "turns",
    )
    earlier = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    carried = counted.select("conv_id", "_range", F.sum("_n").over(earlier).alias("_before"))
    carried = written(carried.where("_before > 0"), "carried")
    here = Window.partitionBy("conv_id", "_range").orderBy("turn", "digest", "_row")
    return (
        ranged.withColumn("_at", F.row_number().over(here))
        .join(broadcast_if_small(carried), ["conv_id", "_range"], "left")
        .select(
            "conv_id",
            (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("long").alias("place"),
            "digest",
            "tokens",
        )
    )


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The workload's conversations: a common start, then what is their own.

    From (conv_id, place, digest, tokens) the conversations (conv_id, n) and
    their turns (conv_id, n, place, digest, tokens). Conversation c starts with
    the first h turns of c - c % 100, as many as there are, and goes on with its
    own turns after its first h; h is the unsigned CRC-32 of c in decimal, modulo 6.
    """
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    grafted = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_GRAFTED + 1)
    lengths = own.groupBy("conv_id").agg(F.max("place").alias("_own"))
    bases = lengths.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_base"), F.col("_own").alias("_base_n")
    )
    bases = written(bases, "bases")
    keyed = lengths.withColumn("_base", first).withColumn("_h", grafted)
    taken = F.least("_h", F.coalesce("_base_n", F.lit(0).cast("long")))
    convs = (
        keyed.join(broadcast_if_small(bases), "_base", "left")
        .withColumn("_taken", taken)
        .withColumn("n", F.col("_taken") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0)))
        .select("conv_id", "n", "_base", "_taken")
    )
    convs = written(convs, "conversations")
    kept = (
        own.withColumn("_h", grafted)
        .where("place > _h")
        .join(broadcast_if_small(convs.select("conv_id", "n", "_taken")), "conv_id")
        .select("conv_id", "n", (F.col("place") - F.col("_h") + F.col("_taken")).alias("place"), "digest", "tokens")
    )
    # at most MOST_GRAFTED turns of a base, for at most 2 * GROUP conversations
    heads = own.where((F.col("conv_id") % GROUP == 0) & (F.col("place") <= MOST_GRAFTED))
    heads = heads.withColumnRenamed("conv_id", "_base")
    starts = convs.where("_taken > 0").join(heads, "_base").where("place <= _taken")
    columns = ["conv_id", "n", "place", "digest", "tokens"]
    return convs.select("conv_id", "n"), kept.select(columns).unionByName(starts.select(columns))


def _packed(lanes: list[Column]) -> list[Column]:
    """Four lanes of 32 bits as two longs."""
    return [F.shiftleft(lanes[i], 32).bitwiseOR(lanes[i + 1]) for i in (0, 2)]


def blocks(rows: DataFrame) -> DataFrame:
    """One row per block of turns, with the digests before it and behind each turn.

    Running sums go over chunks of a conversation; the sums of its earlier chunks
    are added, which only conversations of more than CHUNK turns have.
    """
    lane = [f"_d{i}" for i in range(LANES)]
    hashed = rows.select(
        "conv_id",
        "n",
        "place",
        "tokens",
        F.floor((F.col("place") - 1) / CHUNK).alias("_chunk"),
        *[F.xxhash64(F.lit(i), "place", "digest").bitwiseAND(F.lit(_LANE)).alias(c) for i, c in enumerate(lane)],
    )
    sums = [*lane, "tokens"]
    so_far = Window.partitionBy("conv_id", "_chunk").orderBy("place")
    running = hashed.select(
        "conv_id", "n", "place", "tokens", "_chunk",
        *[F.sum(c).over(so_far).alias(f"_sum_{c}") for c in sums],
        *[(F.sum(c).over(so_far) - F.col(c)).alias(f"_before_{c}") for c in lane],
    )
    turn = F.struct(
        "place", "tokens", *[F.col(f"_sum_{c}").alias(c if c != "tokens" else "total") for c in sums]
    )
    cut = running.groupBy(
        "conv_id", "n", "_chunk", F.floor((F.col("place") - 1) / BLOCK).alias("block")
    ).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.min_by(F.struct(*[F.col(f"_before_{c}").alias(c) for c in lane]), "place").alias("start"),
    )
    cut = written(cut, "blocks")
    chunks = (
        cut.where(F.col("n") > CHUNK)
        .groupBy("conv_id", "_chunk")
        .agg(F.max_by(F.element_at("turns", -1), "block").alias("_last"))
    )
    earlier = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    named = [*lane, "total"]
    carried = chunks.select(
        "conv_id", "_chunk", *[F.sum(f"_last.{c}").over(earlier).alias(f"_carry_{c}") for c in named]
    ).where(F.col("_chunk") > 0)
    carried = written(carried, "carried")
    carry = {c: F.coalesce(f"_carry_{c}", F.lit(0).cast("long")) for c in named}

    def modulo(value: Column, c: str) -> Column:
        return (value + carry[c]).bitwiseAND(F.lit(_LANE))

    def whole(t: Column) -> Column:
        p = _packed([modulo(t[c], c) for c in lane])
        return F.struct(
            t["place"].alias("place"), t["tokens"].alias("tokens"),
            (t["total"] + carry["total"]).alias("total"), p[0].alias("p0"), p[1].alias("p1"),
        )

    start = _packed([modulo(F.col(f"start.{c}"), c) for c in lane])
    return cut.join(broadcast_if_small(carried), ["conv_id", "_chunk"], "left").select(
        "conv_id", "n", "block", start[0].alias("s0"), start[1].alias("s1"),
        F.transform("turns", whole).alias("turns"),
    )


def shared_places(cut: DataFrame) -> DataFrame:
    """Places of conversations in nodes of more than one member.

    (conv_id, n, place, total, least, n_convs, ends): the node's smallest member,
    how many members it has, and how many of them end there.
    """
    last = F.element_at("turns", -1)
    closed = cut.withColumn("_end", last)
    leaving = closed.groupBy("block", "s0", "s1", "_end.place", "_end.p0", "_end.p1").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("conv_id").alias("_least"),
        F.count_if(F.col("_end.place") == F.col("n")).alias("_ends"),
    )
    entering = (
        leaving.groupBy("block", "s0", "s1")
        .agg(
            F.sum("_n").alias("_n"),
            F.count(F.lit(1)).alias("_ways"),
            F.min("_least").alias("_least"),
            F.sum("_ends").alias("_ends"),
        )
        .where("_n > 1")
    )
    entering = written(entering, "entering")
    # all conversations enter the first block by one key, which is one row here
    first = cut.where("block = 0").join(F.broadcast(entering.where("block = 0")), ["block", "s0", "s1"])
    later = cut.where("block > 0").join(
        broadcast_if_small(entering.where("block > 0")), ["block", "s0", "s1"]
    )
    met = first.unionByName(later)
    turn = F.inline("turns")
    straight = met.where("_ways = 1").withColumn("_end", last).select(
        "conv_id", "n", "_least", "_n", "_ends", F.col("_end.place").alias("_at"), turn
    ).select(
        "conv_id", "n", "place", "total", F.col("_least").alias("least"), F.col("_n").alias("n_convs"),
        F.when(F.col("place") == F.col("_at"), F.col("_ends")).otherwise(0).alias("ends"),
    )
    diverging = met.where("_ways > 1").select("conv_id", "n", turn)
    node = ["place", "p0", "p1"]
    refined = (
        diverging.groupBy(*node)
        .agg(
            F.min("conv_id").alias("least"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if(F.col("place") == F.col("n")).alias("ends"),
        )
        .where("n_convs > 1")
    )
    refined = written(refined, "refined")
    inside = diverging.join(broadcast_if_small(refined), node).select(straight.columns)
    return straight.unionByName(inside)


def members(convs: DataFrame, cut: DataFrame, shared: DataFrame) -> DataFrame:
    """What each conversation brings to the nodes it is a member of.

    (conv_id, n, total, shared_to, parent, owned, leaf): its code points; the
    deepest place whose node has a smaller member, and that member; the code
    points of the nodes below, which it owns; whether it owns a childless node.
    """
    foreign = F.col("least") != F.col("conv_id")
    met = shared.groupBy("conv_id").agg(
        F.max(F.when(foreign, F.struct("place", "least", "total"))).alias("_foreign"),
        F.max(F.when(F.col("place") == F.col("n"), F.struct("least", "n_convs", "ends"))).alias("_end"),
    )
    totals = cut.where(F.element_at("turns", -1)["place"] == F.col("n")).select(
        "conv_id", F.element_at("turns", -1)["total"].alias("total")
    )
    zero = F.lit(0).cast("long")
    end = F.col("_end")
    alone = (end["least"] == F.col("conv_id")) & (end["ends"] == end["n_convs"])
    return (
        convs.join(totals, "conv_id", "left")
        .join(met, "conv_id", "left")
        .select(
            "conv_id",
            "n",
            F.coalesce("total", zero).alias("total"),
            F.coalesce("_foreign.place", zero).alias("shared_to"),
            F.col("_foreign.least").alias("parent"),
            (F.coalesce("total", zero) - F.coalesce("_foreign.total", zero)).alias("owned"),
            ((F.col("n") > 0) & F.coalesce(alone, F.lit(True))).cast("long").alias("leaf"),
        )
    )


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the id texts of each node, which arrive in order."""
    node, state = None, None

    def row():
        return pa.RecordBatch.from_pydict(
            {"least": [node[0]], "place": [node[1]], "ends_sha256": [state.hexdigest()]},
            schema=pa.schema([("least", pa.int64()), ("place", pa.int64()), ("ends_sha256", pa.string())]),
        )

    for batch in slices(batches):
        columns = (batch.column(c).to_pylist() for c in ("least", "place", "ids"))
        for least, place, ids in zip(*columns, strict=True):
            if (least, place) != node:
                if node is not None:
                    yield row()
                node, state = (least, place), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield row()


def end_hashes(enders: DataFrame) -> DataFrame:
    """(least, place, ends_sha256) from (least, place, conv_id) of ended members.

    Ids are joined to texts of at most 2**IDS_BITS first. The hash of one node is
    sequential by definition: one task reads these texts in order, none is kept.
    """
    tasks = task_count(enders.sparkSession)
    parts = enders.groupBy(
        "least", "place", F.shiftright("conv_id", IDS_BITS).alias("_part")
    ).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return (
        parts.repartition(tasks, "least", "place")
        .sortWithinPartitions("least", "place", "_part")
        .mapInArrow(_hashed_ids, "least long, place long, ends_sha256 string")
    )


def nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """All nodes of the trie of the conversations (conv_id, n) and their turns.

    Each node is named by its smallest member and depth. For a node v with members
    M and smallest member m, the sum of (members * tokens) over its subtree is what
    the members have from v on, and the sum of tokens over the nodes of the subtree
    is what the members own there: all but m own only nodes below v.
    """
    cut = written(blocks(rows), "blocks")
    shared = written(shared_places(cut), "shared")
    known = written(members(convs, cut, shared), "members")
    top = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.coalesce(F.sum(F.col("total") - F.col("owned")), F.lit(0)).alias("saved"),
        F.count_if((F.col("n") > 0) & (F.col("shared_to") == 0)).alias("children"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves"),
    ).first()
    children = (F.col("shared_to") <= F.col("place")) & (F.col("place") < F.col("n"))
    sums = (
        shared.drop("n", "total")
        .join(known, "conv_id")
        .groupBy("least", "place")
        .agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if(children).alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum("total").alias("_total"),
            F.sum("owned").alias("_owned"),
        )
    )
    zero = F.lit(0).cast("long")
    turnless = known.where("n = 0").select(F.lit(top.least).cast("long").alias("least"), zero.alias("place"), "conv_id")
    ended = shared.where("place = n").select("least", "place", "conv_id").unionByName(turnless)
    ends = written(end_hashes(ended), "ends")
    groups = written(sums.join(ends, ["least", "place"], "left"), "nodes")
    groups = groups.withColumnRenamed("least", "conv_id")
    own = (
        cut.drop("n")
        .join(known, "conv_id")
        .where(F.element_at("turns", -1)["place"] > F.col("shared_to"))
        .select("conv_id", "n", "shared_to", "parent", "owned", F.col("total").alias("_all"), F.inline("turns"))
        .where("place > shared_to")
        .join(broadcast_if_small(groups), ["conv_id", "place"], "left")
    )
    before = F.col("total") - F.col("tokens")
    each = F.col("_total") - F.col("n_convs") * before
    once = F.col("_owned") - F.col("owned") + F.col("_all") - before
    alone = F.col("n_convs").isNull()
    ends_here = F.col("place") == F.col("n")
    below = own.select(
        "conv_id",
        F.col("place").alias("depth"),
        F.when(F.col("place") == 1, F.lit(top.least))
        .when(F.col("place") - 1 == F.col("shared_to"), F.col("parent"))
        .otherwise(F.col("conv_id"))
        .cast("long")
        .alias("parent_conv_id"),
        F.coalesce("n_convs", F.lit(1)).cast("long").alias("n_convs"),
        F.when(alone, (~ends_here).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.when(alone, zero).otherwise(each - once).alias("saved_tokens"),
        F.when(alone & ends_here, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
        .otherwise(F.coalesce("ends_sha256", F.lit(NO_IDS)))
        .alias("ends_sha256"),
    )
    if not top.n:
        return below
    hashed = ends.where("place = 0").select("ends_sha256").first()
    root = cut.sparkSession.createDataFrame(
        [(
            top.least, 0, None, top.n, top.children, top.leaves if top.children else 1,
            top.saved, hashed[0] if hashed else NO_IDS,
        )],
        below.schema,
    )
    return below.unionByName(root)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations.

    A NULL role or text is empty, a NULL turn comes first; turns of equal number
    follow a hash of role and text, and repeated rows count as often as they are
    there. Rows without a conv_id belong to no conversation. An empty table has no
    node, not even a root. Other columns are not looked at.
    """
    own = written(numbered(turns(conversations)), "numbered")
    return nodes(*rebuilt(own))
