"""The trie of conversations' shared beginnings, by digests of fixed-length blocks of turns.

Conversations are grouped by the digests of successive blocks of ``block`` turns first: a group
agrees in all turns up to the end of its last block. Only where the groups that follow one another
group differ (siblings diverge) is the turn looked for at which they part, on one representative
of each group. Everything else follows without a look inside the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import stage
from lumenframe.llm.mixing import word_count

NOTHING = hashlib.sha256(b"").hexdigest()
CHUNK = 4096  # ids of a list that travel as one row


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, o, digest, words): the turns of each conversation numbered from 1."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what).cast("binary"), 256))
    flat = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), word_count(what).cast("long").alias("words")
    )
    place = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return flat.select("conv", F.row_number().over(place).alias("o"), "digest", "words")


def grafted(turns: DataFrame, every: int, modulus: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are replaced by those of the conversation at the last
    multiple of ``every``; h is the CRC-32 of the number modulo ``modulus``. Returns (conv) and
    (conv, part, o, digest, words), in the order of part and o."""
    taken = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % modulus
    convs = turns.where("o = 1").select("conv")
    heads = turns.where((F.col("conv") % every == 0) & (F.col("o") < modulus)).withColumnRenamed("conv", "base")
    near = F.explode(F.sequence(F.lit(1 - every), F.lit(every - 1)))
    heads = heads.withColumn("step", near).withColumn("conv", F.try_add(F.col("base"), F.col("step").cast("long")))
    heads = heads.where((F.col("conv") - F.col("conv") % every == F.col("base")) & (F.col("o") <= taken("conv")))
    heads = heads.join(convs, "conv", "left_semi").select("conv", F.lit(0).alias("part"), "o", "digest", "words")
    own = turns.where(F.col("o") > taken("conv")).select("conv", F.lit(1).alias("part"), "o", "digest", "words")
    return convs, heads.unionByName(own)


def _half(digest: Column, k: int) -> Column:
    """Sixty bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("long")


def blocks(turns: DataFrame, block: int) -> DataFrame:
    """(conv, b, turns, g0, g1, p0, p1, last): blocks of ``block`` turns. p tells the sequence of
    all turns to the end of the block, g to its beginning: 120 bits of the blocks' numbered
    SHA-256 digests XORed. Rows of a conversation stay in one task, where the windows spill."""
    whole = Window.partitionBy("conv")
    turns = turns.select("conv", (F.row_number().over(whole.orderBy("part", "o")) - 1).alias("d"), "digest", "words")
    turns = turns.withColumn("n", F.count("*").over(whole)).withColumn("b", F.floor(F.col("d") / block).cast("int"))
    out = turns.groupBy("conv", "b").agg(F.sort_array(F.collect_list(F.struct("d", "digest", "words"))).alias("turns"), F.max("n").alias("n"))
    parts = F.transform("turns", lambda t: F.hex(t["digest"]))
    own = F.sha2(F.concat_ws("", F.col("b").cast("string"), F.lit(":"), F.concat_ws("", parts)).cast("binary"), 256)
    out = out.withColumn("own", own)
    upto = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    for k in (0, 1):
        out = out.withColumn(f"h{k}", _half(F.col("own"), k)).withColumn(f"p{k}", F.bit_xor(F.col(f"h{k}")).over(upto))
        out = out.withColumn(f"g{k}", F.col(f"p{k}").bitwiseXOR(F.col(f"h{k}")))
    last = F.col("b") * block + F.size("turns") == F.col("n")
    return out.select("conv", "b", "turns", "g0", "g1", "p0", "p1", last.alias("last"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (end, conv) to (end, first, ids): lists of at most CHUNK numbers, comma-joined."""
    end, first, ids = None, None, []

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([end], pa.string()), pa.array([first], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())], ["end", "first", "ids"]
        )

    for b in batches:
        for e, c in zip(b.column("end").to_pylist(), b.column("conv").to_pylist(), strict=True):
            if ids and (e != end or len(ids) == CHUNK):
                yield out()
                ids = []
            if not ids:
                end, first = e, c
            ids.append(c)
    if ids:
        yield out()


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to (end, ends_sha256): a task holds one running hash."""
    end, running = None, None
    for b in batches:
        done = []
        for e, ids in zip(b.column("end").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if e != end:
                if running:
                    done.append((end, running.hexdigest()))
                end, running = e, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.string())], ["end", "ends_sha256"])
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.string()), pa.array([running.hexdigest()], pa.string())], ["end", "ends_sha256"])


def digests_of_lists(ends: DataFrame) -> DataFrame:
    """(end, conv) to (end, ends_sha256): SHA-256 of the ascending conv numbers of each end,
    comma-joined. A long list is sorted by range partitions and travels as chunks; only its
    running hash, which has to see it in order, is in one task."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    lists = ends.repartitionByRange(parts, "end", "conv").sortWithinPartitions("end", "conv")
    lists = lists.mapInArrow(_chunks, "end string, first long, ids string")
    lists = lists.repartition("end").sortWithinPartitions("end", "first")
    return lists.mapInArrow(_list_digests, "end string, ends_sha256 string")


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over the subtree of each node (depth, conv), whose parent is (depth - 1,
    parent); the parent of the root is null.

    After k rounds a node has the sums over its descendants less than 2**k below it, and knows
    its ancestor 2**k above it: the sums of the nodes that have it as that ancestor are added.
    Rounds are the logarithm of the greatest depth; sums combine before the shuffle.
    """
    state, reach = nodes.select("depth", "conv", F.col("parent").alias("up"), *values), 1
    state = stage(state, "sums")
    while True:
        climbing = state.where("up IS NOT NULL")
        if climbing.isEmpty():
            return state.drop("up")
        added = climbing.groupBy((F.col("depth") - reach).alias("depth"), F.col("up").alias("conv")).agg(*[F.sum(v).alias(f"{v}_more") for v in values])
        above = state.select((F.col("depth") + reach).alias("depth"), F.col("conv").alias("up"), F.col("up").alias("upper"))
        risen = climbing.join(above, ["depth", "up"]).drop("up").withColumnRenamed("upper", "up")
        state = risen.unionByName(state.where("up IS NULL")).join(added, ["depth", "conv"], "left")
        state = state.select("depth", "conv", "up", *[(F.col(v) + F.coalesce(f"{v}_more", F.lit(0))).alias(v) for v in values])
        state, reach = stage(state, "sums"), 2 * reach


def prefix_trie(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = 4, every: int = 20, modulus: int = 4
) -> DataFrame:
    """All distinct beginnings of conversations, with what sharing them saves.

    A conversation is its turns in order, null first, ties by content; null role or text is
    empty. It is rebuilt first: its first h turns are those of conversation c - c % ``every`` (all
    if that has fewer, none if it does not exist), where h is the CRC-32 of the decimal c modulo
    ``modulus``. Each distinct sequence of the first d rebuilt turns is a node of depth d, from the
    root without turns; rebuilt conversations that begin with it are its members.

    Blocks of ``block`` turns are grouped by digests, then refined where siblings diverge. Nodes of
    a single member follow one another to its end and need no more than that; the subtree sums of
    shared nodes take rounds logarithmic in the depth. Groups are combined before each shuffle,
    and joins meet one row per group, not per member. One conversation's turns are sorted in one
    task, which spills. Equality is that of SHA-256 digests of turns and of 120 bits for sequences.

    Returns one row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children in its subtree),
    ``saved_tokens`` (over its subtree, each node's (n_convs - 1) times the words of its last
    turn), ``ends_sha256`` (of the ascending, comma-joined numbers of members that end there).
    Turns without a conversation number belong to none and are left out; repeated turns count
    each; without any conversation there is no node. Other columns are ignored.
    """
    flat = stage(ordered_turns(turns, conv, turn, role, text), "turns")
    convs, rebuilt = grafted(flat, every, modulus)
    convs = stage(convs, "conversations")
    total, lowest = convs.agg(F.count("*"), F.min("conv")).first()
    held = stage(blocks(rebuilt, block), "blocks")
    prefix = ["b", "g0", "g1"]

    # One row per distinct beginning at a block's end; its smallest member stands for it.
    groups = held.groupBy("b", "g0", "g1", "p0", "p1").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.max("last").alias("last"), F.max(F.size("turns")).alias("size")
    )
    groups = stage(groups, "groups")
    # All first blocks follow the root: they need no join.
    begins = groups.where("b = 0")
    kinds = begins.count()
    begins = begins.withColumns({"siblings": F.lit(kinds).cast("long"), "up": F.lit(lowest).cast("long"), "up_n": F.lit(total).cast("long")})
    later = groups.where("b > 0")
    siblings = later.groupBy(*prefix).agg(F.count("*").alias("siblings"))
    before = groups.where(F.col("size") == block).select((F.col("b") + 1).alias("b"), F.col("p0").alias("g0"), F.col("p1").alias("g1"), F.col("conv").alias("up"), F.col("n").alias("up_n"))
    later = later.join(siblings, prefix).join(before, prefix)
    seen = held.select("conv", "b", "turns")
    grown = stage(begins.unionByName(later).join(seen, ["conv", "b"]), "grown")

    # No siblings: all turns of the block have the same members.
    each = grown.where("siblings = 1").select("*", F.posexplode("turns").alias("j", "t"))
    first = F.col("j") == 0
    depth = (F.col("b") * block + F.col("j") + 1).alias("depth")
    more = ((F.col("j") + 1 < F.col("size")) | ~F.col("last")).alias("more")
    plain = each.select(
        depth, "conv", F.when(first, F.col("up")).otherwise(F.col("conv")).alias("parent"),
        F.when(first, F.col("up_n")).otherwise(F.col("n")).alias("parent_n"), "n", F.col("t.words").alias("words"), more,
    )

    # Siblings: their turns are grouped by the digest of the block up to each of them.
    digests = F.transform("turns", lambda t: F.hex(t["digest"]))
    upto = F.transform(digests, lambda _, j: F.unhex(F.sha2(F.concat_ws("", F.slice(digests, 1, j + 1)).cast("binary"), 256)))
    apart = grown.where("siblings > 1").withColumn("upto", upto).select("*", F.posexplode("turns").alias("j", "t"))
    apart = apart.select(
        *prefix, "j", F.element_at("upto", F.col("j") + 1).alias("q"), F.when(F.col("j") > 0, F.element_at("upto", F.greatest(F.col("j"), F.lit(1)))).alias("q_up"),
        "p0", "p1", "conv", "n", "up", "up_n", F.col("t.words").alias("words"), more, ((F.col("j") + 1 == F.col("size")) & F.col("last")).alias("ends"),
    )
    apart = stage(apart, "apart")
    node = [*prefix, "j", "q"]
    refined = apart.groupBy(*node).agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.min("q_up").alias("q_up"), F.min("up").alias("up"), F.min("up_n").alias("up_n"),
        F.min("words").alias("words"), F.max("more").alias("more"),
    )
    refined = stage(refined, "refined")
    parents = refined.select(*prefix, (F.col("j") + 1).alias("j"), F.col("q").alias("q_up"), F.col("conv").alias("in_conv"), F.col("n").alias("in_n"))
    tops = refined.where("j = 0").select(depth, "conv", F.col("up").alias("parent"), F.col("up_n").alias("parent_n"), "n", "words", "more")
    inner = refined.where("j > 0").join(parents, [*prefix, "j", "q_up"])
    inner = inner.select(depth, "conv", F.col("in_conv").alias("parent"), F.col("in_n").alias("parent_n"), "n", "words", "more")
    nodes = stage(reduce(DataFrame.unionByName, (plain, tops, inner)), "nodes")

    # Where conversations end, by the digest of all their turns; those without turns end at the root.
    end = F.concat_ws(":", "b", "p0", "p1").alias("end")
    ended = held.where("last").select(end, "conv")
    empty = convs.join(held.select("conv").distinct(), "conv", "left_anti").select(F.lit("").alias("end"), "conv")
    lists = stage(digests_of_lists(ended.unionByName(empty)), "ends")
    at_plain = grown.where("siblings = 1 AND last").select(end, (F.col("b") * block + F.col("size")).alias("depth"), "conv")
    at_apart = apart.where("ends").select(*node, end).join(refined.select(*node, "conv"), node).select("end", depth, "conv")
    at_root = convs.sparkSession.range(1 if total else 0).select(F.lit("").alias("end"), F.lit(0).alias("depth"), F.lit(lowest).cast("long").alias("conv"))
    places = reduce(DataFrame.unionByName, (at_plain, at_apart, at_root))
    ends = stage(places.join(lists, "end").select("depth", "conv", "ends_sha256"), "end-places")

    # A node of one member is followed by its own nodes only, down to the conversation's end.
    root = convs.sparkSession.range(1 if total else 0).select(
        F.lit(0).alias("depth"), F.lit(lowest).cast("long").alias("conv"), F.lit(None).cast("long").alias("parent"), F.lit(total).cast("long").alias("n"), F.lit(0).cast("long").alias("words")
    )
    shared = nodes.where("n > 1").select("depth", "conv", "parent", "n", "words").unionByName(root)
    below = nodes.where("n > 1 OR parent_n > 1 OR depth = 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv")).agg(
        F.count("*").alias("n_children"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("lone")
    )
    shared = shared.join(below, ["depth", "conv"], "left").fillna(0, ["n_children", "lone"])
    own_leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    shared = shared.withColumns({"n_leaves": (F.col("lone") + own_leaf).cast("long"), "saved_tokens": (F.col("n") - 1) * F.col("words")})
    shared = stage(shared, "shared")
    sums = subtree_sums(shared, ["n_leaves", "saved_tokens"])
    known = shared.drop("n_leaves", "saved_tokens").join(sums, ["depth", "conv"]).join(ends, ["depth", "conv"], "left")
    known = known.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    alone = nodes.where("n = 1").select(
        "depth", "conv", "parent", "n", F.col("more").cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("more"), F.lit(NOTHING)).otherwise(F.sha2(F.col("conv").cast("string").cast("binary"), 256)).alias("ends_sha256"),
    )
    return known.select(alone.columns).unionByName(alone).select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256",
    )
