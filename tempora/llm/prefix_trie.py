"""Conversation prefix trie (operator 11): totals of every subtree by parallel tree contraction.

Conversations are rebuilt from a shared head (``rebuilt``), every distinct sequence of first turns
is a node, and subtree totals come from rounds of *rake* (a leaf's total is added to its parent and
the leaf leaves the tree) and *compress* (unary nodes are taken into a unary node above them; in
even rounds stretches of one conversation's path, in odd rounds pairs drawn by a coin, so any
chain shrinks by a constant share). ``expand`` goes back through the rounds: the total of a node taken
away is what it had gathered plus the total of the node it then led to.

A prefix is named by a polynomial in its turns' SHA-256 digests modulo the prime 2^127 - 1. Names of
stretches combine, so a conversation may be spread over many tasks: the turns are range-sorted,
each sorted part is named by itself, and one row per part carries the names across. The head of
another conversation is put before a stretch by arithmetic on names; no text is shuffled twice.
Two of n different prefixes share a name with probability below n^2 / 2^126.

A node's key is its smallest member and its depth, two integers, so every join of the contraction
has a unique key on both sides; sums to a parent are combined before the shuffle. The digest of a
node's ends takes ids in order: range-sorted parts make one string per node and part, and only those
strings meet in one task, which reads them one after another.

Defined cases: null role or text is empty; a null turn comes first, rows of equal turn are ordered by
role and text; repeated rows are turns of their own; rows with a null conv_id are left out, as they
belong to no conversation; an empty table gives no rows; turns are taken whole, however long; only
``conv_id``, ``turn``, ``role`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from functools import partial, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import stored

PRIME = (1 << 127) - 1
#: The point at which the polynomial of a prefix is taken: the digest of a fixed text.
POINT = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
#: Groups of conversations that share a head, and the bound of its turns.
GROUP, HEAD = 5, 9
#: Nodes that a round of path compression takes together at most, to the power of the round.
REACH = 16
#: Characters of listed ids in a row.
LIST_CHARS = 32_000

TURNS = "part int, conv_id long, pos long, name binary, n_bytes long"
ID = ["conv_id", "depth"]
LISTS = [("depth", pa.int64()), ("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]


def _number(name: bytes) -> int:
    return int.from_bytes(name, "big")


def _name(value: int) -> bytes:
    return (value % PRIME).to_bytes(16, "big")


def _named(batches):
    """Rows of one sorted part: the place in, and the name of, the conversation's stretch in this part."""
    part, conv, pos, value = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        out = []
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if conv_id != conv:
                conv, pos, value = conv_id, 0, 0
            role, text = role.encode(), text.encode()
            turn = _number(hashlib.sha256(b"%d:" % len(role) + role + text).digest()[:15]) + 1
            pos, value = pos + 1, (value * POINT + turn) % PRIME
            out.append((part, conv_id, pos, _name(value), len(text)))
        yield _batch(out, [("part", pa.int32()), ("conv_id", pa.int64()), ("pos", pa.int64()), ("name", pa.binary()),
                           ("n_bytes", pa.int64())])


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    schema = pa.schema(fields)
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _carried(batches, carry: dict[int, tuple[int, int, int]]):
    """Add to each part's first stretch what the same conversation has in earlier parts."""
    for batch in batches:
        out = []
        for part, conv_id, pos, name, n_bytes in zip(*(c.to_pylist() for c in batch.columns)):
            conv, turns, value = carry.get(part, (None, 0, 0))
            if conv == conv_id and turns:
                name, pos = _name(value * pow(POINT, pos, PRIME) + _number(name)), pos + turns
            out.append((conv_id, pos, name, n_bytes))
        yield _batch(out, [("conv_id", pa.int64()), ("pos", pa.int64()), ("name", pa.binary()), ("n_bytes", pa.int64())])


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), the name of the first pos turns, and the bytes of turn pos's text."""
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    keyed = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", *text)
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    # equal turns of a conversation fall into one part, so a row number spreads repeated rows
    spread = [*order, F.col("_row").asc()]
    keyed = keyed.withColumn("_row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(*spread).sortWithinPartitions(*spread).select("conv_id", "role", "text")
    rows = stored(ordered.mapInArrow(_named, TURNS), "turns")
    # one row per part: its last stretch, and whether the part is that stretch alone
    at_end = F.max_by(F.struct("conv_id", "pos", "name"), F.struct("conv_id", "pos"))
    ends = rows.groupBy("part").agg(at_end.alias("last"), F.min("conv_id").alias("first")).orderBy("part").collect()
    carry, conv, turns_before, value = {}, None, 0, 0
    for end in ends:
        carry[end.part] = (conv, turns_before, value)
        own = _number(end.last.name)
        if conv is not None and end.last.conv_id == conv and end.first == conv:
            value, turns_before = (value * pow(POINT, end.last.pos, PRIME) + own) % PRIME, turns_before + end.last.pos
        else:
            conv, turns_before, value = end.last.conv_id, end.last.pos, own
    return rows.mapInArrow(partial(_carried, carry=carry), "conv_id long, pos long, name binary, n_bytes long")


def _moved(batches):
    """Names of a conversation's own turns behind the head it is rebuilt with."""
    for batch in batches:
        out = []
        for conv_id, pos, name, n_bytes, h, head_turns, head, skipped in zip(*(c.to_pylist() for c in batch.columns)):
            shift = _number(head or bytes(16)) - _number(skipped or bytes(16))
            out.append((conv_id, head_turns + pos - h, _name(_number(name) + shift * pow(POINT, pos - h, PRIME)), n_bytes))
        yield _batch(out, [("conv_id", pa.int64()), ("depth", pa.int64()), ("name", pa.binary()), ("n_bytes", pa.int64())])


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The prefixes of all rebuilt conversations (conv_id, depth, name, n_bytes), and their
    lengths (conv_id, depth). Conversation c takes the first h turns of conversation c - c % 5,
    then its own after the first h; h is crc32(c) % 9."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("turns")).select("conv_id", "turns", h, base)
    heads = rows.filter(F.col("pos") < HEAD)  # at most eight of a conversation
    taken = heads.select(F.col("conv_id").alias("base"), "pos", "name", "n_bytes")
    head_rows = stored(convs.join(taken, "base").filter("pos <= h").select("conv_id", F.col("pos").alias("depth"), "name", "n_bytes"), "heads")
    head = head_rows.groupBy("conv_id").agg(F.max("depth").alias("head_turns"), F.max_by("name", "depth").alias("head"))
    skipped = convs.join(heads.select("conv_id", "pos", "name"), "conv_id").filter("pos = h").select("conv_id", F.col("name").alias("skipped"))
    facts = convs.join(head, "conv_id", "left").join(skipped, "conv_id", "left").select(
        "conv_id", "h", F.coalesce("head_turns", F.lit(0)).alias("head_turns"), "head", "skipped", "turns")
    facts = stored(facts, "facts")
    own = rows.join(facts.drop("turns"), "conv_id").filter("pos > h").select(
        "conv_id", "pos", "name", "n_bytes", "h", "head_turns", "head", "skipped")
    own = own.mapInArrow(_moved, "conv_id long, depth long, name binary, n_bytes long")
    lengths = facts.select("conv_id", (F.col("head_turns") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("depth"))
    return head_rows.union(own), lengths


def nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id (smallest member), depth, name, parent_conv_id, n_convs, n_bytes of the last text."""
    made = members.groupBy("depth", "name").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(bytes(16)).alias("name"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"))
    made = stored(made.union(root), "nodes")
    # the name of a node's parent is that of its smallest member's prefix one turn shorter
    above = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("above"))
    above = above.join(made.select("conv_id", "depth"), ID)  # unique on both sides
    parents = made.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    found = above.join(parents, ["depth", "above"]).select(*ID, "parent_conv_id")
    top = made.filter("depth = 0").first()  # one row: the root, the parent of all nodes of depth 1
    first = made.filter("depth = 1").select(*ID, F.lit(top and top.conv_id).cast("long").alias("parent_conv_id"))
    return stored(made.join(found.filter("depth > 1").union(first), ID, "left").select(
        *ID, "name", "parent_conv_id", "n_convs", "n_bytes"), "trie")


def _listed(batches):
    """Rows sorted by (node, id): the ids of a node as strings of bounded size."""
    key, ids, size, first = None, [], 0, None

    def row():
        return (*key, first, ",".join(ids))

    for batch in batches:
        out = []
        for depth, name, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, name) != key or size >= LIST_CHARS:
                if ids:
                    out.append(row())
                key, ids, size, first = (depth, name), [], 0, conv_id
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
        yield _batch(out, LISTS)
    if ids:
        yield _batch([row()], LISTS)


def _digested(batches):
    """The strings of a node in order, one after another: their SHA-256."""
    key, state = None, None
    fields = LISTS[:2] + [("ends_sha256", pa.string())]
    for batch in batches:
        out = []
        for depth, name, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, name) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, name), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _batch(out, fields)
    if key is not None:
        yield _batch([(*key, state.hexdigest())], fields)


def ends(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """depth, name and the digest of the ids of conversations that end at the node."""
    empty = lengths.filter("depth = 0").select("depth", F.lit(bytes(16)).alias("name"), "conv_id")
    at = members.join(lengths, ID).select("depth", "name", "conv_id").union(empty)
    order = ["depth", "name", "conv_id"]
    lists = at.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _listed, "depth long, name binary, first long, ids string")
    return lists.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").select(
        "depth", "name", "ids").mapInArrow(_digested, "depth long, name binary, ends_sha256 string")


def _paths(live: DataFrame, span: int) -> DataFrame:
    """Unary nodes to take away: stretches of one conversation's path within ``span`` turns of depth."""
    block = Window.partitionBy("conv_id", F.floor(F.col("depth") / span))
    down, up = block.orderBy("depth"), block.orderBy(F.col("depth").desc())
    unary = live.filter("kids = 1").select(*ID, "leaves", "saved", "child")
    me = F.struct(F.col("conv_id").alias("conv_id"), F.col("depth").alias("depth"))
    linked = unary.withColumn("below", F.lag("child").over(down) == me).withColumn("below", F.coalesce("below", F.lit(False)))
    linked = linked.withColumn("chain", F.sum(F.when(F.col("below"), 0).otherwise(1)).over(down))
    chain = Window.partitionBy("conv_id", F.floor(F.col("depth") / span), "chain")
    rest = chain.orderBy(F.col("depth").desc())
    found = linked.select(
        *ID, F.sum("leaves").over(rest).alias("leaves"), F.sum("saved").over(rest).alias("saved"),
        F.max_by("child", "depth").over(chain).alias("child"), F.min_by(me, "depth").over(chain).alias("top"),
        "below", F.row_number().over(chain.orderBy("depth")).alias("nth"))
    return found.filter("below").select(*ID, "leaves", "saved", "child", "top", (F.col("nth") == 2).alias("next"))


def _pairs(live: DataFrame, turn: int) -> DataFrame:
    """Unary nodes to take away: those whose coin is tails below a unary node whose coin is heads."""
    unary = live.filter("kids = 1")
    heads = F.pmod(F.xxhash64(*ID, F.lit(turn)), F.lit(2)) == 1
    above = unary.filter(heads).select(F.struct(*ID).alias("top"), F.col("child.conv_id").alias("conv_id"), F.col("child.depth").alias("depth"))
    return unary.filter(~heads).join(above, ID).select(*ID, "leaves", "saved", "child", "top", F.lit(True).alias("next"))


def _rake(live: DataFrame) -> DataFrame:
    """The inner nodes after their leaves have gone: sums, inner children, and the child of unary nodes."""
    leaf = F.col("kids") == 0
    up = live.filter("parent IS NOT NULL").groupBy("parent").agg(
        F.sum(F.when(leaf, F.col("leaves")).otherwise(0)).alias("add_leaves"),
        F.sum(F.when(leaf, F.col("saved")).otherwise(0)).alias("add_saved"),
        F.count(F.when(~leaf, 1)).alias("inner"), F.min(F.when(~leaf, F.struct(*ID))).alias("only"))
    up = up.select(F.col("parent.conv_id").alias("conv_id"), F.col("parent.depth").alias("depth"), "add_leaves", "add_saved", "inner", "only")
    return live.filter(~leaf).join(up, ID).select(
        *ID, "parent", (F.col("leaves") + F.col("add_leaves")).alias("leaves"),
        (F.col("saved") + F.col("add_saved")).alias("saved"), F.col("inner").alias("kids"), F.col("only").alias("child"))


def _compress(live: DataFrame, taken: DataFrame) -> DataFrame:
    """The tree without the nodes of ``taken``: the node above has their sums, the node below a new parent."""
    def at(c: str) -> list[Column]:
        return [F.col(f"{c}.conv_id").alias("conv_id"), F.col(f"{c}.depth").alias("depth")]

    first = taken.filter("next")
    above = first.select(*at("top"), F.col("leaves").alias("add_leaves"), F.col("saved").alias("add_saved"), F.col("child").alias("on"))
    below = first.select(*at("child"), F.col("top").alias("over"))
    return live.join(taken.select(*ID), ID, "left_anti").join(above, ID, "left").join(below, ID, "left").select(
        *ID, F.coalesce("over", "parent").alias("parent"), (F.col("leaves") + F.coalesce("add_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("add_saved", F.lit(0))).alias("saved"), "kids", F.coalesce("on", "child").alias("child"))


def contract(live: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rake and compress until nothing is left: per round the raked leaves with their totals,
    and the nodes taken away with what they had gathered and the node they led to.
    ``live`` has conv_id, depth, parent (a struct, null at the root), leaves, saved and kids."""
    raked, taken, turn = [], [], 0
    while True:
        raked.append(live.filter("kids = 0").select(*ID, "leaves", "saved"))
        inner = stored(_rake(live), "raked")
        if inner.isEmpty():
            return raked, taken
        gone = _pairs(inner, turn) if turn % 2 else _paths(inner, REACH ** (turn // 2 + 1))
        taken.append(stored(gone, "taken"))
        live, turn = stored(_compress(inner, taken[-1]), "live"), turn + 1


def expand(raked: list[DataFrame], taken: list[DataFrame]) -> DataFrame:
    """Totals (conv_id, depth, leaves, saved) of all nodes, from the last round back to the first.
    What a node of round r led to left in round r or later, so only later tables are joined."""
    known = [raked[-1]]
    for gone, leaves in zip(reversed(taken), reversed(raked[:-1])):
        later = reduce(DataFrame.union, known).select(
            F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        total = gone.join(later, (F.col("child.conv_id") == F.col("c")) & (F.col("child.depth") == F.col("d"))).select(
            *ID, (F.col("leaves") + F.col("more_leaves")).alias("leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"))
        known = [*known, stored(total, "expanded"), leaves]
    return reduce(DataFrame.union, known)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    members, lengths = rebuilt(stored(prefixes(turns), "prefixes"))
    members = stored(members, "members")
    trie = nodes(members, lengths)
    kids = trie.filter("parent_conv_id IS NOT NULL").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    trie = stored(trie.join(kids, ID, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "kids")
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    parent = F.when(F.col("parent_conv_id").isNotNull(),
                    F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    live = trie.select(*ID, parent.alias("parent"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                       saved.alias("saved"), F.col("n_children").alias("kids"))
    totals = expand(*contract(live))
    empty = hashlib.sha256(b"").hexdigest()
    return trie.join(totals, ID).join(ends(members, lengths), ["depth", "name"], "left").select(
        *ID, "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
