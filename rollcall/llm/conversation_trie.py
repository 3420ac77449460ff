"""The prefix trie of conversations: what many of them share at their start.

Conversations are cut into segments of a fixed number of turns, equal segments
after equal starts are folded to one with a count, and the segments are dealt
to shards by their first turns: by one turn, or by as many as it takes until
no shard is large. Every shard numbers its turns densely, packs a double-array
trie and walks all its conversations through it at once. Nodes above the
shards are merged from the shards' totals, and a later segment's total counts
at the node its segment hangs from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.double_array import DoubleArray, step
from rollcall.llm.support import Scratch, by_value, joined_small, table
from rollcall.operators.ranking import grouped_row_number

by_value(__name__)

# Turns of a segment; a conversation of any length is a chain of such rows.
SEGMENT = 1024
# Turns (after folding) a shard may hold before it is divided by a further turn, and turns of a task.
SHARD_TURNS = 20_000
# Turns whose digests make a key are 16 bytes of SHA-256 each.
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, ups array<binary>, up_chars array<bigint>"
)
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t (a digest of role and text), chars (code points of the text).

    Turns are ordered by ``turn``, NULL first, then by role and by digest; rows that repeat stay.
    NULL role or text is empty. Rows without conv_id belong to no conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    bare = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), digest.alias("t"), F.length(text).cast("bigint").alias("chars")
    )
    return grouped_row_number(bare, "conv_id", "turn", "role", "t", name="pos").select("conv_id", "pos", "t", "chars")


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their hundred.

    Rows (c, d, t, chars) of all rebuilt turns, d from 1, and (c, len) of all conversations.
    """
    own = scratch.save(turns(conversations), "turns")
    given = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    first = F.sort_array(F.collect_list(F.struct("pos", "t", "chars")))
    heads = own.where("conv_id % 100 = 0 AND pos <= 5").groupBy(F.col("conv_id").alias("base")).agg(first.alias("first"))
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", given)
    convs = convs.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left")
    lead = F.expr("coalesce(slice(first, 1, h), CAST(array() AS ARRAY<STRUCT<pos: BIGINT, t: BINARY, chars: BIGINT>>))")
    convs = convs.select("conv_id", "h", lead.alias("lead"), "n")
    convs = scratch.save(convs.withColumn("p", F.size("lead").cast("bigint")), "convs")
    tail = own.join(convs.select("conv_id", "h", "p"), "conv_id").where("pos > h")
    rows = tail.select(F.col("conv_id").alias("c"), F.expr("p + pos - h AS d"), "t", "chars").union(
        convs.select("conv_id", F.inline("lead").alias("d", "t", "chars"))
    )
    return rows, convs.select(F.col("conv_id").alias("c"), F.expr("p + greatest(n - h, 0) AS len"))


def key_of(start: str, seq: str) -> str:
    """SQL of the key of a node: its path's digests hashed together, segment by segment."""
    return f"unhex(sha2(concat(hex({start}), array_join(transform({seq}, x -> hex(x.t)), '')), 256))"


def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's conv_ids, comma-joined, from rows sorted by (key, c); one hash is open at a time."""
    key, digest = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        keys, ids = batch.column(0).to_pylist(), np.asarray(batch.column(1))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            fresh = keys[a] != key
            if fresh:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = keys[a], hashlib.sha256()
            digest.update((b"" if fresh else b",") + b",".join(b"%d" % i for i in ids[a:b].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends"])


def numbered_turns(shard: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense ids of all turns of a shard's rows, the place of each row's first turn, and the number of ids."""
    sizes = shard.column("size").to_numpy()
    flat = np.frombuffer(b"".join(shard.column("path").to_pylist()), dtype="S16")
    known, ids = np.unique(flat, return_inverse=True)
    return ids, np.concatenate([[0], np.cumsum(sizes)])[:-1], len(known)


def shard_nodes(shard: pa.Table) -> pa.Table:
    """All nodes at and below the shard's top nodes, with the totals of their subtrees."""
    ids, at, known = numbered_turns(shard)
    cut, sizes = shard.column("cut").to_numpy(), shard.column("size").to_numpy()
    # The top node stands for the turns before it too, so its symbol is that of its key.
    _, top = np.unique(np.array(shard.column("top").to_pylist(), dtype="S32"), return_inverse=True)
    levels = sizes - cut + 1
    trie = DoubleArray(known + int(top.max()) + 1)

    def symbols(level: int, rows: np.ndarray) -> np.ndarray:
        return known + top[rows] if level == 0 else ids[at[rows] + cut[rows] - 1 + level]

    states = np.zeros(len(sizes), dtype=np.int64)
    for level in range(int(levels.max())):
        rows = np.flatnonzero(levels > level)
        states[rows] = trie.extend(states[rows], symbols(level, rows))
    base, check = trie.packed()

    slots = len(base)
    n_convs, conv = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    parent, depth, chars, source = (np.full(slots, -1, np.int64) for _ in range(4))
    weight, first_id = shard.column("n").to_numpy(), shard.column("c").to_numpy()
    lengths, above = shard.column("chars").combine_chunks().flatten().to_numpy(), shard.column("above").to_numpy()
    found, rows, states = [], np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
    ended = np.zeros(len(sizes), np.int64)
    for level in range(int(levels.max())):
        on = levels[rows] > level
        rows, before = rows[on], states[on]
        live, states = step(base, check, trie.width, before, symbols(level, rows))
        if len(live) != len(rows):
            raise AssertionError("a packed conversation left the trie")
        np.add.at(n_convs, states, weight[rows])
        np.minimum.at(conv, states, first_id[rows])
        parent[states] = before if level else -1
        depth[states] = above[rows] + cut[rows] + level
        chars[states] = lengths[at[rows] + cut[rows] - 1 + level]
        source[states] = rows
        ended[rows] = states
        found.append(np.unique(states))
    children, leaves, saved = (np.zeros(slots, np.int64) for _ in range(3))
    # One row ends at a node at most, since equal ones are folded.
    for name, into in (("b_children", children), ("b_leaves", leaves), ("b_saved", saved)):
        into[ended] += shard.column(name).to_numpy()
    ends = dict(zip(ended.tolist(), shard.column("ends").to_pylist(), strict=True))
    for level in reversed(range(len(found))):
        here = found[level]
        leaves[here] = np.where(children[here] == 0, 1, leaves[here])
        saved[here] += (n_convs[here] - 1) * chars[here]
        if level:
            for into, what in ((children, 1), (leaves, leaves[here]), (saved, saved[here])):
                np.add.at(into, parent[here], what)
    nodes = np.concatenate(found)
    tops = np.arange(len(nodes)) < len(found[0])
    which, rest = pa.array(source[found[0]]), len(nodes) - len(found[0])

    def of_tops(column: pa.ChunkedArray) -> pa.Array:
        return pa.concat_arrays([column.take(which).combine_chunks(), pa.nulls(rest, column.type)])

    return pa.table(
        {
            "conv_id": conv[nodes],
            "depth": depth[nodes],
            "parent_conv_id": pa.array(np.where(tops, 0, conv[parent[nodes]]), mask=tops),
            "n_convs": n_convs[nodes],
            "n_children": children[nodes],
            "n_leaves": leaves[nodes],
            "saved_tokens": saved[nodes],
            "ends_sha256": pa.array([ends.get(i) or NOBODY for i in nodes.tolist()], pa.string()),
            "ups": of_tops(shard.column("ups")),
            "up_chars": of_tops(shard.column("up_chars")),
        }
    )


def with_cuts(folded: DataFrame, scratch: Scratch, shard_turns: int) -> DataFrame:
    """``folded`` with ``cut``: the depth of its shard's top node, or size + 1 where it ends above all shards.

    A prefix whose folded rows hold more than ``shard_turns`` turns is divided by
    a further turn, until none does or one row is left; a row that ends there
    stays above, over the others that go on.
    """
    done, open_rows, k = [], folded, 1
    while True:
        keyed = open_rows.withColumn("pk", F.when(F.col("size") >= k, F.expr(key_of("start", f"slice(seq, 1, {k})"))))
        heavy = keyed.where("pk IS NOT NULL").groupBy("pk").agg(F.sum("size").alias("w"), F.count("*").alias("rows"))
        heavy = heavy.where((F.col("w") > shard_turns) & (F.col("rows") > 1))
        heavy = scratch.save(heavy.select("pk", F.lit(True).alias("heavy")), "heavy")
        if not heavy.limit(1).count():
            done.append(open_rows.withColumn("cut", F.least(F.lit(k), F.col("size") + 1)))
            break
        split = scratch.save(joined_small(keyed, heavy, "pk", "left").drop("pk"), "split")
        done.append(split.where("heavy IS NULL").drop("heavy").withColumn("cut", F.least(F.lit(k), F.col("size") + 1)))
        open_rows = split.where("heavy").drop("heavy")
        k += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def upper_nodes(parts: DataFrame, level_depth: int) -> DataFrame:
    """Nodes above the shards from what hangs below them.

    ``parts`` has one row per shard top and per folded row that ends above all
    shards: ups (keys from the segment's start), up_chars, n_convs, conv_id, n_leaves,
    saved, b_children, is_top, ends.
    """
    last = F.col("i") == F.size("ups") - 1
    exploded = parts.select("*", F.posexplode("ups").alias("i", "key"))
    own = exploded.groupBy("key").agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.sum(F.when(last, F.when(F.col("is_top"), 1).otherwise(F.col("b_children"))).otherwise(0)).alias("below"),
        F.max(F.when(last & ~F.col("is_top"), F.col("ends"))).alias("ends"),
        F.first(F.struct("i", F.expr("slice(ups, 1, i + 1)").alias("chain"), F.expr("up_chars[i]").alias("chars"))).alias("at"),
    )
    own = own.select("*", "at.*").withColumn("up", F.expr("CASE WHEN i > 0 THEN chain[i - 1] END"))
    spare = own.where("i > 0").select(F.explode("chain").alias("key"), F.expr("(n_convs - 1) * chars AS s"))
    spare = spare.groupBy("key").agg(F.sum("s").alias("s"))
    inner = own.where("i > 0").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("k"))
    out = own.join(spare, "key", "left").join(inner, "key", "left")
    children = F.col("below") + F.coalesce("k", F.lit(0))
    return out.select(
        "key",
        "up",
        "conv_id",
        (F.col("i") + level_depth).cast("bigint").alias("depth"),
        "n_convs",
        children.alias("n_children"),
        F.when(children == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )


def trie_nodes(
    rows: DataFrame, convs: DataFrame, scratch: Scratch, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per trie node of conversations given by turns (c, d, t, chars) and lengths (c, len).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    cells = rows.groupBy("c", F.expr(f"CAST((d - 1) DIV {segment} AS INT)").alias("j")).agg(
        F.expr("transform(sort_array(collect_list(struct(d, t, chars))), x -> struct(x.t AS t, x.chars AS chars))").alias("seq")
    )
    cells = scratch.save(cells, "segments")
    last = F.expr(f"CAST(greatest(len - 1, 0) DIV {segment} AS INT)")
    none = F.expr("CAST(array() AS ARRAY<STRUCT<t: BINARY, chars: BIGINT>>)")
    cells = cells.unionByName(convs.where("len = 0").select("c", F.lit(0).alias("j"), none.alias("seq")))
    cells = cells.join(convs.select("c", last.alias("last")), "c")
    deepest = convs.agg(F.max(last)).first()[0] or 0

    # Fold the segments from the first on: the key of a segment is the start of the next one.
    levels: list[DataFrame] = []
    start = None
    for j in range(deepest + 1):
        here = cells.where(F.col("j") == j)
        here = here.withColumn("start", F.unhex(F.lit(""))) if start is None else here.join(start, "c")
        here = scratch.save(here.withColumn("key", F.expr(key_of("start", "seq"))), "level")
        start = here.where("last > j").select("c", F.col("key").alias("start"))
        joined = here.where("last = j").select("key", "c").repartition("key").sortWithinPartitions("key", "c")
        ends = joined.mapInArrow(join_ids, "key binary, ends string")
        folded = here.groupBy("key").agg(
            F.min("c").alias("c"), F.count("*").alias("n"), F.first("start").alias("start"), F.first("seq").alias("seq")
        )
        levels.append(scratch.save(folded.join(ends, "key", "left").withColumn("size", F.size("seq")), "folded"))

    found, below = [], None
    for j in reversed(range(deepest + 1)):
        folded = levels[j]
        zero = [F.lit(0).cast("bigint").alias(c) for c in ("b_children", "b_leaves", "b_saved")]
        if below is None:
            folded = folded.select("*", *zero)
        else:
            filled = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("b_children", "b_leaves", "b_saved")]
            folded = folded.join(below, "key", "left").select(*levels[j].columns, *filled)
        cut = scratch.save(with_cuts(folded, scratch, shard_turns), "cut")
        chain = f"transform(sequence(0, cut - 1), i -> CASE WHEN i = 0 THEN start ELSE {key_of('start', 'slice(seq, 1, i)')} END)"
        chars = "transform(sequence(0, cut - 1), i -> CASE WHEN i = 0 THEN 0L ELSE seq[i - 1].chars END)"
        cut = cut.withColumns({"ups": F.expr(chain), "up_chars": F.expr(chars)})
        total = cut.agg(F.sum("size")).first()[0] or 0
        shards = cut.where("size >= cut").select(
            F.expr(f"pmod(xxhash64({key_of('start', 'slice(seq, 1, cut)')}), {-(-total // shard_turns) or 1})").alias("shard"),
            F.expr(f"{key_of('start', 'slice(seq, 1, cut)')} AS top"),
            F.expr("unhex(array_join(transform(seq, x -> hex(x.t)), '')) AS path"),
            F.expr("transform(seq, x -> x.chars) AS chars"),
            F.lit(j * segment).cast("bigint").alias("above"),
            *("cut", "size", "c", "n", "ends", "b_children", "b_leaves", "b_saved", "ups", "up_chars"),
        )
        nodes = scratch.save(shards.groupBy("shard").applyInArrow(shard_nodes, NODE), "nodes")
        parts = nodes.where("ups IS NOT NULL").selectExpr(
            *("ups", "up_chars", "n_convs", "conv_id", "n_leaves", "saved_tokens AS saved", "0L AS b_children", "true AS is_top", "'' AS ends")
        )
        above = cut.where("size < cut").selectExpr(
            *("ups", "up_chars", "n AS n_convs", "c AS conv_id", "b_leaves AS n_leaves", "b_saved AS saved", "b_children", "false AS is_top", "ends")
        )
        uppers = scratch.save(upper_nodes(parts.unionByName(above), j * segment), "uppers")
        names = uppers.select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
        if j:
            # The node a segment hangs from is one of the segment before, where conversations may also end.
            names = names.join(levels[j - 1].select(F.col("key").alias("up"), "c"), "up", "left").select("up", F.coalesce("c", "parent").alias("parent"))
        tops = joined_small(nodes.where("ups IS NOT NULL").withColumn("up", F.element_at("ups", -1)), names, "up", "inner")
        cols = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
        found.append(nodes.where("ups IS NULL").select("conv_id", "depth", "parent_conv_id", *cols))
        found.append(tops.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), *cols))
        shown = uppers.join(names, "up", "left") if j == 0 else uppers.where(F.col("up").isNotNull()).join(names, "up", "left")
        found.append(shown.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), *cols))
        below = uppers.where(F.col("up").isNull()).select(
            "key", F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"), F.col("saved_tokens").alias("b_saved")
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text) as it stands, one row per node.

    Rows without conv_id are left out; equal rows are turns of their own; columns
    besides the four are not looked at. A table without conversations has no nodes.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    own = scratch.save(turns(conversations), "turns")
    rows = own.select(F.col("conv_id").alias("c"), F.col("pos").alias("d"), "t", "chars")
    convs = scratch.save(own.groupBy(F.col("conv_id").alias("c")).agg(F.max("pos").alias("len")), "convs")
    return trie_nodes(rows, convs, scratch, segment, shard_turns)


def rebuilt_trie(conversations: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of rebuilt conversations, which may be turnless and then end at the root."""
    scratch = Scratch(conversations.sparkSession, "trie")
    rows, convs = rebuilt(conversations, scratch)
    return trie_nodes(rows, convs, scratch, segment, shard_turns)


def op12_prefix_trie(spark: SparkSession, directory: str) -> DataFrame:
    return rebuilt_trie(table(spark, directory, "conversations"))


SQL = """
WITH o AS (
  SELECT conv_id AS c, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS t, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT c, list(t ORDER BY p) AS own FROM o GROUP BY c
), k AS (
  SELECT c, own, xor(list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 6 AS h FROM l
), s AS (
  SELECT k.c, list_concat(coalesce(list_slice(b.own, 1, k.h), []), list_slice(k.own, k.h + 1, len(k.own))) AS seq
  FROM k LEFT JOIN l AS b ON b.c = k.c - k.c % 100
), m AS (
  SELECT c, len(seq) AS size, list_slice(seq, 1, d) AS node, d FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM s)
), g AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d) AS ends
  FROM m GROUP BY node, d
), n AS (
  SELECT g.*, list_slice(node, 1, d - 1) AS up, (SELECT count(*) FROM g AS f WHERE f.d = g.d + 1 AND list_slice(f.node, 1, g.d) = g.node) AS n_children
  FROM g
), t AS (
  SELECT list_slice(node, 1, a) AS node, a AS d, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves,
    sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(node[d].x) END) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM n) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN t ON t.d = n.d AND t.node = n.node LEFT JOIN g AS u ON n.d > 0 AND u.d = n.d - 1 AND u.node = n.up
"""
