"""The trie of conversation beginnings, rolled up in bands of depth.

A node is a beginning that conversations share: the turns up to some depth. Its key
is the exclusive or of hashes of (place, role, text), so that beginnings are running
sums and the node above is one turn's hash away. Depths are cut into bands of fixed
height. Values reach the nodes above within their band at once, each node being
exploded to no more than one band of them. What arrives at the roots of bands is a
smaller trie, with one node where there was a band, and is rolled up the same way;
the completed totals of band roots then go to their own band. Rounds grow with the
logarithm of the longest conversation, rows with the height of a band.

No group is a conversation, a node or its members: conversations are numbered and
summed in chunks, members are joined in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.llm.common import staged

#: Depths of a band: the most nodes that one is exploded to, and one more.
BAND = 16
#: Turns of a conversation that are summed in one group; a multiple of BAND.
CHUNK = 4096
#: Members whose ids are joined in one group are 2 to this at most.
BLOCK_BITS = 12
#: Rows that a task can hold in order have numbers up to this.
ROW_BITS = 33


def _numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows with ``part_`` and ``at_``, their place in the order of all rows.

    The rows are dealt out in ranges of the order, so equal first keys may lie in
    many tasks. The result is a stored table.
    """
    source = rows.withColumn("row_", F.monotonically_increasing_id())  # splits equal rows too
    keys = [*order, "row_"]
    dealt = source.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = dealt.withColumn("at_", F.monotonically_increasing_id()).drop("row_")
    return staged(placed.withColumn("part_", F.shiftright("at_", ROW_BITS)), name)


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, role, said, words), (conv_id, n_turns)) of a table of turns.

    Turns are numbered from 1 in the order of ``turn``, null first; turns of one
    number come by role and by the MD5 of their text, ``said``. Null roles and texts
    are empty. Rows without a conv_id belong to no conversation.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    narrow = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.md5(text).alias("said"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    held = _numbered(narrow, "turns", "conv_id", "turn", "role", "said")
    counts = staged(held.groupBy("conv_id", "part_").agg(F.min("at_").alias("begin_"), F.count("*").alias("n_")), "turn_counts")
    before = Window.partitionBy("conv_id").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "part_", "begin_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    turns = held.join(offsets, ["conv_id", "part_"]).select(
        "conv_id", (F.col("at_") - F.col("begin_") + F.col("before_") + 1).alias("place"), "role", "said", "words")
    lengths = counts.groupBy("conv_id").agg(F.sum("n_").alias("n_turns"))
    return staged(turns, "numbered"), staged(lengths, "lengths")


def with_lent_openings(turns: DataFrame, lengths: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the one at the last multiple of ``every``.

    Conversation c gives up its first h turns, h being crc32 of its number modulo
    ``most`` + 1, for the first h turns of c - c % every, of which there may be fewer
    or none.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    draw = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    lent = F.when(F.col("conv_id") == base, 0).otherwise(draw).alias("given")
    lenders = lengths.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n_turns").alias("there"))
    plan = (
        lengths.select("conv_id", "n_turns", base.alias("base"), lent).join(lenders, "base", "left")
        .withColumn("taken", F.least("given", F.coalesce("there", F.lit(0))))
    )
    own = turns.join(plan.select("conv_id", "given", "taken"), "conv_id").filter("place > given").select(
        "conv_id", (F.col("place") - F.col("given") + F.col("taken")).alias("place"), "role", "said", "words")
    openings = turns.filter((F.col("conv_id") % every == 0) & (F.col("place") <= most)).withColumnRenamed("conv_id", "base")
    borrowed = plan.filter("taken > 0").select("conv_id", "base", "taken").join(openings, "base").filter("place <= taken").select(
        "conv_id", "place", "role", "said", "words")
    left = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("n_turns") - F.col("given"), F.lit(0))).alias("n_turns"))
    return own.unionByName(borrowed), left


def _part(place: Column, size: int) -> Column:
    """Which run of ``size`` places a place, from 1, lies in."""
    return F.floor((place - 1) / size)


def _key(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _root() -> Column:
    none = F.lit(0).cast("long")
    return _key(none, none)


def _beginnings(turns: DataFrame) -> DataFrame:
    """(conv_id, place, chunk, node, up, words): the node of each turn and the one above.

    Hashes are summed within a chunk of a conversation, and chunk by chunk.
    """
    lanes = {c: F.xxhash64(F.lit(seed), "place", "role", "said") for seed, c in enumerate(("a", "b"))}
    hashed = turns.select(
        "conv_id", "place", "words", _part(F.col("place"), CHUNK).alias("chunk"), *(h.alias(c) for c, h in lanes.items()))
    sums = hashed.groupBy("conv_id", "chunk").agg(*(F.bit_xor(c).alias(c) for c in lanes))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "chunk", *(F.bit_xor(c).over(earlier).alias(f"{c}0") for c in lanes)).filter("chunk > 0")
    within = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = {c: F.bit_xor(c).over(within).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))) for c in lanes}
    placed = hashed.join(carried, ["conv_id", "chunk"], "left").select(
        "conv_id", "place", "chunk", "words", "a", "b", *(s.alias(f"{c}1") for c, s in summed.items()))
    above = _key(F.col("a1").bitwiseXOR(F.col("a")), F.col("b1").bitwiseXOR(F.col("b")))
    return placed.select("conv_id", "place", "chunk", _key(F.col("a1"), F.col("b1")).alias("node"), above.alias("up"), "words")


def _with_paths(rows: DataFrame) -> DataFrame:
    """Add ``path``: the band's root and the nodes of the band down to the row's own.

    ``rows`` have (conv_id, place, chunk, node, up); a band of a conversation is a
    group of at most BAND rows.
    """
    band = _part(F.col("place"), BAND)
    down = Window.partitionBy("conv_id", "chunk", band).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("path", F.concat(F.array(F.first("up").over(down)), F.collect_list("node").over(down)))


def _band_ends(rows: DataFrame) -> DataFrame:
    """The rows at the last depth of a band, as rows of the trie of band roots."""
    ends = _with_paths(rows).filter(F.col("place") % BAND == 0)
    place = F.floor(F.col("place") / BAND)
    return ends.select("conv_id", place.alias("place"), _part(place, CHUNK).alias("chunk"), "node", F.get("path", F.lit(0)).alias("up"))


def _spread(nodes: DataFrame, values: list[str], band_only: bool) -> DataFrame:
    """Sums of the values of all nodes below within the band, the node's own included.

    With ``band_only`` false also ``<value>_below``: what reaches a node as the root of a band.
    """
    at = nodes.select(F.posexplode("path").alias("step", "node"), *values).filter("node is not null")
    parts = [F.sum(F.when(F.col("step") > 0, F.col(v))).alias(v) for v in values]
    if not band_only:
        parts += [F.sum(F.when(F.col("step") == 0, F.col(v))).alias(f"{v}_below") for v in values]
    return at.groupBy("node").agg(*parts)


def _subtree_sums(nodes: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): sums over all nodes below and the node itself.

    ``nodes`` (node, depth, path, values) is stored; the path of the root is null
    and itself. ``rows`` are those of :func:`_beginnings`, or of band ends.
    """
    parts = staged(_spread(nodes, values, False), "band_sums")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    zero = F.lit(0)
    if deepest <= BAND:  # one band, whose root is the root
        return parts.select("node", *((F.coalesce(v, zero) + F.coalesce(f"{v}_below", zero)).alias(v) for v in values))
    ends = _band_ends(rows)
    paths = _with_paths(ends).groupBy("node").agg(F.first("path").alias("path"))
    roots = nodes.filter(F.col("depth") % BAND == 0).select(
        "node", F.floor(F.col("depth") / BAND).alias("depth"), F.col("path").alias("own_path"))
    below = parts.select("node", *(F.coalesce(f"{v}_below", zero).alias(v) for v in values))
    coarse = (
        roots.join(paths, "node", "left").join(below, "node", "left")
        .withColumn("path", F.when(F.col("depth") == 0, F.col("own_path")).otherwise(F.col("path")))
        .select("node", "depth", "path", *(F.coalesce(v, zero).alias(v) for v in values))
    )
    done = _subtree_sums(staged(coarse, "band_roots"), ends, values)
    reached = _spread(done.join(nodes.select("node", "path"), "node"), values, True)
    own = parts.select("node", *(F.coalesce(v, zero).alias(v) for v in values))
    return own.unionByName(reached).groupBy("node").agg(*(F.sum(v).alias(v) for v in values))


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): hash of the ids of each node's rows, ascending, comma-joined.

    Ids are joined in blocks; the blocks of a node go through one hash in order,
    in a stream that holds one block at a time.
    """
    held = _numbered(ends, "ends", "node", "conv_id")
    block = F.shiftright("at_", BLOCK_BITS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = held.groupBy("node", block.alias("block")).agg(ids.alias("ids"))
    ordered = blocks.repartition("node").sortWithinPartitions("node", "block").select("node.a", "node.b", "ids")
    kinds = {"a": pa.int64(), "b": pa.int64(), "ends_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (a, b), sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield _batch(out, kinds)
        if now:
            yield _batch([(*now, digest.hexdigest())], kinds)

    hashed = ordered.mapInArrow(run, "a long, b long, ends_sha256 string")
    return hashed.select(_key(F.col("a"), F.col("b")).alias("node"), "ends_sha256")


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per distinct beginning of conversations, from the empty one on.

    (node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    ``turns`` (conv_id, place, role, said, words) are numbered from 1, ``lengths``
    (conv_id, n_turns) names all conversations, also those without turns. ``conv_id``
    is the smallest conversation that begins so: with ``depth`` it tells the turns.
    ``saved_tokens`` sums, over the subtree, the words of a node's last turn once for
    each conversation but one. ``ends_sha256`` hashes the ids of the conversations
    that end at the node. Equal turns at other places are other nodes; an empty
    table gives an empty table.
    """
    rows = staged(_beginnings(turns), "beginnings")
    everyone = lengths.select(
        "conv_id", F.lit(0).cast("long").alias("place"), _root().alias("node"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("up"), F.lit(0).cast("long").alias("words"))
    at_root = everyone.withColumn("path", F.array("up", "node"))
    members = _with_paths(rows).drop("chunk").unionByName(at_root)
    found = members.groupBy("node", F.col("place").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.first("up").alias("up"), F.first("path").alias("path"))
    nodes = staged(found, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    valued = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = staged(valued.select(
        "*", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "valued_nodes")
    sums = _subtree_sums(nodes, rows, ["n_leaves", "saved_tokens"])
    last = rows.select("conv_id", "place", "node").join(
        lengths.select("conv_id", F.col("n_turns").alias("place")), ["conv_id", "place"], "left_semi").select("node", "conv_id")
    ends = last.unionByName(lengths.filter("n_turns = 0").select(_root().alias("node"), "conv_id"))
    top = nodes.filter("depth = 0").select("conv_id").first()
    # The root is above very many nodes, and known: its children need no join.
    parents = nodes.filter("depth > 0 and n_children > 0").select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    above = F.when(F.col("depth") == 1, F.lit(top[0] if top else None)).cast("long")
    named = nodes.filter("depth <= 1").withColumn("parent_conv_id", above).unionByName(nodes.filter("depth > 1").join(parents, "up"))
    return (
        named.drop("n_leaves", "saved_tokens").join(sums, "node").join(_ends_sha256(ends), "node", "left")
        .select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
    )
