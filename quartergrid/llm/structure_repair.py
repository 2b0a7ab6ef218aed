"""Cheapest repair of the turn order of conversations, with the edits that make it.

A conversation should read as an optional system turn and then user and assistant
turns by turns. Rows are kept, given another role, deleted or inserted at a price.
A dynamic programme over the rows holds the best edits for each of the four ways a
legal beginning can end. Edits are not held as strings: each is a node below the
edits before it, with its ancestors 1, 2, 4, ... nodes above and a rolling hash, so
beginnings are shared and equal costs are told apart by the longest common prefix
in a logarithmic number of steps. What all best edits have in common is settled and
let go.

Two streams do the work, each sorted by conversation: a narrow one, a few bytes a
row, finds the edits; the texts follow their edits through the other and are
hashed on the way. Neither holds a conversation: its edits are one cell of the
result, and the hash of its text can only be made in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.llm.common import sliced

DELETE, INSERT, KEEP, REROLE = "DIKR"
#: Price of each edit, and of a truncated row that is not deleted.
COSTS = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
#: How a legal beginning can end: with nothing, the system, a user or an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: End reached by a user or assistant turn from each end.
TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: End reached by a kept row with the initial.
KEPT = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
GOOD, DELETED, CUT_SHORT = range(3)
#: Nodes after which settled edits are let go, and rows that are fed at a time.
SETTLE_NODES = 1 << 14
FEED_ROWS = 1 << 10


class Edits:
    """Strings of edits that share their beginnings.

    A node is one edit after its parent; node 0 is what is settled. ``up[n][k]``
    is the node 2**k above n, ``hash[n]`` a rolling hash of all edits up to n.
    """

    BASE, MODULUS = 0x2545F4914F6CDD1D % ((1 << 61) - 1), (1 << 61) - 1

    def __init__(self) -> None:
        self.edit, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]

    def add(self, parent: int, edit: str) -> int:
        above = [parent]
        while len(self.up[above[-1]]) >= len(above):
            above.append(self.up[above[-1]][len(above) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.BASE + ord(edit)) % self.MODULUS)
        self.up.append(tuple(above))
        return len(self.edit) - 1

    def lifted(self, node: int, steps: int) -> int:
        while steps:
            k = steps.bit_length() - 1
            node, steps = self.up[node][k], steps - (1 << k)
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth spell the same; equal hashes are verified."""
        if x == y or self.hash[x] != self.hash[y]:
            return x == y
        while x != y:
            if self.edit[x] != self.edit[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether the edits of x come before those of y, as ASCII strings."""
        short = min(self.depth[x], self.depth[y])
        a, b = self.lifted(x, self.depth[x] - short), self.lifted(y, self.depth[y] - short)
        if self.same(a, b):
            return self.depth[x] < self.depth[y]
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.edit[a] < self.edit[b]  # all above is their longest common prefix

    def spelt(self, node: int, below: int = 0) -> str:
        """The edits from after ``below``, an ancestor, to the node."""
        out = []
        while node != below:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def shared(self, nodes: Iterable[int]) -> int:
        """The lowest node that is above or equal to all ``nodes``."""
        a, *others = nodes
        for b in others:
            short = min(self.depth[a], self.depth[b])
            a, b = self.lifted(a, self.depth[a] - short), self.lifted(b, self.depth[b] - short)
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                    a, b = self.up[a][k], self.up[b][k]
            a = a if a == b else self.up[a][0]
        return a

    def below(self, root: int, nodes: Iterable[int]) -> tuple[Edits, dict[int, int]]:
        """Only what lies between ``root`` and ``nodes``, and the new number of each node."""
        wanted: set[int] = set()
        for node in nodes:
            while node != root and node not in wanted:
                wanted.add(node)
                node = self.up[node][0]
        fresh, number = Edits(), {root: 0}
        for node in sorted(wanted):  # parents have lower numbers
            number[node] = fresh.add(number[self.up[node][0]], self.edit[node])
        return fresh, number


class Repair:
    """The dynamic programme over the rows of one conversation."""

    def __init__(self) -> None:
        self.edits, self.settled = Edits(), []
        self.best = self._with_inserts({NOTHING: (0, 0)})

    def _offer(self, ends: dict[int, tuple[int, int]], end: int, cost: int, parent: int, edit: str) -> None:
        held = ends.get(end)
        if held and held[0] < cost:
            return
        node = self.edits.add(parent, edit)
        if not held or cost < held[0] or self.edits.less(node, held[1]):
            ends[end] = cost, node

    def _with_inserts(self, ends: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """The ends with turns inserted where that is cheaper; two in a row at most help."""
        for end in (NOTHING, SYSTEM, ASSISTANT, USER):
            if end in ends:
                cost, node = ends[end]
                self._offer(ends, TURN[end], cost + COSTS[INSERT], node, INSERT)
        return ends

    def feed(self, rows: Iterable[tuple[str, int]]) -> None:
        """Take (initial of the role, GOOD, DELETED or CUT_SHORT) of the next rows."""
        for initial, fault in rows:
            after: dict[int, tuple[int, int]] = {}
            for end, (cost, node) in self.best.items():
                self._offer(after, end, cost + COSTS[DELETE], node, DELETE)
                if fault == DELETED:
                    continue
                more = cost + TRUNCATED_COST * (fault == CUT_SHORT)
                if (end, initial) in KEPT:
                    self._offer(after, KEPT[end, initial], more + COSTS[KEEP], node, KEEP)
                self._offer(after, TURN[end], more + COSTS[REROLE], node, REROLE)
            self.best = self._hopeful(self._with_inserts(after))
            if len(self.edits.edit) > SETTLE_NODES:
                self._settle()

    @staticmethod
    def _hopeful(ends: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """The ends that can still win against that of an assistant turn.

        After an assistant turn all is legal that is after a system turn, and after
        nothing but a kept system row, which can be deleted instead.
        """
        done = ends[ASSISTANT][0]
        slack = {NOTHING: COSTS[DELETE], SYSTEM: 0, USER: 2 * COSTS[INSERT], ASSISTANT: 0}
        return {end: held for end, held in ends.items() if held[0] <= done + slack[end]}

    def _settle(self) -> None:
        nodes = [node for _, node in self.best.values()]
        root = self.edits.shared(nodes)
        self.settled.append(self.edits.spelt(root))
        self.edits, number = self.edits.below(root, nodes)
        self.best = {end: (cost, number[node]) for end, (cost, node) in self.best.items()}

    def cheapest(self) -> tuple[int, str]:
        """(cost, edits) of the cheapest repair; of ties the ASCII-least edits."""
        done = [self.best[end] for end in (NOTHING, ASSISTANT) if end in self.best]
        (cost, node), *others = done
        for more, other in others:
            if more < cost or more == cost and self.edits.less(other, node):
                cost, node = more, other
        return cost, "".join(self.settled) + self.edits.spelt(node)


@lru_cache(maxsize=1 << 14)
def cheapest_repair(rows: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    """Cost and edits of a short conversation; many have the same rows."""
    repair = Repair()
    repair.feed(rows)
    return repair.cheapest()


def turn_role(place: int, total: int) -> str:
    """Role of the given turn, from 0, of a legal conversation of ``total`` turns that has no own."""
    return "user" if place % 2 == total % 2 else "assistant"


def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from its edits and damaged rows."""
    total, place = len(audit) - audit.count(DELETE), 0
    for edit in audit:
        role, text = (turn_role(place, total), "") if edit == INSERT else next(rows)
        if edit == REROLE:
            role = turn_role(place, total)
        if edit != DELETE:
            yield role, text
            place += 1


ORDER = ("turn", "role_was", "text_was", "copy")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def read_rows(conversations: DataFrame) -> DataFrame:
    """The rows as they stand, in the form :func:`repair_conversations` takes.

    ``gone`` marks a row that is only there to name its conversation. Null roles
    and texts are one space. Rows of one turn come by role and by the MD5 of the
    text, so equal rows are adjacent.
    """
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), role.alias("role_was"),
        F.md5(text).alias("text_was"), F.lit(0).alias("copy"), F.lit(False).alias("gone"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`read_rows` damaged by a draw on conversation and turn.

    Of 20 values 0 drops the row, 1 empties its text, 2 takes out its full stops,
    exclamation and question marks, 3 repeats it and 4 makes its role user.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    return (
        rows.withColumn("draw", draw)
        .withColumn("copy", F.explode(copies))
        .withColumn("text", text)
        .withColumn("role", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")))
        .withColumn("gone", F.col("draw") == 0)
        .drop("draw")
    )


def _of_conversations(columns: list[pa.Array]) -> Iterator[tuple]:
    """The rows of a batch as tuples."""
    return zip(*(c.to_pylist() for c in columns))


def faults(rows: DataFrame) -> DataFrame:
    """One narrow row per row, in order within its conversation: its first fault and neighbours.

    (conv_id, gone, turn, initial, fault, illegal); ``fault`` is blank,
    duplicate, truncated or null. Rows of a conversation come together, those
    that are gone last.
    """
    narrow = rows.select(
        "conv_id", "gone", *ORDER, "role", F.substring("role", 1, 1).alias("initial"), F.md5("text").alias("said"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    ).repartition("conv_id")
    order = [F.col(c) for c in ("gone", *ORDER)]
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "said").orderBy(*order)) > 1
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("truncated"), "truncated")
    along = Window.partitionBy("conv_id").orderBy(*order)
    pair = F.concat(F.lag("initial").over(along), "initial")
    return (
        narrow.withColumn("fault", fault)
        .withColumn("illegal", F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
        .sortWithinPartitions("conv_id", *order)
        .select("conv_id", "gone", "turn", "initial", "fault", "illegal")
    )


class _Tally:
    """What the narrow stream gathers of one conversation."""

    KINDS = {None: GOOD, "blank": DELETED, "duplicate": DELETED, "truncated": CUT_SHORT}

    def __init__(self) -> None:
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.distinct, self.rows, self.repair = 0, [], None

    def take(self, turn: int | None, initial: str, fault: str | None, illegal: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if fault:
            self.counts[fault] += 1
        self.counts["illegal"] += illegal
        self.rows.append((initial if initial in ("s", "u", "a") else "", self.KINDS[fault]))
        if len(self.rows) == FEED_ROWS:
            self.repair = self.repair or Repair()
            self.repair.feed(self.rows)
            self.rows = []

    def result(self) -> tuple:
        if self.distinct:
            self.counts["gaps"] = self.last - self.first + 1 - self.distinct
        if self.repair:
            self.repair.feed(self.rows)
            self.counts["cost"], audit = self.repair.cheapest()
        else:
            self.counts["cost"], audit = cheapest_repair(tuple(self.rows))
        return *self.counts.values(), audit


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
    kinds = {"conv_id": pa.int64(), **dict.fromkeys(COUNTS, pa.int64()), "audit": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, tally = False, None, _Tally()
        for batch in sliced(batches):
            out = []
            for conv_id, gone, *row in _of_conversations(batch.columns):
                if not begun or conv_id != now:
                    if begun:
                        out.append((now, *tally.result()))
                    begun, now, tally = True, conv_id, _Tally()
                if not gone:
                    tally.take(*row)
            yield _batch(out, kinds)
        if begun:
            yield _batch([(now, *tally.result())], kinds)

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
    return faults(rows).mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations, places from 0."""
    kinds = {"conv_id": pa.int64(), "place": pa.int64(), "role": pa.string(), "text": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for head, turns in _conversations(batches):
            for place, turn in enumerate(repaired_turns(head[-1], turns)):
                held.append((head[0], place, *turn))
                if len(held) == FEED_ROWS:
                    yield _batch(held, kinds)
                    held = []
        yield _batch(held, kinds)

    return _texts_after_edits(rows, found).mapInArrow(run, "conv_id long, place long, role string, text string")


def _texts_after_edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The edits and then the rows of each conversation, in order."""
    counts = F.struct(*COUNTS)
    none = {c: F.lit(None).cast(kind) for c, kind in rows.dtypes}
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), *(none[c].alias(c) for c in ORDER), F.lit("").alias("role"),
        F.col("audit").alias("text"), counts.alias("counts"))
    turns = rows.filter("not gone").select(
        "conv_id", F.lit(1).alias("kind"), *ORDER, "role", "text",
        F.lit(None).cast(heads.schema["counts"].dataType).alias("counts"))
    return (
        heads.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
        .select("conv_id", "kind", "role", "text", "counts")
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """((conv_id, counts, edits), rows of (role, text)) of each conversation of a sorted stream.

    The rows are read from the stream as they are asked for and must be taken
    before the next conversation.
    """
    stream = (row for batch in sliced(batches) for row in _of_conversations(batch.columns))
    ahead = next(stream, None)

    def rows() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[1] == 1:
            role, text = ahead[2], ahead[3]
            ahead = next(stream, None)
            yield role, text

    while ahead is not None:
        conv_id, _, _, audit, counts = ahead
        ahead = next(stream, None)
        turns = rows()
        yield (conv_id, counts, audit), turns
        for _ in turns:
            pass


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``rows`` come from :func:`read_rows` or :func:`damaged`. Each row counts by its
    first fault: blank, a role and text seen earlier, no full stop at the end.
    ``illegal`` counts neighbours out of order, ``gaps`` missing turn numbers.
    ``audit`` has the initial of each edit of the cheapest repair, ties ASCII-least;
    ``repaired_sha256`` hashes its ``role:text`` lines. A conversation all of whose
    rows are gone has zeros and the hash of nothing. A null conv_id is a conversation
    of its own; repeated rows are rows; an empty table gives an empty table.
    """
    names = ("conv_id", *COUNTS, "audit", "repaired_sha256")
    kinds = {"conv_id": pa.int64(), **dict.fromkeys(COUNTS, pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for (conv_id, counts, audit), turns in _conversations(batches):
            digest, between = sha256(), b""
            for role, text in repaired_turns(audit, turns):
                digest.update(between + role.encode() + b":" + text.encode())
                between = b"\n"
            held.append((conv_id, *counts.values(), audit, digest.hexdigest()))
            if len(held) == FEED_ROWS:
                yield _batch(held, kinds)
                held = []
        yield _batch(held, kinds)

    schema = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in names)
    return _texts_after_edits(rows, audits(rows)).mapInArrow(run, schema)
