r"""Conversation structure repair by a suffix-shared automaton.

Every row of a conversation becomes one symbol of a *signature*: its role
(system, user, assistant or another, by the first letter) and its first fault.
Blank rows (no ``[^\x20\x09-\x0D]``) and duplicates (role and text seen earlier in
the conversation) must go; truncated rows (last such character not ``[.!?]``)
cost extra when they stay. Repairs keep, re-role, delete or insert rows until the
roles read ``(s?(ua)+)?``.

The signatures of all conversations, read from the end, are the paths of one
automaton in which equal suffixes are one node. For each node and each of the
four grammar states it holds the cost to go and the first edit of the best (of
equal cost the ASCII-least) audit; the edits follow from node to node. All edits
that a node offers in one state differ in their letter, so that first letter
decides. Signatures are dealt by range and sorted by their reversed text: a
conversation shares the nodes of the suffix it has in common with the one before
it, and only new nodes are computed. A signature that many conversations have is one
chain of nodes, and its conversations spread over tasks. A task holds one chain,
as long as the longest signature; nodes on the border of two ranges are computed in
both.

Rows are grouped by a sort that spills and read as a stream: a conversation of any
length holds one letter a row, one row's text, and the state of its digest.
First occurrences come from an aggregation, not from a set in memory. Texts move
once, to be edited.

Defined results: a null role or text is one space (a blank row; the role's letter
is none). Null ids are one conversation. Rows come by turn (null first), rows of
one turn by role and digest of role and text, so repeats stand side by side. A
conversation without rows has an empty audit. Empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import counted_broadcast, table, written

SPACE = r"\x20\x09-\x0D"
LETTERS, FINE, GONE, CUT = "sua", 0, 1, 2                       # roles of the grammar; faults of a symbol
RETAG, DELETE, INSERT, CUT_COST, DAMAGES = 1, 2, 5, 5, 20
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)     # the state after the turn that is due
DUE = ("user", "user", "assistant", "user")                      # and that turn's role
KEPT = {("s", START): AFTER_SYSTEM, ("u", START): AFTER_USER, ("u", AFTER_SYSTEM): AFTER_USER,
        ("u", AFTER_ASSISTANT): AFTER_USER, ("a", AFTER_USER): AFTER_ASSISTANT}
LEGAL = {"su", "ua", "au"}

Node = tuple[tuple[int, str], ...]                               # cost to go and first edit, by state
#: Behind the last row: nothing is due at the start and after an assistant; else turns are inserted.
END: Node = ((0, ""), (2 * INSERT, "I"), (INSERT, "I"), (0, ""))


def symbol(role: str, fault: int) -> str:
    """One letter for the role's initial (others are one kind) and the fault."""
    return chr(ord("a") + 3 * (LETTERS.find(role) if role else -1) + fault + 3)


def _meaning(letter: str) -> tuple[str, int]:
    kind, fault = divmod(ord(letter) - ord("a"), 3)
    return (" " + LETTERS)[kind], fault


def node_before(letter: str, child: Node) -> Node:
    """The node that reads ``letter`` and goes on with ``child``."""
    role, fault = _meaning(letter)
    stay = CUT_COST if fault == CUT else 0
    best = []
    for state in range(4):
        options = [(DELETE + child[state][0], "D")]
        if fault != GONE:
            if (role, state) in KEPT:
                options.append((stay + child[KEPT[role, state]][0], "K"))
            options.append((RETAG + stay + child[NEXT[state]][0], "R"))
        best.append(min(options))
    # a turn inserted before this row; two at most help, since three return to a state
    user = min(best[AFTER_USER], (INSERT + best[AFTER_ASSISTANT][0], "I"))
    last = min(best[AFTER_ASSISTANT], (INSERT + best[AFTER_USER][0], "I"))
    start, system = (min(best[s], (INSERT + user[0], "I")) for s in (START, AFTER_SYSTEM))
    return start, system, user, last


class Automaton:
    """The nodes of one path; paths given in reversed order share those of their common suffix."""

    def __init__(self) -> None:
        self.path, self.nodes, self.computed = "", [END], 0

    def repair(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of the signature whose reversed text this is."""
        same, limit = 0, min(len(self.path), len(backwards))
        if self.path[:limit] == backwards[:limit]:
            same = limit
        else:
            while self.path[same] == backwards[same]:
                same += 1
        del self.nodes[same + 1:]
        for letter in backwards[same:]:
            self.nodes.append(node_before(letter, self.nodes[-1]))
        self.computed += len(backwards) - same
        self.path = backwards
        at, state, audit = len(backwards), START, []
        while edit := self.nodes[at][state][1]:
            audit.append(edit)
            if edit == "K":
                state = KEPT[_meaning(backwards[at - 1])[0], state]
            elif edit != "D":
                state = NEXT[state]
            at -= edit != "I"
        return self.nodes[-1][START][0], "".join(audit)


# ------------------------------------------------------------- signatures ----

def _sized() -> Column:
    """Conversation, role and text as one string."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    return F.concat(conv, F.lit("/"), F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))


def marked(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, initial, key, gone, blank, cut)`` of rows ``(conv_id, turn, role, text, gone)``.

    ``gone`` rows only name their conversation. ``key`` is a digest of conversation, role and text.
    """
    key = F.unhex(F.sha2(_sized(), 256))
    return rows.select("conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), key.alias("key"), "gone",
                       (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
                       (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"))


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "key")


def signatures(rows: DataFrame) -> DataFrame:
    """One row a conversation: its reversed signature and the counts of its faults."""
    marks = written(marked(rows), "repair-marks")
    again = marks.where("not gone").groupBy("key").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    again = counted_broadcast(written(again.where("n > 1").select("key", "first.turn"), "repair-repeats").withColumnRenamed("turn", "__turn"))
    found = marks.join(again.withColumn("__repeated", F.lit(True)), "key", "left")
    later = F.coalesce(F.col("__repeated"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("__turn"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    return _sorted(found.withColumn("later", later)).select("conv_id", F.col("turn").cast("long").alias("turn"), "initial", "key",
                                                            "gone", "blank", "cut", "later").mapInArrow(
        _signatures, f"conv_id {kinds['conv_id']}, backwards string, gaps long, blank long, duplicate long, truncated long, illegal long")


class _Tally:
    """What a stream of one conversation's rows leaves behind."""

    def __init__(self, conv) -> None:
        self.conv, self.letters, self.blank, self.duplicate, self.truncated, self.illegal = conv, [], 0, 0, 0, 0
        self.low = self.high = None
        self.turns, self.key, self.initial = 0, None, None

    def add(self, turn, initial, key, blank, cut, later) -> None:
        duplicate = later or key == self.key        # repeats of one turn stand side by side
        fault = GONE if blank or duplicate else CUT if cut else FINE
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += fault == CUT
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.letters.append(symbol(initial, fault))
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.key, self.initial = key, initial

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, "".join(reversed(self.letters)), gaps, self.blank, self.duplicate, self.truncated, self.illegal


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = None
    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for conv, turn, initial, key, gone, blank, cut, later in zip(*[c.to_pylist() for c in batch.columns]):
            if tally is None or conv != tally.conv:
                done += [tally.row()] if tally else []
                tally = _Tally(conv)
            if not gone:
                tally.add(turn, initial, key, blank, cut, later)
        yield _arrow(done, kind)
    if tally:
        yield _arrow([tally.row()], kind)


def _arrow(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.string()] + [pa.int64()] * len(_COUNTS)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["conv_id", "backwards", *_COUNTS])


# ------------------------------------------------------------------ audits ----

def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for batch in batches:
        found = [automaton.repair(x) for x in batch["backwards"].to_pylist()]
        kept = [c for c in batch.schema.names if c != "backwards"]
        yield pa.RecordBatch.from_arrays(
            [batch[c] for c in kept] + [pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            kept + ["cost", "audit"])


def audits(signed: DataFrame) -> DataFrame:
    """Written rows of ``signatures`` with ``cost`` and ``audit`` in place of the signature."""
    kind = signed.schema["conv_id"].dataType.simpleString()
    dealt = signed.repartitionByRange("backwards", "conv_id").sortWithinPartitions("backwards", "conv_id")
    return dealt.mapInArrow(_audit, f"conv_id {kind}, {', '.join(c + ' long' for c in _COUNTS)}, cost long, audit string")


# ------------------------------------------------------------------- edits ----

class Edits:
    """Repaired rows ``(role, text)`` of one conversation from its audit and its rows in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            yield DUE[self.state], ""
            self.state, self.at = NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            yield role, text
            self.state = KEPT[role[:1], self.state]
        elif edit == "R":
            yield DUE[self.state], text
            self.state = NEXT[self.state]

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._insert()


_HEAD = [*_COUNTS, "cost", "audit"]


def _with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its rows in order."""
    alive = rows.where("not gone")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    body = alive.select("conv_id", "turn", "role", "text", F.unhex(F.sha2(_sized(), 256)).alias("key"), F.lit(1).alias("part"),
                        *[F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in _HEAD])
    top = heads.select("conv_id", *[F.lit(None).cast(kinds[c]).alias(c) for c in ("turn", "role", "text")],
                       F.lit(None).cast("binary").alias("key"), F.lit(0).alias("part"), *_HEAD)
    return _sorted(top.unionByName(body), "part").drop("turn", "key")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list[tuple[dict | None, str, str]]]]:
    """Per batch: events ``(head, None, None)`` at a conversation's start, ``(None, role, text)`` for each repaired row."""
    edits, kind = None, None
    for batch in batches:
        kind, events = batch.schema.field("conv_id").type, []
        for row in zip(*[batch[c].to_pylist() for c in ("part", "role", "text", "conv_id", *_HEAD)]):
            if row[0] == 0:
                events += [(None, *x) for x in edits.end()] if edits else []
                events.append((dict(zip(("conv_id", *_HEAD), row[3:])), None, None))
                edits = Edits(row[-1])
            else:
                events += [(None, *x) for x in edits.row(row[1], row[2])]
        yield kind, events
    if edits:
        yield kind, [(None, *x) for x in edits.end()]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head, digest, any_row = None, None, False

    def made(rows: list[dict]) -> pa.RecordBatch:
        names = ["conv_id", *_HEAD, "repaired_sha256"]
        kinds = [kind] + [pa.int64()] * (len(_COUNTS) + 1) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    for kind, events in _conversations(batches):
        done = []
        for start, role, text in events:
            if start is not None:
                done += [head | {"repaired_sha256": digest.hexdigest()}] if head else []
                head, digest, any_row = start, sha256(), False
            else:
                digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
                any_row = True
        yield made(done)
    if head:
        yield made([head | {"repaired_sha256": digest.hexdigest()}])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, turn = None, 0
    for kind, events in _conversations(batches):
        rows = []
        for start, role, text in events:
            if start is not None:
                conv, turn = start["conv_id"], 0
            else:
                rows.append((conv, turn, role, text))
                turn += 1
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((kind, pa.int64(), pa.string(), pa.string()))],
                                         ["conv_id", "turn", "role", "text"])


def prepared(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text, gone)`` with nulls as one space."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")}
    return conversations.select("conv_id", "turn", *text.values(), F.lit(False).alias("gone"))


def audited(rows: DataFrame) -> DataFrame:
    """One written row a conversation: counts of its faults, the cost and the audit of its best repair."""
    return written(audits(written(signatures(rows), "repair-signatures")), "repair-audits")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations, ``(conv_id, turn, role, text)`` with turns from 0."""
    rows = prepared(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _with_heads(rows, audited(rows)).mapInArrow(_repaired, f"conv_id {kind}, turn long, role string, text string")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row a conversation: faults, cost, audit and the digest of the repaired rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _with_heads(rows, audited(rows)).mapInArrow(
        _digests, f"conv_id {kind}, {', '.join(c + ' long' for c in _COUNTS)}, cost long, audit string, repaired_sha256 string")


# ------------------------------------------------------------------- query ----

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that a checksum of conversation and turn decides; dropped ones are ``gone``."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % DAMAGES
    rows = prepared(conversations).withColumn("__kind", kind)
    text: Column = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("__kind") == 0).alias("gone"), copies.alias("__copy")).drop("__copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults and its cheapest repair."""
    return repair_report(damaged(table(spark, sf_dir, "conversations")))
