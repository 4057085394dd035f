"""Repair of conversations: the cheapest edits that give turns the order s?(ua)+ of system, user and assistant.

Every row becomes a symbol: the initial of its role, whether it must go, whether it is cut short. A conversation is then a
word, and equal words are solved once. Words are sorted from their ends, so that words with a common suffix stand together:
the automaton of suffixes (one node for each distinct suffix, shared by all words that end so) is walked depth first, with
only the nodes of the present word in memory. A node has the cost to go of each state of the grammar and the first
letter of its best audit; both are made once. Nodes of equal costs (up to a constant) behave alike, so that a step is a lookup.

The best audit needs no comparison of texts: the edits open to a node and state have different letters, so the first letter
decides between equal costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.llm.arrays import slices, strings
from varlake.llm.common import stage

#: Costs of the edits, and of a row that stays though it is cut short.
RE_ROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
#: States of the grammar: nothing yet, after system, after user, after assistant. Where user or assistant leads from each.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
#: What the initials s, u, a lead to from each state.
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Costs to go at the end of a word.
_END = (0, 2 * INSERT, INSERT, 0)
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_VISIBLE, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def symbol(initial: str, fault: int) -> str:
    """A row as one letter: x must go; s, u, a or o (any other role), in upper case if it is cut short."""
    if fault in (BLANK, DUPLICATE):
        return "x"
    letter = initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if fault == TRUNCATED else letter


def step(costs: tuple[int, ...], letter: str) -> tuple[tuple[int, ...], tuple[str, ...]]:
    """Costs to go and first audit letters of a node, by state: its suffix is letter, then a suffix with costs."""
    extra, role = (CUT_SHORT if letter.isupper() else 0), letter.lower()
    options: list[list[tuple[int, str]]] = []
    for state in range(4):
        own = [(costs[state] + DELETE, "D")]
        if role != "x":
            own.append((costs[_NEXT[state]] + RE_ROLE + extra, "R"))
            if role in _KEEP[state]:
                own.append((costs[_KEEP[state][role]] + extra, "K"))
        options.append(own)
    best = [min(own)[0] for own in options]
    for _ in range(3):  # inserted rows stay at the node; a third one in a row never pays
        best = [min(best[s], best[_NEXT[s]] + INSERT) for s in range(4)]
    letters = tuple(min([*options[s], (best[_NEXT[s]] + INSERT, "I")])[1] for s in range(4))
    return tuple(best), letters


class Suffixes:
    """The path of the present word in the automaton of suffixes. Words must come sorted by their reversed letters."""

    def __init__(self) -> None:
        self.word = ""  # reversed
        self.nodes: list[tuple[int, int]] = [(0, 0)]  # (cost of what all states have in common, class) of each suffix
        self.made = 1
        self._classes: dict[tuple, int] = {(_END, ("", "I", "I", "")): 0}
        self._known: list[tuple] = [(_END, ("", "I", "I", ""))]
        self._steps: dict[tuple[int, str], tuple[int, int]] = {}

    def _step(self, kind: int, letter: str) -> tuple[int, int]:
        found = self._steps.get((kind, letter))
        if found is None:
            costs, letters = step(self._known[kind][0], letter)
            low = min(costs)
            key = (tuple(c - low for c in costs), letters)
            if key not in self._classes:
                self._classes[key] = len(self._known)
                self._known.append(key)
            found = self._steps[kind, letter] = (low, self._classes[key])
        return found

    def solve(self, word: str) -> tuple[int, str]:
        """Cost and audit of a word. Only suffixes that the word before did not have get nodes."""
        back, most = word[::-1], min(len(word), len(self.word))
        shared = most if back[:most] == self.word[:most] else int(np.argmax(np.frombuffer(back[:most].encode(), np.uint8) != np.frombuffer(self.word[:most].encode(), np.uint8)))
        nodes = self.nodes
        del nodes[shared + 1 :]
        base, kind = nodes[-1]
        for letter in back[shared:]:
            low, kind = self._step(kind, letter)
            base += low
            nodes.append((base, kind))
        self.made += len(back) - shared
        self.word = back
        cost = base + self._known[kind][0][0]
        at, state, audit = len(back), 0, []
        while True:
            edit = self._known[nodes[at][1]][1][state]
            if not edit:
                return cost, "".join(audit)
            audit.append(edit)
            if edit == "K":
                state = _KEEP[state][back[at - 1].lower()]
            elif edit != "D":
                state = _NEXT[state]
            at -= edit != "I"


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text; nulls of role and text: one space) with errors put in, by crc32("conv_id:turn")
    % 20 (a null id or turn: one space): 0 the row goes (column dropped; the row stays as a mark), 1 its text is empty, 2 its text has no [.!?],
    3 it stands twice (column copies), 4 its role is user. Further columns are left out."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("kind")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"), kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"), (F.col("kind") == 0).alias("dropped"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


#: Rows of a conversation in order. Of one turn: by role, then by the digest of role and text.
_ORDER = ["conv_id", "turn", "role", "digest"]


def words(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, copies int, dropped boolean; no nulls but of conv_id and turn) as one row a conversation: conv_id,
    word (a symbol for each row), gaps, blank, duplicate, truncated, illegal (longs). A conversation of dropped rows only has an empty word.

    No text is shuffled: rows go by their digests, equal rows of a turn as one with their number. A row is a duplicate
    if its digest has an earlier turn, or stands before it in its turn. One conversation's word is made by one task, in one byte a row.
    """
    fault = F.when(~F.col("text").rlike(_VISIBLE), BLANK).when(~F.col("text").rlike(_ENDED), TRUNCATED).otherwise(0).cast("byte")
    plain = rows.select("conv_id", "turn", "role", _digest().alias("digest"), fault.alias("fault"), "dropped", "copies")
    merged = plain.groupBy("conv_id", "turn", "role", "digest", "fault", "dropped").agg(F.sum("copies").alias("copies"))
    # nulls first: a null turn is the earliest
    early = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = merged.where("NOT dropped").groupBy("conv_id", "digest").agg(F.min(early).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    firsts = firsts.select(F.col("conv_id").alias("conv"), F.col("digest").alias("same"), "first")
    joined = merged.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("digest") == F.col("same")), "left")
    joined = joined.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "fault", "dropped", "copies", F.coalesce(F.col("first") != early, F.lit(False)).alias("late"))
    ordered = joined.repartition("conv_id").sortWithinPartitions(*_ORDER).select("conv_id", "turn", "initial", "fault", "dropped", "copies", "late")

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Open | None = None
        done: list[_Open] = []
        for batch in batches:
            for conv, turn, initial, fault, dropped, copies, late in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.conv != conv:
                    own = _Open(conv)
                    done.append(own)
                if not dropped:
                    own.add(turn, initial, fault, copies, late)
            if len(done) > 1:
                yield _spelt(done[:-1])
                del done[:-1]
        if done:
            yield _spelt(done)

    return ordered.mapInArrow(spelt, "conv_id long, word string, gaps long, blank long, duplicate long, truncated long, illegal long")


class _Open:
    """Counts of a conversation, and its word so far."""

    def __init__(self, conv: int | None):
        self.conv, self.word, self.initial = conv, bytearray(), None
        self.low = self.high = self.turn = None
        self.turns, self.faults, self.illegal = 0, [0, 0, 0, 0], 0

    def add(self, turn: int | None, initial: str, fault: int, copies: int, late: bool) -> None:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn, self.turns = turn if self.low is None else self.low, turn, turn, self.turns + 1
        if self.initial is not None:
            self.illegal += f"{self.initial}{initial}" not in ("su", "ua", "au")
        self.illegal += copies - 1  # a role after itself
        self.initial = initial
        first = fault if fault == BLANK or not late else DUPLICATE
        rest = fault if fault == BLANK else DUPLICATE
        self.faults[first] += 1
        self.faults[rest] += copies - 1
        self.word += symbol(initial, first).encode() + symbol(initial, rest).encode() * (copies - 1)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, bytes(self.word), gaps, *self.faults[1:], self.illegal


def _spelt(done: list[_Open]) -> pa.RecordBatch:
    columns = list(zip(*(d.row() for d in done)))
    word = strings(np.frombuffer(b"".join(columns[1]), np.uint8), np.append(0, np.cumsum([len(w) for w in columns[1]])))
    names = ["conv_id", "word", "gaps", "blank", "duplicate", "truncated", "illegal"]
    return pa.record_batch([word if n == "word" else pa.array(c, pa.int64()) for n, c in zip(names, columns)], names=names)


def audits(words: DataFrame) -> DataFrame:
    """Every distinct word of words (word string) with cost long and audit: the initials (Keep, Rerole, Delete, Insert) of its
    cheapest edits, of equal costs the least. Words are dealt out by ranges of their reversed letters, each suffix's node is made once in a range."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Suffixes()
        for batch in batches:
            word = batch.column("word").to_pylist()
            found = [automaton.solve(w) for w in word]
            yield pa.record_batch([pa.array(word, pa.string()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["word", "cost", "audit"])

    distinct = words.select("word").distinct().withColumn("back", F.reverse("word"))
    return distinct.repartitionByRange("back").sortWithinPartitions("back").select("word").mapInArrow(solved, "word string, cost long, audit string")


def report(rows: DataFrame) -> DataFrame:
    """What words gives for rows, and cost and audit of each conversation. Written to the shared folder."""
    spelt = stage(words(rows), "words")
    solved = stage(audits(spelt), "audits")
    return stage(spelt.join(solved, "word"), "repairs")


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns of rows (see words) after the edits of repairs (conv_id, audit): conv_id, place (from 0), edit, role, text.

    Rows stand in order within each partition, a conversation in one. Texts are shuffled once, and each conversation's audit comes
    before its turns; a task holds one audit and one batch. A conversation of which nothing stays has no row."""
    turns = rows.where("NOT dropped").select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("digest"), "text", "copies", F.lit(None).cast("string").alias("audit"))
    none = lambda kind: F.lit(None).cast(kind)
    heads = repairs.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"), F.lit(0).alias("copies"), "audit")
    mixed = heads.union(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER[1:]).select("conv_id", "kind", "role", "text", "copies", "audit")

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place, conv = "", 0, 0, 0, None

        def inserted() -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state = _NEXT[state]
                yield conv, place, "I", _ROLE[state], ""
                at, place = at + 1, place + 1

        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for next_conv, kind, role, text, copies, next_audit in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    out += inserted()
                    audit, at, state, place, conv = next_audit, 0, 0, 0, next_conv
                for _ in range(copies):
                    out += inserted()
                    edit = audit[at]
                    at += 1
                    if edit == "D":
                        continue
                    state = _KEEP[state][role[:1]] if edit == "K" else _NEXT[state]
                    out.append((conv, place, edit, role if edit == "K" else _ROLE[state], text))
                    place += 1
            if out:
                yield _batch(out)
        if rest := list(inserted()):
            yield _batch(rest)

    return mixed.mapInArrow(edited, REPAIRED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["conv_id", "place", "edit", "role", "text"])


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of the lines role:text of each conversation of repaired(), read as they come: conv_id, repaired_sha256."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, done = None, None, []
        for batch in slices(batches, "text"):
            for conv, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest is not None:
                        done.append((own, digest.hexdigest()))
                    own, digest = conv, hashlib.sha256()
                digest.update(f"{'' if place == 0 else chr(10)}{role}:{text}".encode())
            if done:
                yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])
                done = []
        if digest is not None:
            yield pa.record_batch([pa.array([own], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return turns.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame, damage: bool = True) -> tuple[DataFrame, DataFrame]:
    """(repairs, turns) of conversations (conv_id, turn, role, text): what report and repaired give. damage: put errors in first
    (see damaged).

    Rows are taken by turn, nulls first; of one turn by role, then by SHA-256 of both. Null roles and texts are one space, a null conv_id is a
    conversation, repeated rows are rows (and duplicates), further columns are left out. An empty table gives no rows.
    A conversation's word (a byte a row), its audit and its turns in order are one task's, each batch by batch."""
    rows = damaged(conversations)
    if not damage:
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"), F.lit(1).alias("copies"), F.lit(False).alias("dropped"))
    repairs = report(rows)
    return repairs, repaired(rows, repairs)
