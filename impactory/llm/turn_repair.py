"""Repair of the structure of conversations: which turns to keep, rename, delete or add at least cost.

Conversations are repartitioned by their id and their rows sorted by turn within a partition. mapInPandas
then streams through them: a dynamic program over the states of `(s?(ua)+)?`, which is carried from one Arrow
batch to the next, so a conversation may span any number of batches. For each of the four states it holds the
cost, the rank of the edits so far in ASCII order, and a running digest of the repaired conversation; which
edits led to each state is a byte in a backpointer row of four. Backpointers, and where rows are to be returned
those too, lie in memory up to SPOOL bytes and beyond that in an unnamed file of the task. So a giant conversation takes four
bytes a row, and no memory that grows with it but its own audit.

Ranks are enough for ties: paths are compared where each has just consumed a row. Two of them with equal
cost and state have the same number of rows behind them and end in a row's edit, so neither begins with the other.

Repeated turns are found by Spark before the stream, from a window over role and text within the same partitions,
which spills.

Rows: null roles and texts are one space, as null ids and turns are in the damage's key; a null id is a
conversation of its own; null turns come first. Rows of the same turn are ordered by role, then text (ties beyond that are equal rows). A
role without a first letter can't be kept. Very long texts are hashed as they pass. Repeated rows are
duplicates. A conversation that lost all rows has zeros, no audit and the digest of the empty text; an empty table gives no
rows. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import load, small_batches

#: States: nothing yet, after the system's turn, the user's, the assistant's. From a state by an initial to a state.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: What may be inserted in each state: the only one of user and assistant that may follow.
NEXT = ("user", "user", "assistant", "user")
AFTER = tuple(MOVES[q, role[0]] for q, role in enumerate(NEXT))
#: Whether a conversation may end there.
ENDS = (True, False, False, True)
RENAME, DELETE, INSERT, TRUNCATED_KEPT = 1, 2, 5, 5
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Edits of a row, by number, each perhaps after an insertion, as letters.
EDITS = ("D", "K", "R", "ID", "IK", "IR")
#: Bytes that a conversation's backpointers and rows may take in memory.
SPOOL = 4 << 20
WHITE, LETTER = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _options() -> dict[tuple[str, bool], list[tuple[int, int, str, int, int, str | None]]]:
    """For a row's initial and whether it must go: (from, to, letters, number, cost, new role), truncation aside."""
    out = {}
    for initial in ("s", "u", "a", ""):
        for must_go in (False, True):
            here = []
            for start in range(4):
                for inserted in (0, 1):
                    q, paid = (AFTER[start], INSERT) if inserted else (start, 0)
                    here.append((start, q, "I" * inserted + "D", 3 * inserted, paid + DELETE, None))
                    if not must_go:
                        if (q, initial) in MOVES:
                            here.append((start, MOVES[q, initial], "I" * inserted + "K", 3 * inserted + 1, paid, ""))
                        here.append((start, AFTER[q], "I" * inserted + "R", 3 * inserted + 2, paid + RENAME, NEXT[q]))
            out[initial, must_go] = here
    return out


OPTIONS = _options()


class Repair:
    """The program over one conversation, fed a row at a time."""

    def __init__(self, keep_rows: bool):
        self.paths: dict[int, tuple[int, int]] = {0: (0, 0)}  # state: cost, rank of its edits
        self.digests = {0: hashlib.sha256()}
        self.back = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        self.rows = tempfile.SpooledTemporaryFile(max_size=SPOOL) if keep_rows else None
        self.n = 0

    def feed(self, role: str, text: str, fault: int) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        late = TRUNCATED_KEPT if fault == TRUNCATED else 0
        best: dict[int, tuple] = {}
        for start, to, letters, number, paid, new in OPTIONS[initial, fault in (BLANK, DUPLICATE)]:
            at = self.paths.get(start)
            if at is not None:
                key = (at[0] + paid + (late if new is not None else 0), at[1], letters)
                if to not in best or key < best[to][0]:
                    best[to] = (key, start, number, new)
        rank = {x: i for i, x in enumerate(sorted({k[1:] for k, *_ in best.values()}))}
        pointers, digests = bytearray(4), {}
        for to, (key, start, number, new) in best.items():
            pointers[to] = start * 8 + number
            digest = self.digests[start].copy()
            q = start
            if number >= 3:
                self._said(digest, q, f"{NEXT[q]}:")
                q = AFTER[q]
            if new is not None:
                self._said(digest, q, f"{new or role}:{text}")
            digests[to] = digest
        self.paths = {to: (key[0], rank[key[1:]]) for to, (key, *_) in best.items()}
        self.digests = digests
        self.back.write(pointers)
        if self.rows is not None:
            pickle.dump((role, text), self.rows)
        self.n += 1

    @staticmethod
    def _said(digest, state: int, line: str) -> None:
        digest.update((("\n" if state else "") + line).encode("utf-8", "surrogatepass"))

    def end(self) -> tuple[int, str, str, list[int]]:
        """Cost, audit, digest, and the edit of each row. Only state 0 has nothing said."""
        done = []
        for state, (cost, rank) in self.paths.items():
            q, added = state, 0
            while not ENDS[q]:
                q, added = AFTER[q], added + 1
            done.append(((cost + added * INSERT, rank, "I" * added), state))
        (cost, _, tail), state = min(done)
        digest, q = self.digests[state], state
        for _ in tail:
            self._said(digest, q, f"{NEXT[q]}:")
            q = AFTER[q]
        edits = np.empty(self.n, np.uint8)
        # Backwards, a block of the spool at a time.
        step = 1 << 16
        for hi in range(self.n, 0, -step):
            lo = max(0, hi - step)
            self.back.seek(4 * lo)
            block = self.back.read(4 * (hi - lo))
            for i in range(hi - lo - 1, -1, -1):
                p = block[4 * i + state]
                edits[lo + i], state = p % 8, p // 8
        self.back.close()
        return cost, "".join(map(EDITS.__getitem__, edits)) + tail, digest.hexdigest(), edits

    def repaired(self, edits: np.ndarray, tail: int) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the rows that are left, in order."""
        self.rows.seek(0)
        q = 0
        for e in edits:
            role, text = pickle.load(self.rows)
            if e >= 3:
                yield NEXT[q], "", "I"
                q = AFTER[q]
            if e % 3:
                role = NEXT[q] if e % 3 == 2 else role
                yield role, text, "KR"[e % 3 - 1]
                q = MOVES[q, role[0]]
        for _ in range(tail):
            yield NEXT[q], "", "I"
            q = AFTER[q]
        self.rows.close()


def or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the damage of the contract; a dropped row stays as a mark of its conversation."""
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), or_space("role").alias("role"), or_space("text").alias("text"), kind.alias("kind"))
    out = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    lost = {c: F.when(~F.col("gone"), F.col(c)).alias(c) for c in ("turn", "role", "text")}
    return out.withColumn("again", F.explode(F.sequence(F.lit(1), "times"))).select("conv_id", *lost.values(), "gone")


def streamed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, gone, fault): partitions of whole conversations, in order; faults found."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    own = rows.select(conv.alias("conv"), "turn", "role", "text", "gone").repartition("conv")
    seen = F.row_number().over(Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(~F.col("text").rlike(LETTER), BLANK)
        .when(F.col("seen") > 1, DUPLICATE)
        .when(~F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z"), TRUNCATED)
        .otherwise(SOUND)
    )
    marked = own.withColumn("seen", seen).select("conv", F.col("turn").cast("string").alias("turn"), F.col("turn").alias("by"), "role", "text", "gone", F.coalesce(F.when(~F.col("gone"), fault), F.lit(SOUND)).alias("fault"))
    return marked.sortWithinPartitions(F.col("conv"), F.col("by").asc_nulls_first(), "role", "text").drop("by")


SUMMARY = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "conv string, place long, role string, text string, edit string"
LEGAL = {"su", "ua", "au"}
#: Repaired rows that are returned at once.
AT_ONCE = 512


def repairing(keep_rows: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, program, counts, turns, last = None, None, None, None, None
        done: list[tuple] = []

        def finish() -> Iterator[pd.DataFrame]:
            cost, audit, digest, edits = program.end()
            if keep_rows:
                tail, place = len(audit) - sum(len(EDITS[e]) for e in edits), 0
                for place, row in enumerate(program.repaired(edits, tail)):
                    done.append((now, place, *row))
                    if len(done) >= AT_ONCE:
                        yield pd.DataFrame(done, columns=names)
                        done.clear()
                return
            gaps = 0 if turns[0] is None else turns[1] - turns[0] + 1 - turns[2]
            done.append((now, gaps, *counts, cost, audit, digest))

        names = [x.split()[0] for x in (ROWS if keep_rows else SUMMARY).split(", ")]
        for b in batches:
            for conv, turn, role, text, gone, fault in b.itertuples(index=False, name=None):
                if conv != now:
                    if now is not None:
                        yield from finish()
                    now, program, counts, turns, last = conv, Repair(keep_rows), [0, 0, 0, 0], [None, None, 0], None
                if gone:
                    continue
                if fault:
                    counts[fault - 1] += 1
                if last is not None and last + role[:1] not in LEGAL:
                    counts[3] += 1
                last = role[:1]
                if turn is not None:
                    t = int(turn)
                    if turns[1] != t:  # sorted: another turn
                        turns[0] = t if turns[0] is None else turns[0]
                        turns[1], turns[2] = t, turns[2] + 1
                program.feed(role, text, fault)
            if done:
                yield pd.DataFrame(done, columns=names)
                done.clear()
        if now is not None:
            yield from finish()
        if done:
            yield pd.DataFrame(done, columns=names)

    return run


def _conv_id() -> Column:
    return F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id")


def repair(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) to the repaired ones: conv_id, place, role, text, edit (K, R or I)."""
    small_batches(rows.sparkSession)
    out = streamed(rows).mapInPandas(repairing(True), ROWS)
    return out.select(_conv_id(), *(c for c in out.columns if c != "conv"))


def reports(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) to a row per conversation: faults, cost, audit, digest of the repaired one."""
    small_batches(rows.sparkSession)
    out = streamed(rows).mapInPandas(repairing(False), SUMMARY)
    return out.select(_conv_id(), *(c for c in out.columns if c != "conv"))


def op11_turn_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation, damaged as the contract says, with its faults and the cheapest repair."""
    return reports(damaged(load(spark, sf_dir, "conversations")))
