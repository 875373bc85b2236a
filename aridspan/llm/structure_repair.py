"""Conversation structure repair by a trie-shared dynamic program: each conversation is a signature, one symbol for each
row's role and fault; distinct signatures are sorted, which is the preorder of their prefix trie, and each task walks
its range of them with a stack of layers. A layer (the cheapest way to each state of the role pattern after so many
rows) is computed once for each prefix that signatures of the range share, and answers are read at terminal nodes.

The pattern of roles is ``(s?(ua)+)?``: an optional system row, then pairs of user and assistant. A row is kept (0),
given another role (1) or deleted (2, a must for blank and repeated rows), and rows without text may be inserted
anywhere (5); a truncated row that stays costs 5 more. Of equally cheap edits the ASCII-least initials win.

Rows move twice: without their texts (a digest stands for them) to make signatures, then with them, behind the edits of
their conversation, to be edited. Both times a task reads a sorted stream and holds one conversation's signature or
edits (a byte a row) and no row. A conversation's rows stand in one order, so one task reads them one after another.
Signatures that many conversations share are combined before their shuffle, and their answers are dealt out with
``join_spread``.

Defined cases: null roles and texts count as one space; rows of one turn stand in order of role, then of the text's
MD5; rows whose conv_id is null are one conversation; a role that begins with none of s, u, a can only be given
another or be deleted; an empty conversation is what the pattern allows and costs nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from aridspan.llm.common import SPACES, join_spread, n_tasks, stored, table

#: States of the role pattern: nothing yet, after a system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: Where an inserted row leads, which is also where a row with a new role leads.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (EMPTY, ASSISTANT)
#: Two inserted rows in a run reach every state that any number reaches.
MOST_INSERTS = 2
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols of a signature: the role's initial (o: any other), as a capital if truncated; d: must be deleted.
MUST_GO, OTHER = "d", "o"

FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
ROWS = "conv_id long, place long, role string, text string, edit string"


def kept_state(initial: str, state: int) -> int | None:
    """Where a kept row of this initial leads, if the pattern allows it there."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial in ("u", "a") and NEXT[state] == (USER if initial == "u" else ASSISTANT):
        return NEXT[state]
    return None


def moves(symbol: str) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of the best inserts and edit that lead over a row, for each pair of states."""
    stays = TRUNCATED if symbol.isupper() else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, letters = start, ""
        for n in range(MOST_INSERTS + 1):
            ways = [(DELETE, state, COSTS[DELETE])]
            if symbol != MUST_GO:
                kept = kept_state(symbol.lower(), state)
                ways += [(REROLE, NEXT[state], COSTS[REROLE] + stays)]
                ways += [(KEEP, kept, stays)] if kept is not None else []
            for letter, to, cost in ways:
                way = (cost + n * COSTS[INSERT], letters + letter)
                best[start, to] = min(best.get((start, to), way), way)
            state, letters = NEXT[state], letters + INSERT
    return [(start, to, *way) for (start, to), way in sorted(best.items())]


#: A layer has for each state None or (cost, rank, state before, letters). The letters that lead to two states of a layer
#: differ, and neither begins with the other, as both end with an edit of the same row; rank is their order.
FIRST = ((0, 0, EMPTY, ""), None, None, None)


def next_layer(layer: tuple, ways: list[tuple[int, int, int, str]]) -> tuple:
    best: list = [None] * 4
    for start, to, cost, letters in ways:
        if layer[start] is not None:
            way = (layer[start][0] + cost, layer[start][1], letters, start)
            if best[to] is None or way < best[to]:
                best[to] = way
    order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b is not None)
    ranks = {to: i for i, (_, _, to) in enumerate(order)}
    return tuple(None if b is None else (b[0], ranks[to], b[3], b[2]) for to, b in enumerate(best))


def answer(layers: list[tuple]) -> tuple[int, str]:
    """The cost and letters of the best way through all layers to an end."""
    ways = []
    for state, held in enumerate(layers[-1]):
        if held is not None:
            reached = state
            for n in range(MOST_INSERTS + 1):
                if reached in ENDS:
                    ways.append((held[0] + n * COSTS[INSERT], held[1], INSERT * n, state))
                reached = NEXT[reached]
    cost, _, last, state = min(ways)
    parts = [last]
    for layer in reversed(layers):
        parts.append(layer[state][3])
        state = layer[state][2]
    return cost, "".join(reversed(parts))


class Trie:
    """Answers for sorted signatures: the stack holds the layers of the current path, and of the next signature only what
    follows its common prefix with the last one is computed."""

    def __init__(self) -> None:
        self.stack, self.path, self.computed = [FIRST], "", 0
        self.ways: dict[str, list] = {}

    def answer(self, signature: str) -> tuple[int, str]:
        shared = common_prefix(self.path, signature)
        del self.stack[shared + 1 :]
        for symbol in signature[shared:]:
            if symbol not in self.ways:
                self.ways[symbol] = moves(symbol)
            self.stack.append(next_layer(self.stack[-1], self.ways[symbol]))
            self.computed += 1
        self.path = signature
        return answer(self.stack)


def common_prefix(a: str, b: str) -> int:
    """The length of the common prefix, found by halving, as slices compare fast."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie()
    for batch in batches:
        answers = [trie.answer(s) for s in batch.column("signature").to_pylist()]
        audits = pa.array([a for _, a in answers], pa.string())
        costs = pa.array([c for c, _ in answers], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("signature"), batch.column("n"), costs, audits], ["signature", "n", "cost", "audit"])


def solve(signatures: DataFrame) -> DataFrame:
    """signature, n, cost, audit for each row of signatures (signature, n: how many conversations have it)."""
    ranged = signatures.select("signature", "n").repartitionByRange(n_tasks(signatures), "signature").sortWithinPartitions("signature")
    return ranged.mapInArrow(solved, "signature string, n long, cost long, audit string")


def filled(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls filled, and digest, the order of rows of one turn and role."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    return out.withColumn("digest", F.unhex(F.md5("text")))


def fault_of(text: Column) -> Column:
    """b: blank, t: truncated, else empty."""
    bare = F.rtrim(text, F.lit(SPACES))
    return F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(*".!?"), "t").otherwise("")


def facts(rows: DataFrame) -> DataFrame:
    """FACTS: the counts and the signature of each conversation of filled rows. illegal counts neighbours whose roles
    may not follow one another; each row counts for its first fault only."""
    initial = F.substring("role", 1, 1)
    bare = rows.select("conv_id", "turn", "role", "digest", initial.alias("initial"), fault_of(F.col("text")).alias("fault"))
    alike = W.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    seen = bare.repartition(n_tasks(rows), "conv_id").withColumn("seen", F.row_number().over(alike) > 1)
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, held = None, None

        def close() -> None:
            if held is not None:
                low, high, distinct, blank, dup, cut, illegal, _, symbols = held
                gaps = high - low + 1 - distinct if distinct else 0
                done.append((conv, gaps, blank, dup, cut, illegal, symbols.decode()))

        for batch in batches:
            for conv_id, turn, initial, fault, seen in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "seen"))):
                if held is None or conv_id != conv:
                    close()
                    conv, held = conv_id, [None, None, 0, 0, 0, 0, 0, None, bytearray()]
                if turn is not None and turn != held[1]:
                    held[0], held[1] = (turn if held[0] is None else held[0]), turn
                    held[2] += 1
                symbol = initial if initial in ("s", "u", "a") else OTHER
                if fault == "b":
                    held[3] += 1
                    symbol = MUST_GO
                elif seen:
                    held[4] += 1
                    symbol = MUST_GO
                elif fault == "t":
                    held[5] += 1
                    symbol = symbol.upper()
                if held[7] is not None and held[7] + initial not in ("su", "ua", "au"):
                    held[6] += 1
                held[7] = initial
                held[8] += symbol.encode()
            if len(done) >= 1000:
                yield packed(done, FACTS)
                done = []
        close()
        yield packed(done, FACTS)

    return seen.sortWithinPartitions(*order).select("conv_id", "turn", "initial", "fault", "seen").mapInArrow(run, FACTS)


KINDS = {"long": pa.int64(), "string": pa.string()}


def packed(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """A batch of rows of a schema written as for Spark."""
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(columns, kinds)], list(names))


def plan(rows: DataFrame) -> DataFrame:
    """FACTS, cost and audit (the edits' initials in order) for each conversation of rows (conv_id, turn, role, text)."""
    found = stored(facts(filled(rows)), "repair-facts")
    answers = stored(solve(found.groupBy("signature").agg(F.count("*").alias("n"))), "repair-answers")
    return join_spread(found, answers, "signature", "conv_id").select(*found.columns, "cost", "audit")


Edited = tuple[str, str, str]


class Editor:
    """Gives the rows of one conversation as they are after its edits: (role, text, edit's initial)."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, EMPTY

    def inserted(self) -> Iterator[Edited]:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self.state = NEXT[self.state]
            yield ROLES[self.state], "", INSERT

    def edited(self, role: str, text: str) -> Iterator[Edited]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = kept_state(role[:1], self.state)
            yield role, text, KEEP
        elif edit == REROLE:
            self.state = NEXT[self.state]
            yield ROLES[self.state], text, REROLE


def streamed(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of each conversation in order, behind a row (head) with its edits, all in one task's stream."""
    head = plans.select("conv_id", F.lit(True).alias("head"), F.col("audit").alias("text"))
    every = filled(rows).withColumn("head", F.lit(False)).unionByName(head, allowMissingColumns=True)
    order = ["conv_id", F.desc("head"), F.asc_nulls_first("turn"), "role", "digest"]
    return every.repartition(n_tasks(rows), "conv_id").sortWithinPartitions(*order).select("conv_id", "head", "role", "text")


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int | None, Editor, Iterator[Edited]]]:
    """(is it the head, conv_id, editor, rows that come) for each row of the stream, then the last conversation's end."""
    conv, editor = None, None
    for batch in batches:
        for conv_id, head, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if head:
                if editor is not None:
                    yield False, conv, editor, editor.inserted()
                conv, editor = conv_id, Editor(text)
                yield True, conv, editor, iter(())
            else:
                yield False, conv, editor, editor.edited(role, text)
    if editor is not None:
        yield False, conv, editor, editor.inserted()


def repair(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """ROWS: the repaired conversations; place counts from 0, edit is what made the row what it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        place = size = 0
        for head, conv, _, out in conversations_of(batches):
            place = 0 if head else place
            for role, text, edit in out:
                done.append((conv, place, role, text, edit))
                place, size = place + 1, size + len(text)
            if len(done) >= 1000 or size > 1 << 21:
                yield packed(done, ROWS)
                done, size = [], 0
        yield packed(done, ROWS)

    return streamed(rows, plans).mapInArrow(run, ROWS)


def digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id and sha256, the SHA-256 of each repaired conversation's ``role:text``, newline-joined; what repair gives is
    hashed as it comes, without being held."""

    schema = "conv_id long, sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, sha, between = None, None, b""
        for head, conv_id, _, out in conversations_of(batches):
            if head:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha, between = conv_id, hashlib.sha256(), b""
            for role, text, _ in out:
                sha.update(between + f"{role}:{text}".encode())
                between = b"\n"
            if len(done) >= 1000:
                yield packed(done, schema)
                done = []
        if sha is not None:
            done.append((conv, sha.hexdigest()))
        yield packed(done, schema)

    return streamed(rows, plans).mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) damaged by a checksum of conversation and turn: dropped, emptied, without ends of
    sentences, repeated or given to the user, a twentieth each."""
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(full("conv_id"), F.lit(":"), full("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(full("text"), ".!?", "")).otherwise(full("text"))
    role = F.when(kind == 4, "user").otherwise(full("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(given)
    plans = stored(plan(rows), "repair-plans")
    hashed = digests(rows, plans)
    ids = given.select(F.col("conv_id").cast("long").alias("id")).distinct()
    same = lambda df: ids["id"].eqNullSafe(df["conv_id"])
    out = ids.join(plans, same(plans), "left").join(hashed, same(hashed), "left")
    sha = F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), sha)
