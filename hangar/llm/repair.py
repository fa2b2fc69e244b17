"""Conversation structure repair (operator 13).

Method: depth-first branch and bound over edits.  A node is how many rows were
dealt with and what the roles so far ask for next; its children keep, rerole or
delete the next row, or insert a turn.  An explicit stack holds the open nodes,
the most promising child on top.  A bound of what the remaining rows cost at least
(one sweep from the end) cuts off nodes that cannot beat the incumbent (cost,
audit), and a dominance table per node cuts off prefixes that came there cheaper,
or as cheap with a lesser audit.  When the stack is empty the incumbent is proved
to be the cheapest repair, and of those the least audit.

A conversation is searched on one byte per row (role and fault); texts stay in
Spark, and a second pass, which streams rows in order next to their edits, makes
the repaired text's digest.  Rows are sorted and spilled by Spark; equal rows are
found by an aggregate, so a conversation with a third of all rows needs no more
than a byte, and four table entries, for each of them in memory.

Defined cases: null roles and texts are one space (blank), a null conversation is
one of its own, null turns come first and leave no gap; rows with the same turn
come by role and text; repeated rows are duplicates; a role without initial, or
with one other than s, u or a, can't be kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangar.llm.common import ship, staged, table

#: What edits cost; a truncated row that stays adds TRUNCATED.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows whose edits travel together.
CHUNK = 1_000

#: States: nothing yet, after a system turn, after a user's, after an assistant's turn.
EMPTY, SYSTEM, USER, ANSWER = range(4)
_KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ANSWER, "u"): USER, (USER, "a"): ANSWER}
#: What a turn that is reroled or inserted becomes.
_NEXT = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ANSWER), ANSWER: ("user", USER)}
#: A row's fault, by the first that holds; the first two must go.
FAULTS = ("blank", "duplicate", "truncated", "")


class Repair(NamedTuple):
    cost: int
    audit: str


def _row_edits(state: int, initial: str, fault: str) -> list[tuple[int, str, int]]:
    """(cost, edit, next state) of what may become of a row."""
    out = [(DELETE, "D", state)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if (state, initial) in _KEPT:
            out.append((KEEP + more, "K", _KEPT[state, initial]))
        out.append((REROLE + more, "R", _NEXT[state][1]))
    return out


def _moves() -> dict[tuple[int, int], list[tuple[int, str, int]]]:
    return {(state, code): _row_edits(state, initial, fault) for state in range(4)
            for code, (initial, fault) in enumerate((i, f) for i in "sua-" for f in FAULTS)}


#: By state and row code (initial, fault): edits.
MOVES = _moves()


def code_of(initial: Column, fault: Column) -> Column:
    """A row's initial and fault as one number, 0 to 15."""
    at = F.instr(F.lit("sua"), F.when(initial.isin("s", "u", "a"), initial).otherwise("-"))
    return F.when(at > 0, at - 1).otherwise(3) * 4 + fault


def bounds(codes: bytes) -> array:
    """What the rows from each place on cost at least, by state (place * 4 + state).
    At the end a missing answer is inserted (and a question, after a lone system turn)."""
    n = len(codes)
    out = array("q", [0, 2 * INSERT, INSERT, 0]) * (n + 1)
    after = out[4 * n:].tolist()
    for row in range(n - 1, -1, -1):
        own = [min(c + after[s] for c, _, s in MOVES[state, codes[row]]) for state in range(4)]
        # one or two inserted turns lead to any state that can still be reached
        for _ in range(2):
            own = [min(own[s], INSERT + own[_NEXT[s][1]]) for s in range(4)]
        out[4 * row:4 * row + 4] = array("q", own)
        after = own
    return out


def search(codes: bytes) -> Repair:
    """The cheapest repair of a conversation given as row codes; of the cheapest,
    the one with the least audit."""
    n, low = len(codes), bounds(codes)
    incumbent, audit = low[EMPTY] + 1, bytearray()  # any real repair that counts is less
    best = array("q", [1 << 40]) * (4 * (n + 1))    # dominance: cost of the best prefix to a node
    path, same = bytearray(), 0   # same: first edits that path and incumbent share
    stack = [(0, 0, EMPTY, 0, 0)]  # rows dealt with, edits so far, state, cost, last edit
    while stack:
        row, depth, state, cost, edit = stack.pop()
        if depth:
            del path[depth - 1:]
            path.append(edit)
            same = min(same, depth - 1)
        node = 4 * row + state
        floor = cost + low[node]
        if floor > incumbent:
            continue
        if floor == incumbent and same < depth and same < len(audit) and path[same] > audit[same]:
            continue  # as cheap at best, and its audit comes after the incumbent's
        # open nodes of one bound come in the order of their audits, so whoever was here
        # before at this cost had the lesser one
        if best[node] <= cost:
            continue
        best[node] = cost
        if row == n and state in (EMPTY, ANSWER):
            if not audit or (cost, path) < (incumbent, audit):
                incumbent, audit, same = cost, bytearray(path), len(path)
            continue
        children = [(cost + c + low[4 * row + 4 + s], e, row + 1, s, cost + c)
                    for c, e, s in (MOVES[state, codes[row]] if row < n else ())]
        to = _NEXT[state][1]
        children.append((cost + INSERT + low[4 * row + to], "I", row, to, cost + INSERT))
        stack += [(r, depth + 1, s, c, ord(e))
                  for bound, e, r, s, c in sorted(children, reverse=True) if bound <= incumbent]
    return Repair(incumbent, audit.decode())


def by_row(audit: str) -> list[str]:
    """An audit as one piece per row: the inserts before it and its own edit; the
    last piece has the inserts at the end."""
    out, begin = [], 0
    for k, e in enumerate(audit):
        if e != "I":
            out.append(audit[begin:k + 1])
            begin = k + 1
    return [*out, audit[begin:]]


# ---- rows -------------------------------------------------------------------------

def with_places(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) with their place in the conversation, and
    whether their role can't follow the one before."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(order), initial)
    return rows.withColumns({"place": F.row_number().over(order) - 1,
                             "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False))})


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``: the place in ``FAULTS`` of each row's first fault."""
    firsts = (rows.groupBy("conv_id", F.sha2(F.to_json(F.struct("role", "text")), 256).alias("_same"))
              .agg(F.min("place").alias("_place")).select(F.col("conv_id").alias("_conv"), "_place"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return (rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_place")), "left")
            .withColumn("fault", F.when(last == "", 0).when(F.col("_place").isNull(), 1)
                        .when(last.rlike("[^.!?]"), 2).otherwise(3))
            .drop("_conv", "_place"))


def _conversations(batches, columns):
    """(conv_id, row) of sorted rows, streaming."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, chunk, part (edits of ``CHUNK`` rows, one piece each), cost, ends
    (inserts after the last row): the repair of each conversation."""
    ship(rows.sparkSession)

    def solve(batches):
        out: list[tuple] = []

        def close(conv, codes):
            found = search(bytes(codes))
            pieces = by_row(found.audit)
            for k in range(0, len(codes), CHUNK):
                out.append((conv, k // CHUNK, pieces[k:min(k + CHUNK, len(codes))], found.cost, pieces[-1]))

        def flush():
            cols = list(zip(*out)) if out else [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.int64()),
                pa.array(cols[4], pa.string())], names=["conv_id", "chunk", "part", "cost", "ends"])

        now, codes = None, bytearray()
        for conv, code in _conversations(batches, ("conv_id", "code")):
            if codes and conv != now:
                close(now, codes)
                codes = bytearray()
                if len(out) >= 1_000:
                    yield flush()
            now = conv
            codes.append(code)
        if codes:
            close(now, codes)
        yield flush()

    coded = rows.select("conv_id", "place", code_of(F.substring("role", 1, 1), F.col("fault")).alias("code"))
    return coded.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        solve, "conv_id long, chunk long, part array<string>, cost long, ends string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copy; no nulls in
    role and text): gaps, counts of faults and of illegal neighbours, cost, audit and
    the digest of the repaired conversation."""
    rows = staged(with_faults(with_places(rows)), "repair_rows")
    plan = staged(edits(rows), "repair_edits").select(
        F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), "part", "cost", "ends")
    place = F.col("place")
    joined = rows.join(plan, F.col("conv_id").eqNullSafe(F.col("_conv"))
                       & (F.floor(place / CHUNK) == F.col("_chunk")), "left").select(
        "conv_id", "place", "role", "text", "cost", F.element_at("part", (place % CHUNK + 1).cast("int")).alias("piece"),
        F.when(F.col("ends") != "", F.col("ends")).alias("ends"))

    def write(batches):
        out: list[tuple] = []
        now, audit, digest, state, cost, ends = None, [], None, EMPTY, 0, ""

        def put(role, text, to):
            nonlocal state
            digest.update(("\n" if state != EMPTY else "").encode() + f"{role}:{text}".encode())
            state = to

        def insert(k):
            for _ in range(k):
                role, to = _NEXT[state]
                put(role, "", to)

        def close():
            insert(len(ends))
            out.append((now, cost, "".join(audit) + ends, digest.hexdigest()))

        def flush():
            cols = list(zip(*out)) if out else [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["conv_id", "cost", "audit", "repaired_sha256"])

        for conv, role, text, price, piece, tail in _conversations(
                batches, ("conv_id", "role", "text", "cost", "piece", "ends")):
            if digest is None or conv != now:
                if digest is not None:
                    close()
                    if len(out) >= 1_000:
                        yield flush()
                now, audit, digest, state, cost, ends = conv, [], hashlib.sha256(), EMPTY, price, tail or ""
            audit.append(piece)
            insert(len(piece) - 1)
            if piece[-1] == "K":
                put(role, text, _KEPT[state, role[:1]])
            elif piece[-1] == "R":
                put(_NEXT[state][0], text, _NEXT[state][1])
        if digest is not None:
            close()
        yield flush()

    written = joined.repartition("conv_id").sortWithinPartitions("conv_id", "place").drop("place").mapInArrow(
        write, "conv_id long, cost long, audit string, repaired_sha256 string")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == k).alias(FAULTS[k]) for k in range(3)],
        F.count_if("illegal").alias("illegal"))
    return counts.withColumnRenamed("conv_id", "_conv").join(
        written, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


# ---- query ------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to conversations (conv_id, turn, role, text); copy numbers
    a row's repeats."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    return (rows.withColumn("_kind", kind).where("_kind <> 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(space("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(space("text"), "[.!?]", ""))
        .otherwise(space("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")))


def op13_conversation_repair(spark, sf_dir):
    """Faults, cheapest repair and its digest of every conversation after the damage."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    found = repair(damaged(rows))
    own = found.select(F.col("conv_id").alias("_conv"), *[c for c in found.columns if c != "conv_id"],
                       F.lit(True).alias("_found"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("conv_id").distinct().join(own, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
