"""Repair of conversations: the cheapest edits that give an optional system turn and then pairs
of user and assistant.

Every turn is kept (K), given the role user or assistant (R, costs 2) or deleted (D, 3; blank
turns and repeats of an earlier turn must be), and empty turns of user or assistant may be
inserted (I, 2).  A truncated turn that stays costs 1.  The audit is the list of edits.  Of the
cheapest audits the least one in ASCII order is taken.

A dynamic program walks a conversation's turns with four states (nothing yet, system, user,
assistant).  Each state's best audit is a node that links to the one it extends, so audits share
their prefixes.  Nodes have binary-lifting ancestors and a rolling hash of the way to them: a tie
of two audits is resolved by searching the longest prefix with equal hashes, and what follows it.
That the prefix is one and the same node is checked; if it is not, the hashes collided, and the
audits are compared step by step.  Two audits of equal cost, turns and state are never a prefix
of each other, so the lesser stays the lesser, whatever follows.

Conversations have no bound, so turns are taken in blocks of about a thousand: a block gives cost
and order of the best audits between any two states, and blocks of blocks are solved in the same
way until one is left; then states are handed down again.  No task and no row holds more than a
block, but for what a report says of a whole conversation: its audit is one text, and its hash is
a chain, for which the turns stream through one task in order.

Nulls: a null role or text is one space, a null conversation is a conversation, null turns
come first.  Turns with equal numbers are ordered by role, then by a hash of the text.  Repeated
rows are turns of their own (and duplicates).  Empty texts are blank, texts have no bound.  An
empty table gives no rows.  Columns beside the named ones do not take part.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.ranks import ranked
from quoteloom.shared import Landing

# Turns (or blocks) of a block.
BLOCK = 1024

SPACE = " \t\n\x0b\f\r"
FAULTS = ["none", "truncated", "blank", "duplicate"]

# The states, the prices of edits, and the edits that end a conversation properly.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
PRICES = {"K": 0, "R": 2, "D": 3, "I": 2}
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FILLED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDINGS = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

BASE, MODULUS = 1_000_003, 2**61 - 1


def turn_moves(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, edits) of one turn, inserts before it included.

    ``code`` is the turn's initial and the number of its fault.  Two inserts lead back to the
    same state at most, so more are never cheaper.
    """
    initial, fault = code[0], FAULTS[int(code[1])]
    extra = int(fault == "truncated")
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in STATES:
        at, inserts = before, ""
        for _ in range(3):
            options = [("D", at, 0)]
            if fault in ("none", "truncated"):
                options.append(("R", FILLED[at], extra))
                if at in KEPT.get(initial, {}):
                    options.append(("K", KEPT[initial][at], extra))
            for edit, after, more in options:
                found = (PRICES["I"] * len(inserts) + PRICES[edit] + more, inserts + edit)
                best[before, after] = min(best.get((before, after), found), found)
            at, inserts = FILLED[at], inserts + "I"
    return best


def ordered_moves(best: dict[tuple[int, int], tuple[int, str]]) -> list[list[tuple[int, int, int]]]:
    """For each state: (state after, cost, place of its edits among those from this state)."""
    moves = []
    for before in STATES:
        found = [(text, after, cost) for (b, after), (cost, text) in best.items() if b == before]
        moves.append([(after, cost, place) for place, (text, after, cost) in enumerate(sorted(found))])
    return moves


class Audits:
    """Audits as linked nodes, each with its ancestors 1, 2, 4, .. steps back and a hash."""

    def __init__(self):
        self.symbols, self.states, self.hashes, self.ancestors = [-1], [-1], [0], [()]

    def extend(self, node: int, symbol: int, state: int) -> int:
        jumps = [node]
        while len(jumps) <= len(self.ancestors[jumps[-1]]):
            jumps.append(self.ancestors[jumps[-1]][len(jumps) - 1])
        self.symbols.append(symbol)
        self.states.append(state)
        self.hashes.append((self.hashes[node] * BASE + symbol + 1) % MODULUS)
        self.ancestors.append(tuple(jumps))
        return len(self.symbols) - 1

    def less(self, a: int, b: int) -> bool:
        """Whether the audit of ``a`` comes before that of ``b``; both are equally long."""
        if a == b:
            return False
        x, y = a, b
        for step in reversed(range(len(self.ancestors[x]))):
            if step < len(self.ancestors[x]):
                up, across = self.ancestors[x][step], self.ancestors[y][step]
                if self.hashes[up] != self.hashes[across]:
                    x, y = up, across
        if self.ancestors[x][0] != self.ancestors[y][0]:
            # equal hashes of different audits: go back from the ends
            x, y = a, b
            while self.ancestors[x][0] != self.ancestors[y][0]:
                x, y = self.ancestors[x][0], self.ancestors[y][0]
        return self.symbols[x] < self.symbols[y]

    def path(self, node: int) -> str:
        found = []
        while node:
            found.append(str(self.states[node]))
            node = self.ancestors[node][0]
        return "".join(reversed(found))


def solve(elements: list, entry: int) -> dict[int, tuple[int, int, str]]:
    """State after -> (cost, place among these, states after each element), from state ``entry``."""
    audits = Audits()
    at = {entry: (0, 0)}
    for moves in elements:
        best: dict[int, tuple[int, int, int]] = {}
        for state, (cost, node) in at.items():
            for after, price, symbol in moves[state]:
                new = (cost + price, node, symbol)
                old = best.get(after)
                if old is not None and old[0] <= new[0]:
                    if old[0] < new[0] or (symbol >= old[2] if node == old[1] else audits.less(old[1], node)):
                        continue
                best[after] = new
        at = {after: (cost, audits.extend(node, symbol, after)) for after, (cost, node, symbol) in best.items()}
    by_audit = functools.cmp_to_key(lambda a, b: -1 if audits.less(at[a][1], at[b][1]) else 1)
    return {
        state: (at[state][0], place, audits.path(at[state][1]))
        for place, state in enumerate(sorted(at, key=by_audit))
    }


# Costs, places and paths of a block are lists over (state before, state after).
SOLVED = "costs array<bigint>, places array<int>, paths array<string>"
PAIRS = len(STATES) ** 2


def _solved(elements: list, first: bool) -> dict:
    costs, places, paths = [None] * PAIRS, [None] * PAIRS, [None] * PAIRS
    for entry in [NOTHING] if first else STATES:
        for after, found in solve(elements, entry).items():
            at = entry * len(STATES) + after
            costs[at], places[at], paths[at] = found
    return {"costs": costs, "places": places, "paths": paths}


def _few(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[list[dict]]:
    """The batches' rows, some blocks at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pylist()


def _solve_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    moves = functools.cache(lambda code: ordered_moves(turn_moves(code)))

    def solved(row):
        codes = row["codes"]
        elements = [moves(codes[i : i + 2]) for i in range(0, len(codes), 2)]
        return row | _solved(elements, row["block"] == 0)

    for rows in _few(batches):
        yield pa.RecordBatch.from_pylist([solved(r) for r in rows], schema=BLOCKS)


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def moves(part, before):
        first = before * len(STATES)
        found = zip(STATES, part["costs"][first:], part["places"][first:])
        return [move for move in found if move[1] is not None]

    def solved(row):
        elements = [[moves(part, before) for before in STATES] for part in row.pop("parts")]
        return row | _solved(elements, row["block"] == 0)

    for rows in _few(batches):
        yield pa.RecordBatch.from_pylist([solved(r) for r in rows], schema=UPPER)


UPPER = pa.schema(
    [
        ("key", pa.string()),
        ("block", pa.int64()),
        ("costs", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int32())),
        ("paths", pa.list_(pa.string())),
    ]
)
BLOCKS = pa.schema([UPPER.field(0), UPPER.field(1), ("codes", pa.string()), ("last", pa.bool_()), *list(UPPER)[2:]])


def _spell(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """The edits of each turn, from the states before and after it."""
    schema = pa.schema(
        [
            ("key", pa.string()),
            ("pos", pa.int64()),
            ("fault", pa.string()),
            ("edits", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())]))),
        ]
    )
    moves = functools.cache(turn_moves)
    for rows in _few(batches):
        found = []
        for row in rows:
            codes, states, before = row["codes"], row["states"], row["entry"]
            for i, after in enumerate(map(int, states)):
                code = codes[2 * i : 2 * i + 2]
                text = moves(code)[before, after][1]
                if row["last"] and i == len(states) - 1:
                    text += ENDINGS[after]
                edits, at = [], before
                for edit in text:
                    role = None
                    if edit in "IR":
                        at = FILLED[at]
                        role = "user" if at == USER else "assistant"
                    elif edit == "K":
                        at = KEPT[code[0]][at]
                    edits.append({"edit": edit, "role": role})
                fault = FAULTS[int(code[1])]
                found.append(
                    {
                        "key": row["key"],
                        "pos": row["block"] * block + i,
                        "fault": fault if fault != "none" else None,
                        "edits": edits,
                    }
                )
                before = after
        yield pa.RecordBatch.from_pylist(found, schema=schema)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("-")


def _decide(codes: DataFrame, block: int, landing: Landing) -> DataFrame:
    """key, pos, fault, edits of every turn; ``codes`` has key, pos, size and code."""
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda t: t["code"]), "")
    blocks = (
        codes.groupBy("key", F.expr(f"pos div {block}").alias("block"))
        .agg(spelled.alias("codes"), (F.max("pos") == F.max("size") - 1).alias("last"))
        .mapInArrow(_solve_turns, f"key string, block bigint, codes string, last boolean, {SOLVED}")
    )
    levels = [landing.land(blocks, "dialogue")]
    while levels[-1].agg(F.max("block")).first()[0] or 0:
        parts = F.array_sort(F.collect_list(F.struct("block", "costs", "places")))
        above = levels[-1].groupBy("key", F.expr(f"block div {block}").alias("upper")).agg(parts.alias("parts"))
        above = above.withColumnRenamed("upper", "block").mapInArrow(
            _solve_blocks, f"key string, block bigint, {SOLVED}"
        )
        levels.append(landing.land(above, "dialogue"))

    # the last state of a conversation: the cheapest with what has to be added, the least audit of those
    endings = [
        F.when(
            F.col("costs")[after].isNotNull(),
            F.struct(
                (F.col("costs")[after] + len(ENDINGS[after]) * PRICES["I"]).alias("cost"),
                F.col("places")[after].alias("place"),
                F.lit(after).alias("after"),
            ),
        )
        for after in STATES
    ]
    chosen = levels[-1].withColumns({"entry": F.lit(NOTHING), "after": F.array_min(F.array(*endings))["after"]})
    path = F.col("paths")[F.col("entry") * len(STATES) + F.col("after")]
    for below in reversed(levels[:-1]):
        steps = F.transform(
            F.sequence(F.lit(1), F.length("path")),
            lambda i: F.struct(
                (F.col("block") * block + i - 1).alias("block"),
                F.when(i == 1, F.col("entry")).otherwise(F.substring("path", i - 1, F.lit(1)).cast("int")).alias("entry"),
                F.substring("path", i, F.lit(1)).cast("int").alias("after"),
            ),
        )
        handed = chosen.withColumn("path", path).select("key", F.inline(steps))
        chosen = below.join(handed, ["key", "block"])
    decided = chosen.select("key", "block", "codes", "last", "entry", path.alias("states"))
    return decided.mapInArrow(
        lambda batches: _spell(batches, block),
        "key string, pos bigint, fault string, edits array<struct<edit:string,role:string>>",
    )


def repair(
    turns: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row for each edit: key, conversation, pos, step, turn, old_role, fault, edit, role, text.

    ``key`` tells conversations apart, and (pos, step) is the order of a conversation's edits:
    ``pos`` numbers its turns, ``step`` the edits at a turn, inserts included.  ``role`` and
    ``text`` are those of the repaired conversation, null for a deleted turn; ``turn``,
    ``old_role`` and ``fault`` (the first of blank, duplicate, truncated) belong to the turn and
    are null for an insert.  The repaired conversations are the rows with a role.
    """
    landing, rows_landing, kept = (Landing(turns.sparkSession) for _ in range(3))
    roles = F.coalesce(F.col(f"`{role}`"), F.lit(" "))
    texts = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    rows = turns.select(
        conversation_key(F.col(f"`{conversation}`")).alias("key"),
        F.col(f"`{conversation}`").alias("conversation"),
        F.col(f"`{turn}`").alias("turn"),
        roles.alias("old_role"),
        texts.alias("text"),
        F.unhex(F.sha2(texts, 256)).alias("_digest"),
        F.monotonically_increasing_id().alias("_salt"),
    )
    rows = ranked(rows, "key", ["turn", "old_role", "_digest", "_salt"], rows_landing)
    # only what occurs twice travels to the turns
    same = rows.groupBy("key", "old_role", "_digest").agg(F.min("pos").alias("_first"), F.count("*").alias("_n"))
    same = same.where("_n > 1").drop("_n")
    bare = F.rtrim("text", F.lit(SPACE))
    marked = rows.join(same, ["key", "old_role", "_digest"], "left")
    fault = (
        F.when(bare == "", "2")
        .when(F.col("pos") > F.col("_first"), "3")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "1")
        .otherwise("0")
    )
    codes = marked.select("key", "pos", "size", F.concat(_initial(F.col("old_role")), fault).alias("code"))
    decided = _decide(codes, block, landing)
    joined = rows.join(decided, ["key", "pos"])
    own = ~F.col("_edit.edit").isin("I")
    edits = joined.select(
        "key", "conversation", "pos", "turn", "old_role", "fault", "text", F.posexplode("edits").alias("step", "_edit")
    ).select(
        "key",
        "conversation",
        "pos",
        "step",
        F.when(own, F.col("turn")).alias("turn"),
        F.when(own, F.col("old_role")).alias("old_role"),
        F.when(own, F.col("fault")).alias("fault"),
        F.col("_edit.edit").alias("edit"),
        F.when(F.col("_edit.edit") == "K", F.col("old_role")).otherwise(F.col("_edit.role")).alias("role"),
        F.when(F.col("_edit.edit").isin("K", "R"), F.col("text")).when(~own, "").alias("text"),
    )
    edits = kept.land(edits, "edits")
    landing.clear()
    rows_landing.clear()
    return edits


def conversation_key(conversation: Column) -> Column:
    """A text for each conversation, for the null one too."""
    return F.coalesce(F.concat(F.lit("="), conversation.cast("string")), F.lit(""))


REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)
LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is known of a conversation while its edits stream by."""

    def __init__(self):
        self.faults = dict.fromkeys(FAULTS, 0)
        self.low = self.high = self.last_turn = None
        self.distinct = self.illegal = self.cost = 0
        self.audit, self.initial = [], None
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, turn, old_role, fault, edit, role, text) -> None:
        self.audit.append(edit)
        self.cost += PRICES[edit] + (fault == "truncated" and edit != "D")
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None:
                self.distinct += turn != self.last_turn
                self.low = turn if self.low is None else self.low
                self.high = self.last_turn = turn
            if self.initial is not None:
                self.illegal += self.initial + old_role[:1] not in LEGAL
            self.initial = old_role[:1]
        if edit != "D":
            self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
            self.lines += 1

    def row(self) -> list:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, 2**63 - 1)
        faults = [self.faults[f] for f in ("blank", "duplicate", "truncated")]
        return [gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()]


def report(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each of ``conversations`` (one column, may repeat), those without edits included.

    Gaps in the turn numbers, turns by their first fault, adjacent roles out of order (before the
    repair), cost, audit, and the SHA-256 of the repaired ``role:text`` lines.
    """
    name = conversations.columns[0]
    id = F.col(f"`{name}`")
    heads = conversations.select(conversation_key(id).alias("key"), id.alias("conversation")).distinct()
    columns = ["key", "pos", "step", "turn", "old_role", "fault", "edit", "role", "text"]
    typed = {f.name: f.dataType for f in edits.schema}
    heads = heads.select(
        "conversation",
        "key",
        F.lit(-1).cast("bigint").alias("pos"),
        F.lit(0).alias("step"),
        *[F.lit(None).cast(typed[c]).alias(c) for c in columns[3:]],
    )
    rows = heads.unionByName(edits.select(F.lit(None).cast(heads.schema["conversation"].dataType).alias("conversation"), *columns))
    out = f"conversation {heads.schema['conversation'].dataType.simpleString()}, {REPORT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, found, schema = None, None, None
        done: list[list] = []

        def pack():
            arrays = [pa.array([r[i] for r in done], t) for i, t in enumerate(schema)]
            return pa.RecordBatch.from_arrays(arrays, names)

        names = ["conversation", *[c.split()[0] for c in REPORT.split(", ")]]
        for batch in batches:
            if schema is None:
                schema = [batch.schema.field("conversation").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            values = [batch.column(c).to_pylist() for c in ("conversation", *columns[1:])]
            for conversation, pos, _, *edit in zip(*values):
                if pos < 0:
                    if found:
                        done.append([head, *found.row()])
                    head, found = conversation, _Conversation()
                    if len(done) >= 1000:
                        yield pack()
                        done.clear()
                else:
                    found.add(*edit)
        if found:
            done.append([head, *found.row()])
            yield pack()

    # a conversation's rows follow its head, in order, and are not held
    streamed = rows.repartition("key").sortWithinPartitions("key", "pos", "step")
    return streamed.mapInArrow(run, out).withColumnRenamed("conversation", name)
