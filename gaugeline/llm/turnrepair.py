"""Repair of conversation structure by a grammar-compressed dynamic programme.

Each row of a conversation gets a fault (blank, duplicate, truncated, or none) and so becomes one of nine symbols: the
role's kind (system, user, assistant, other), truncated or not; or a row that must go. The cheapest edits
that bring the roles into the form `(s?(ua)+)?` are a shortest path through four states (nothing
yet, after system, after user, after assistant), so a symbol is a 4 x 4 matrix over (cost, audit) where
"times" adds costs and joins audits and "plus" takes the cheaper, then the ASCII-least one. A text of equal
cost never begins with another one (the longer would cost one more insertion), so this is a semiring and
any bracketing gives the same result.

1. `symbol_strings`: rows in order become symbol strings, one piece per `PIECE` rows. Copies of a row are counted before
   anything is sorted, and first occurrences are a minimum per (conversation, digest), so no row is held to look for
   repeats; the texts themselves are shuffled twice, to be counted and to be written out.
2. `learn_grammar`: Re-Pair over all conversations at once. Each round counts neighbouring symbols in one
   aggregate and replaces the most frequent pairs that do not compete, by new symbols; every round's
   strings are staged. A string repeated 2^k times shrinks in k rounds.
3. `evaluate`: one matrix per rule, bottom-up, shared by all conversations. Audits are ropes: a node names its halves,
   its length and a hash, and two ropes are compared by going down where their hashes differ.
4. `repair`: rows stream through tasks in order, each conversation's compressed string first; its matrices
   are multiplied in a balanced tree, the rope is written out, and the edits are applied row by row to a running digest.

A conversation's own result holds one letter per row, so its letters pass through one task; its texts are never held
together. The grammar's size is bounded (`max_rules`), which changes the work, never the result.

Costs: keep 0, change the role 1, delete 2 (the only choice for blank and duplicate rows), insert an empty turn 5, and 5 for each
truncated row not deleted.

Defined cases: null roles and texts count as one space, null turns come first and are ignored by `gaps`, null
conversations are one conversation; rows of one turn are ordered by role and text; a role that begins with none of s, u,
a never fits; an empty table gives an empty result; further columns are left alone and not returned. Conversation
and turn numbers are cast to long.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter, OrderedDict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import importable, stage
from .common import named
from .rows import by_batch

VISIBLE = r"[^\x20\x09-\x0D]"
KINDS = "sua?"  # role kinds; symbol = kind + 4 if truncated; GONE: must be deleted
GONE = 8
SYMBOLS = 9
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEXT = {START: ((SYSTEM, "s"), (USER, "u")), SYSTEM: ((USER, "u"),), USER: ((ASSISTANT, "a"),), ASSISTANT: ((USER, "u"),)}
NAMES = {"u": "user", "a": "assistant"}
PIECE = 4096
MODULUS, RADIX = (1 << 61) - 1, 1_000_003
SOLVED = 4000  # matrices of whole strings that a task remembers


# --- ropes and matrices ---------------------------------------------------------------------------------------

class Rope:
    """An immutable text: a leaf, or two ropes joined."""

    __slots__ = ("left", "right", "text", "size", "power", "hash")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.power, self.hash = len(text), pow(RADIX, len(text), MODULUS), 0
            for c in text:
                self.hash = (self.hash * RADIX + ord(c)) % MODULUS
        else:
            self.size, self.power = left.size + right.size, left.power * right.power % MODULUS
            self.hash = (left.hash * right.power + right.hash) % MODULUS

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope(left=self, right=other)

    def __str__(self) -> str:
        parts, open_ = [], [self]
        while open_:
            node = open_.pop()
            if node.left is None:
                parts.append(node.text)
            else:
                open_ += [node.right, node.left]
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        """Order of the texts, down to the first place where the hashes differ."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a.size == b.size and a.hash == b.hash:
                continue
            if a.left is None and b.left is None:
                short = min(a.size, b.size)
                if a.text[:short] != b.text[:short]:
                    return a.text < b.text
                if a.size > short:
                    mine.append(Rope(a.text[short:]))
                if b.size > short:
                    theirs.append(Rope(b.text[short:]))
            elif a.left is not None and (b.left is None or a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                mine.append(a)
                theirs += [b.right, b.left]
        return bool(theirs) and not mine


Matrix = list[list[tuple[int, Rope] | None]]


def times(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product: the cheapest way through both, ties by the least audit."""
    made: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        for j in STATES:
            ways = [(x[i][k][0] + y[k][j][0], k) for k in STATES if x[i][k] and y[k][j]]
            if ways:
                cost = min(ways)[0]
                made[i][j] = (cost, min(x[i][k][1] + y[k][j][1] for c, k in ways if c == cost))
    return made


def _inserts() -> Matrix:
    """Any number of insertions, none included."""
    made: Matrix = [[(0, Rope()) if i == j else None for j in STATES] for i in STATES]
    for i in STATES:
        reached = {i}
        frontier = [(0, i)]
        while frontier:
            cost, state = heapq.heappop(frontier)
            for target, letter in NEXT[state]:
                if letter in NAMES and target not in reached:
                    reached.add(target)
                    made[i][target] = (cost + INSERT, Rope("I" * (cost // INSERT + 1)))
                    heapq.heappush(frontier, (cost + INSERT, target))
    return made


INSERTS = _inserts()


def symbol_matrix(symbol: int) -> Matrix:
    """Insertions, then the row's own edit."""
    edit: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        edit[i][i] = (DELETE, Rope("D"))
        if symbol != GONE:
            for target, letter in NEXT[i]:
                extra = TRUNCATED if symbol >= 4 else 0
                if KINDS[symbol % 4] == letter:
                    edit[i][target] = (extra, Rope("K"))
                elif letter in NAMES:
                    edit[i][target] = (REROLE + extra, Rope("R"))
    return times(INSERTS, edit)


def evaluate(rules: Sequence[tuple[int, int]]) -> list[Matrix]:
    """Matrices of all symbols and rules; rule n stands for a pair of symbols or earlier rules."""
    made = [symbol_matrix(s) for s in range(SYMBOLS)]
    for a, b in rules:
        made.append(times(made[a], made[b]))
    return made


def product(sequence: Sequence[int], matrices: Sequence[Matrix]) -> Matrix:
    """Product in a balanced tree, so that ropes stay shallow."""
    level = [matrices[s] for s in sequence]
    while len(level) > 1:
        joined = [times(x, y) for x, y in zip(level[::2], level[1::2])]
        level = joined + level[len(joined) * 2:]
    return level[0] if level else INSERTS


def cheapest(total: Matrix) -> tuple[int, str]:
    """Cost and audit from the start to an allowed end."""
    ended = times(total, INSERTS)
    cost, audit = min(ended[START][s] for s in (START, ASSISTANT) if ended[START][s])
    return cost, str(audit)


# --- Re-Pair --------------------------------------------------------------------------------------------------

def replaced(sequence: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """Left-to-right replacement of pairs by their symbols."""
    out, at, last = [], 0, len(sequence) - 1
    while at <= last:
        rule = pairs.get((sequence[at], sequence[at + 1])) if at < last else None
        out.append(sequence[at] if rule is None else rule)
        at += 1 if rule is None else 2
    return out


def _pair_counts(strings: DataFrame) -> DataFrame:
    def make(batch: dict[str, list]) -> dict[str, list]:
        found = Counter(p for s in batch["symbols"] for p in zip(s, s[1:]))
        return {"a": [a for a, _ in found], "b": [b for _, b in found], "n": list(found.values())}
    return by_batch(strings.select("symbols"), make, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def learn_grammar(
    strings: DataFrame, max_rules: int = 1024, per_round: int = 64, rounds: int = 8, least: int = 4,
) -> tuple[list[tuple[int, int]], DataFrame]:
    """(rules, the strings written with them). `strings` has `symbols array<int>`, other columns stay.

    A round takes the most frequent pairs of which none begins with a symbol that another one ends
    with, so that it does not matter which is replaced first.
    """
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        room = min(per_round, max_rules - len(rules))
        if room <= 0:
            break
        top = _pair_counts(strings).where(F.col("n") >= least).orderBy(F.desc("n"), "a", "b").limit(4 * per_round).collect()
        pairs: dict[tuple[int, int], int] = {}
        firsts, seconds = set(), set()
        for row in top:
            a, b = row["a"], row["b"]
            if len(pairs) < room and a not in seconds and b not in firsts:
                pairs[a, b] = SYMBOLS + len(rules) + len(pairs)
                firsts.add(a)
                seconds.add(b)
        if not pairs:
            break
        rules += pairs

        def make(batch: dict[str, list], pairs=pairs) -> dict[str, list]:
            return {**batch, "symbols": [replaced(s, pairs) for s in batch["symbols"]]}
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in strings.schema)
        strings = stage(by_batch(strings, make, ddl), "grammar")
    return rules, strings


# --- rows -----------------------------------------------------------------------------------------------------

def distinct_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Staged `(conv, turn, role, text, copies, fault, said)`: equal rows counted, with the fault the text has by itself and a digest."""
    rows = turns.select(
        named(conv).cast("long").alias("conv"), named(turn).cast("long").alias("turn"),
        F.coalesce(named(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(named(text).cast("string"), F.lit(" ")).alias("text"))
    merged = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    fault = F.when(~F.col("text").rlike(VISIBLE), "blank").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("none")
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    return stage(merged.select("*", fault.alias("fault"), said.alias("said")), "turns")


def _in_order(rows: DataFrame) -> DataFrame:
    """`(conv, turn, role, rank, copies, fault, first)` of `distinct_rows`, without the texts.

    `first`: the row is the first of its role and text in the conversation. `rank` orders the rows of one turn and role by
    text; texts are read only where a turn has several rows.
    """
    slim = rows.select("conv", "turn", "role", "said", "copies", "fault")
    firsts = slim.groupBy("conv", "said").agg(
        F.when(F.count("*") == F.count("turn"), F.min("turn")).alias("_turn"), F.count("*").alias("_n")).where("_n > 1")
    firsts = firsts.select(F.col("conv").alias("_conv"), F.col("said").alias("_said"), "_turn", "_n")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    marked = slim.join(firsts, same, "left").select(
        *slim.columns, (F.col("_n").isNull() | F.col("turn").eqNullSafe(F.col("_turn"))).alias("first"))
    several = slim.groupBy("conv", "turn").agg(F.count("*").alias("_m")).where("_m > 1").select(
        F.col("conv").alias("_conv"), F.col("turn").alias("_turn"))
    here = F.col("conv").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn"))
    tied = rows.select("conv", "turn", "role", "text", "said").join(several, here, "left_semi")
    ranks = tied.select(
        F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("said").alias("_said"),
        F.row_number().over(Window.partitionBy("conv", "turn").orderBy("role", "text")).alias("_rank"))
    return marked.join(ranks, here & (F.col("said") == F.col("_said")), "left").select(
        "conv", "turn", "role", F.coalesce("_rank", F.lit(0)).alias("rank"), "copies", "fault", "first")


def _symbol() -> Column:
    """Symbol of a row's first copy."""
    kind = F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit(KINDS[:3]), F.substring("role", 1, 1)))
    known = F.when(kind == 0, 3).otherwise(kind - 1)
    return F.when((F.col("fault") == "blank") | ~F.col("first"), GONE).otherwise(
        known + F.when(F.col("fault") == "truncated", 4).otherwise(0)).cast("int")


class _Counts:
    """Faults, gaps and illegal neighbours of one conversation while its rows pass by."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, row: dict) -> None:
        initial, copies = row["initial"], row["copies"]
        if row["fault"] == "blank":
            self.blank += copies
        else:
            self.duplicate += copies - row["first"]
            self.truncated += row["first"] and row["fault"] == "truncated"
        self.illegal += copies - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.last = initial
        if row["turn"] is not None:  # rows come in order of turns
            self.turns += row["turn"] != self.high
            self.low, self.high = row["turn"] if self.low is None else self.low, row["turn"]

    def values(self) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]


PIECES = "conv long, piece long, symbols array<int>, counts array<long>"


def symbol_strings(rows: DataFrame) -> DataFrame:
    """`(conv, piece, symbols, counts)` of `distinct_rows`: strings in pieces of PIECE rows; the last piece has the conversation's counts."""
    importable(rows.sparkSession)
    order = ["conv", "turn", "role", "rank"]
    slim = _in_order(rows).repartition("conv").sortWithinPartitions(*order).select(
        "conv", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "fault", "first", _symbol().alias("symbol"))
    schema = to_arrow_schema(StructType.fromDDL(PIECES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, conv, piece, held, counts = [], None, 0, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if counts is None or row["conv"] != conv:
                    if counts is not None:
                        made.append((conv, piece, held, counts.values()))
                    conv, piece, held, counts = row["conv"], 0, [], _Counts()
                counts.add(row)
                symbol = row["symbol"]
                for _ in range(row["copies"]):
                    if len(held) >= PIECE:
                        made.append((conv, piece, held, None))
                        held, piece = [], piece + 1
                        if len(made) >= 64:
                            yield _batch(made, schema)
                    held.append(symbol)
                    symbol = GONE
            yield _batch(made, schema)
        if counts is not None:
            made.append((conv, piece, held, counts.values()))
        yield _batch(made, schema)
    return slim.mapInArrow(cut, PIECES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The rows gathered so far as a batch; the list is emptied."""
    columns = zip(*rows) if rows else [[] for _ in schema]
    made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    rows.clear()
    return made


RESULT = ("conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
LEGAL = {"su", "ua", "au"}


class _Conversation:
    """One conversation in the last pass: its matrices come first, then its rows in order."""

    def __init__(self, conv: int | None):
        self.conv, self.total, self.counts, self.audit, self.cost = conv, None, [], None, 0
        self.at, self.state, self.lines, self.digest = 0, START, 0, hashlib.sha256()

    def add_piece(self, piece: Matrix, counts: list[int] | None) -> None:
        self.total = piece if self.total is None else times(self.total, piece)
        self.counts = counts or self.counts

    def _emit(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _turn(self) -> str:
        """The role that must come next."""
        self.state = ASSISTANT if self.state == USER else USER
        return NAMES["a" if self.state == ASSISTANT else "u"]

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._emit(self._turn(), "")
            self.at += 1

    def add_row(self, role: str, text: str) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest(self.total)
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            if role[:1] == "s":
                self.state = SYSTEM
            else:
                self._turn()
            self._emit(role, text)
        elif edit == "R":
            self._emit(self._turn(), text)

    def result(self) -> tuple:
        self._inserted()
        return (self.conv, *self.counts, self.cost, self.audit, self.digest.hexdigest())


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **grammar) -> DataFrame:
    """Per conversation with rows: `conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`."""
    rows = distinct_rows(turns, conv, turn, role, text)
    rules, strings = learn_grammar(stage(symbol_strings(rows), "symbols"), **grammar)
    nothing = F.lit(None)
    pieces = strings.select(
        "conv", F.lit(0).alias("kind"), "piece", nothing.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        nothing.cast("long").alias("copies"), "symbols", "counts")
    bodies = rows.select(
        "conv", F.lit(1).alias("kind"), nothing.cast("long").alias("piece"), "turn", "role", "text", "copies",
        nothing.cast("array<int>").alias("symbols"), nothing.cast("array<bigint>").alias("counts"))
    ordered = pieces.unionByName(bodies).repartition("conv").sortWithinPartitions("conv", "kind", "piece", "turn", "role", "text")
    importable(turns.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices, known, done = evaluate(rules), OrderedDict(), []
        current: _Conversation | None = None

        def solved(sequence: tuple[int, ...]) -> Matrix:
            if sequence not in known:
                if len(known) >= SOLVED:
                    known.popitem(last=False)
                known[sequence] = product(sequence, matrices)
            return known[sequence]
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                for row in batch.slice(first, 500).to_pylist():
                    if current is None or row["conv"] != current.conv:
                        if current is not None:
                            done.append(current.result())
                        current = _Conversation(row["conv"])
                    if row["kind"] == 0:
                        current.add_piece(solved(tuple(row["symbols"])), row["counts"])
                        continue
                    for _ in range(row["copies"]):
                        current.add_row(row["role"], row["text"])
                yield _batch(done, schema)
        if current is not None:
            done.append(current.result())
        yield _batch(done, schema)
    return ordered.mapInArrow(run, RESULT)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`(conv_id, turn, role, text)` with the faults that `crc32("conv:turn") % 20` asks for; nulls become one space there and in role and text."""
    key = F.concat_ws(":", *[F.coalesce(named(c).cast("long").cast("string"), F.lit(" ")) for c in (conv, turn)])
    rows = turns.select(
        named(conv).cast("long").alias("conv_id"), named(turn).cast("long").alias("turn"), F.coalesce(named(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(named(text).cast("string"), F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("_kind"))
    kind = F.col("_kind")
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    made = rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"))
    return made.drop("_copy")


def with_absent(found: DataFrame, turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """`found` with zeros and empty texts for conversations of `turns` that it lacks."""
    every = turns.select(named(conv).cast("long").alias("_every")).distinct()
    columns = [c for c in found.columns if c != "conv"]
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return every.join(found, F.col("_every").eqNullSafe(F.col("conv")), "left").select(
        F.col("_every").alias(conv), *[F.coalesce(c, F.lit(empty.get(c, 0))).alias(c) for c in columns])
