"""Conversation structure repair: cheapest edits to ``(s?(ua)+)?`` by Four-Russians block tables.

Rows become symbols (the role's initial and the row's fault). The cost to go from each of the four states of the wanted
pattern is a vector; less its least entry there are few of them, so the step over every block of ``BLOCK`` symbols is
computed once for every vector (``Blocks``) and a conversation is worked through from its end by look-ups. The edits
are read from its start: a block is expanded backward into the vectors between its rows, and of the edits that keep the
cheapest cost the first in ASCII order is taken, which gives the least string of initials among all cheapest ones.

A conversation may hold any share of the rows. Rows are numbered by a range partitioning of (conversation, turn, ...)
that can cut anywhere; symbols are grouped in segments of ``SEGMENT`` rows; the costs of a conversation's segments are
combined as 4 x 4 matrices, one small row each, streamed. Only the hash of the repaired texts needs a whole
conversation in one order: its rows are streamed through one hash, never held together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared
from foliospark.operators.tables import union_by

BLOCK, SEGMENT_BITS = 4, 16
START, SYSTEM, USER, ASSISTANT = range(4)              # states of the pattern, by the last initial
INSERTED = (USER, USER, ASSISTANT, USER)               # state behind an inserted or renamed row
# State behind a kept row by initial (u, a, s, other); -1 where the pattern does not allow it.
KEPT = ((USER, -1, SYSTEM, -1), (USER, -1, -1, -1), (-1, ASSISTANT, -1, -1), (USER, -1, -1, -1))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
MUST_GO = 8                                            # symbol; others: initial + 4 if truncated
SYMBOLS = 9
FAR = 1000                                             # more than any difference of costs that can be met
END = (0, 4, 2, 0)                                     # cost to go behind the last row
SPACES = " \t\n\x0b\x0c\r"
NAMES = {USER: "user", ASSISTANT: "assistant"}


def step(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row from those behind it."""
    before = []
    for q in range(4):
        options = [DELETE + after[q]]
        if symbol != MUST_GO:
            extra = TRUNCATED if symbol >= 4 else 0
            options.append(REROLE + extra + after[INSERTED[q]])
            if KEPT[q][symbol % 4] >= 0:
                options.append(extra + after[KEPT[q][symbol % 4]])
        before.append(min(*options, FAR))
    for _ in range(2):                                 # insertions before the row
        before = [min(before[q], INSERT + before[INSERTED[q]]) for q in range(4)]
    return tuple(before)


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(min(x - least, FAR) if x < FAR // 2 else FAR for x in vector), least


class Blocks:
    """Normalised vectors, their steps over one symbol, and over every block of ``BLOCK`` symbols."""

    def __init__(self):
        units = [tuple(0 if k == q else FAR for k in range(4)) for q in range(4)]
        self.vectors, self.number = [], {}
        for v in (END, *units):
            self._add(v)
        steps = []
        for vector in self.vectors:                    # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                v, least = _normal(step(symbol, vector))
                row.append((self._add(v), least))
            steps.append(row)
        self.one = np.array(steps, np.int32)
        # A block's first symbol is its most significant digit, and is stepped over last.
        to, cost = self.one[:, :, 0], self.one[:, :, 1]
        for _ in range(BLOCK - 1):
            onto = self.one[to]                        # vector, block, symbol before it
            to = np.swapaxes(onto[..., 0], 1, 2).reshape(len(self.vectors), -1)
            cost = np.swapaxes(onto[..., 1] + cost[:, :, None], 1, 2).reshape(len(self.vectors), -1)
        self.to, self.cost = np.ascontiguousarray(to), np.ascontiguousarray(cost)

    def _add(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]


class Repairer:
    def __init__(self, blocks: Blocks):
        self.b, self.traced = blocks, {}
        self.to, self.cost = blocks.to, blocks.cost

    def blocks(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """First symbols that fill no block, and the blocks' numbers."""
        loose = len(symbols) % BLOCK
        powers = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return symbols[:loose].tolist(), (symbols[loose:].reshape(-1, BLOCK).astype(np.int64) @ powers).tolist()

    def backward(self, symbols: np.ndarray, vector: int) -> tuple[int, int, list[int]]:
        """Vector and cost before all symbols, and the vectors behind each loose symbol and block, last first."""
        loose, blocks = self.blocks(symbols)
        total, behind = 0, []
        for block in reversed(blocks):
            behind.append(vector)
            total += int(self.cost[vector, block])
            vector = int(self.to[vector, block])
        for symbol in reversed(loose):
            behind.append(vector)
            vector, least = self.b.one[vector, symbol].tolist()
            total += least
        return vector, total, behind

    def matrix(self, symbols: np.ndarray) -> list[int]:
        """Least cost from each state before the symbols to each behind them, without insertions behind the last."""
        out = []
        for q in range(4):
            vector, total, _ = self.backward(symbols, self.b.number[tuple(0 if k == q else FAR for k in range(4))])
            out.append([x + total if x < FAR else FAR for x in self.b.vectors[vector]])
        return [out[q][p] for p in range(4) for q in range(4)]

    def forward(self, symbols: np.ndarray, state: int, behind: list[int]) -> tuple[str, int]:
        """Initials of the edits from a state, and the state behind the last symbol."""
        loose, blocks = self.blocks(symbols)
        out = []
        for symbol, vector in zip(loose, behind[::-1], strict=False):
            edits, state = self.trace(symbol, 1, vector, state)
            out.append(edits)
        for block, vector in zip(blocks, behind[len(blocks) - 1::-1] if blocks else [], strict=True):
            edits, state = self.trace(block, BLOCK, vector, state)
            out.append(edits)
        return "".join(out), state

    def trace(self, block: int, size: int, vector: int, state: int) -> tuple[str, int]:
        key = block, size, vector, state
        if key not in self.traced:
            symbols = [block // SYMBOLS ** k % SYMBOLS for k in range(size - 1, -1, -1)]
            costs = [self.b.vectors[vector]]           # expanded backward, not normalised
            for symbol in reversed(symbols):
                costs.append(step(symbol, costs[-1]))
            costs.reverse()
            edits = []
            for k, symbol in enumerate(symbols):
                before, after, extra = costs[k], costs[k + 1], TRUNCATED if 4 <= symbol < MUST_GO else 0
                while True:
                    if before[state] == DELETE + after[state]:
                        edits.append("D")
                        break
                    if before[state] == INSERT + before[INSERTED[state]]:
                        edits.append("I")
                        state = INSERTED[state]
                        continue
                    kept = KEPT[state][symbol % 4] if symbol != MUST_GO else -1
                    if kept >= 0 and before[state] == extra + after[kept]:
                        edits.append("K")
                        state = kept
                    else:
                        edits.append("R")
                        state = INSERTED[state]
                    break
            self.traced[key] = "".join(edits), state
        return self.traced[key]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32(`conv_id:turn`) % 20 calls for; nulls are one blank there."""
    def filled(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(filled(F.col("conv_id")), F.lit(":"), filled(F.col("turn"))), "UTF-8")) % 20
    text = filled(F.col("text"))
    return (rows.select("conv_id", "turn", filled(F.col("role")).alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
            .select("conv_id", F.col("turn").cast("long").alias("turn"),
                    F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _state(blocks: Blocks) -> Repairer:
    return Repairer(blocks)


def _numbers(column) -> np.ndarray:
    return column.values.to_numpy().astype(np.int64)


def _placed(rows: DataFrame) -> DataFrame:
    """Numbered rows in order: ``conv_id, place, turn, role, sha, blank, duplicate, truncated, symbol``.

    The order is turn (nulls first), then role, then SHA-256 of the text: rows equal in all of these are the same.
    """
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    keys = rows.select("conv_id", "turn", "role", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"), (last == "").alias("blank"),
                       (~last.isin("", ".", "!", "?")).alias("unended"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "sha", "tie"]
    placed = shared.stored(keys.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
                           .withColumn("place", F.monotonically_increasing_id()), "turns-placed")
    firsts = placed.where("NOT blank").groupBy("conv_id", "role", "sha").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    faults = (placed.join(firsts, "place", "left").withColumn("duplicate", F.expr("NOT blank AND first IS NULL"))
              .withColumn("truncated", F.expr("unended AND NOT duplicate")))
    initial = F.coalesce(F.array_position(F.array(F.lit("u"), F.lit("a"), F.lit("s")), F.substring("role", 1, 1)), F.lit(0))
    symbol = F.when(F.expr("blank OR duplicate"), MUST_GO).otherwise((initial + 3) % 4 + F.when(F.col("truncated"), 4).otherwise(0))
    return shared.stored(faults.select("conv_id", "place", "turn", "role", "sha", "blank", "duplicate", "truncated",
                                       symbol.cast("tinyint").alias("symbol")), "turns-symbols")


def _segments(placed: DataFrame) -> DataFrame:
    """``conv_id, segment, symbols, turn, role, sha, parts``: at most 2 ** ``SEGMENT_BITS`` rows each, with the sort key of the first."""
    cells = F.array_sort(F.collect_list(F.struct("place", "symbol")))
    segments = (placed.withColumn("segment", F.shiftright("place", SEGMENT_BITS)).groupBy("conv_id", "segment")
                .agg(cells.alias("cells"), F.min(F.struct("place", "turn", "role", "sha")).alias("head"))
                .select("conv_id", "segment", F.col("cells.symbol").alias("symbols"), "head.turn", "head.role", "head.sha"))
    return shared.stored(segments, "turns-segments")


def _map(df: DataFrame, columns: list[str], schema: str, work) -> DataFrame:
    """``work(state, *lists)`` gives lists of the added columns; ``columns`` come first in each batch."""
    table = df.sparkSession.sparkContext.broadcast(Blocks())
    keep = [c for c in df.columns if c not in columns]
    fields = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), schema])
    names = [*keep, *(part.split()[0] for part in schema.split(", "))]

    def run(batches):
        state = shared.worker_state(_state, table.value)
        for batch in batches:
            added = work(state, *(batch.column(c) for c in columns))
            yield pa.record_batch([*(batch.column(c) for c in keep), *added], names)

    return df.mapInArrow(run, fields)


def _with_ends(segments: DataFrame) -> DataFrame:
    """Adds to each segment the costs to go behind it (``exits``), its first state and whether it is its conversation's last."""
    spread = segments.groupBy("conv_id").agg(F.min("segment").alias("low"), F.max("segment").alias("high")).where("low < high")
    many = segments.join(spread.select(F.col("conv_id").alias("_conv")), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    whole = segments.join(spread.select(F.col("conv_id").alias("_conv")), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_anti")
    out = whole.select("*", F.array(*map(F.lit, END)).alias("exits"), F.lit(START).alias("state"), F.lit(True).alias("final"))
    if spread.isEmpty():
        return out
    matrices = shared.stored(_map(many.select("conv_id", "segment", "symbols"), ["symbols"], "matrix array<int>", lambda state, symbols: [
        pa.array([state.matrix(_numbers(x)) for x in symbols], pa.list_(pa.int32()))]), "turns-matrices")
    exits = shared.stored(_streamed(matrices, True, "exits array<int>, final boolean", pa.list_(pa.int32()), _backward), "turns-exits")
    key = [F.col("segment") == F.col("_segment"), F.col("conv_id").eqNullSafe(F.col("_conv"))]
    named = exits.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "exits", "final")
    many = shared.stored(many.join(named, key).drop("_conv", "_segment"), "turns-many")

    def onward(state, symbols, exits):
        out = []
        for x, end in zip(symbols, exits, strict=True):
            x, vector = _numbers(x), _known(state, end.as_py())
            behind = state.backward(x, vector)[2]
            out.append([state.forward(x, q, behind)[1] for q in range(4)])
        return [pa.array(out, pa.list_(pa.int32()))]

    moves = shared.stored(_map(many.select("conv_id", "segment", "symbols", "exits"), ["symbols", "exits"], "moves array<int>", onward), "turns-moves")
    states = _streamed(moves, False, "state int, final boolean", pa.int32(), _onward).select(
        F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "state")
    return out.unionByName(many.join(states, key).drop("_conv", "_segment"))


def _known(state: Repairer, vector: list[int]) -> int:
    return state.b.number[_normal(tuple(vector))[0]]


def _backward(matrix: list[int], after: list[int] | None) -> tuple[list[int], list[int]]:
    """Costs to go behind a segment, and before it."""
    after = list(END) if after is None else after
    before = [min(min(matrix[4 * p + q] + after[q] for q in range(4)), FAR) for p in range(4)]
    return list(_normal(tuple(after))[0]), list(_normal(tuple(before))[0])


def _onward(moves: list[int], state: int | None) -> tuple[int, int]:
    state = START if state is None else state
    return state, moves[state]


def _streamed(rows: DataFrame, descending: bool, schema: str, kind: pa.DataType, work) -> DataFrame:
    """``work(value, carried)`` over a conversation's segments in order; only what is carried is held."""
    value = rows.columns[2]
    order = F.col("segment").desc() if descending else F.col("segment").asc()

    def run(batches):
        before, carried = None, None
        for batch in batches:
            out, firsts = [], []
            for number, item in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if number != before:
                    before, carried = number, None
                firsts.append(carried is None)
                result, carried = work(item, carried)
                out.append(result)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, kind), pa.array(firsts)],
                                  ["conv_id", "segment", schema.split()[0], "final"])

    text = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))      # null is a conversation of its own
    keyed = rows.select("conv_id", "segment", value, text.alias("number"))
    return (keyed.repartition("number").sortWithinPartitions("number", order)
            .mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, segment long, {schema}"))


def _edited(segments: DataFrame) -> DataFrame:
    """Adds each segment's ``audit``; the last one's has the insertions behind the last row."""
    def edits(state, symbols, exits, states, finals):
        out = []
        for x, end, q, final in zip(symbols, exits, states.to_pylist(), finals.to_pylist(), strict=True):
            x = _numbers(x)
            behind = state.backward(x, _known(state, end.as_py()))[2]
            audit, q = state.forward(x, q, behind)
            out.append(audit + "I" * (END[q] // INSERT if final else 0))
        return [pa.array(out, pa.string())]

    return _map(segments, ["symbols", "exits", "state", "final"], "audit string", edits)


def _applied(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit, repaired_sha256``: each conversation's rows streamed in order, behind its edits."""
    number = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    texts = rows.select(number.alias("number"), "conv_id", "turn", "role", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"), F.lit(1).alias("kind"),
                        F.lit(0).cast("long").alias("segment"), "text")
    edits = edited.select(number.alias("number"), "conv_id", "turn", "role", "sha", F.lit(0).alias("kind"), "segment", F.col("audit").alias("text"))
    ordered = (texts.unionByName(edits).repartition("number")
               .sortWithinPartitions("number", F.col("turn").asc_nulls_first(), "role", "sha", "kind", "segment"))
    names = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches):
        open_one, out = None, []
        for batch in batches:
            for key, conv, role, kind, text in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if open_one is None or open_one.number != key:
                    if open_one is not None:
                        out.append(open_one.closed())
                    open_one = _Conversation(key, conv)
                if kind:
                    open_one.row(role, text)
                else:
                    open_one.audit.append(text)
            if out:
                yield _batch(out)
                out = []
        if open_one is not None:
            yield _batch([open_one.closed()])

    conv_type = rows.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(conv_type), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def _batch(found):
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return ordered.select("number", "conv_id", "role", "kind", "text").mapInArrow(
        run, f"conv_id {conv_type.simpleString()}, illegal long, cost long, audit string, repaired_sha256 string")


class _Conversation:
    """The hash, the costs and the edits of a conversation whose rows come in order, each segment's edits before its rows."""

    def __init__(self, number: str, conv):
        self.number, self.conv, self.audit, self.hash = number, conv, [], hashlib.sha256()
        self.part, self.at, self.state, self.cost, self.illegal, self.rows, self.before = 0, 0, START, 0, 0, 0, None

    def _edit(self) -> str:
        while self.at == len(self.audit[self.part]):
            self.part, self.at = self.part + 1, 0
        self.at += 1
        return self.audit[self.part][self.at - 1]

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.rows else "") + f"{role}:{text}").encode())
        self.rows += 1

    def _insert(self) -> None:
        self.state = INSERTED[self.state]
        self.cost += INSERT
        self._write(NAMES[self.state], "")

    def row(self, role: str, text: str) -> None:
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        while (edit := self._edit()) == "I":
            self._insert()
        if edit == "D":
            self.cost += DELETE
            return
        if text.rstrip(SPACES)[-1:] not in (".", "!", "?"):
            self.cost += TRUNCATED
        if edit == "K":
            self.state = KEPT[self.state]["uas".index(role[0])]
        else:
            self.state = INSERTED[self.state]
            self.cost += REROLE
            role = NAMES[self.state]
        self._write(role, text)

    def closed(self) -> tuple:
        for _ in range(sum(map(len, self.audit[self.part:])) - self.at):
            self._insert()
        return self.conv, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """Damage, faults and cheapest repair of each conversation of ``conv_id, turn, role, text``.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, a row for each
    original conversation. Rows with a null id are one conversation; a null role or text is one blank; null turns come
    first. Rows of one turn are ordered by role, then by SHA-256 of the text (equal ones are interchangeable). A role
    counts by its first character; one that is empty or of another initial is renamed or deleted. Other columns are not
    read; an empty table gives an empty one. A conversation without rows after the damage has zeros and empty edits.
    """
    spark = conversations.sparkSession
    shared.bytes_per_batch(spark)
    rows = damaged(conversations)
    placed = _placed(rows)
    counts = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        *(F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    applied = _applied(rows, _edited(_with_ends(_segments(placed))))
    every = conversations.select("conv_id").distinct()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [df.select("conv_id", *(F.col(c).cast("long").alias(c) if c in df.columns else F.lit(None).cast("long").alias(c) for c in names),
                       *(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("audit", "repaired_sha256")))
             for df in (every, counts, applied)]
    return union_by("conv_id", *parts).groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in names), F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
