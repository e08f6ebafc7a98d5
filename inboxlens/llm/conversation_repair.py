"""Conversations with faults, repaired by their cheapest edits.

A conversation may begin with a system row and then alternates user and assistant, the
assistant last.  Rows are kept (0), given the role that is due (1) or deleted (2; a must for
blank and repeated ones), rows with no text are inserted (5), and a truncated row that stays
adds 5.  Which edits are cheapest is a shortest path through a lattice: a node is the number
of rows used and what was put out last; an arc is an edit with its integer cost.

The path is found by the auction algorithm.  Every node has a price, at most its distance to
the end; a path grows from the origin over the arc of least cost plus price (extension), and
where its last node's price is below that, the price is raised to it and the node leaves the
path (contraction).  Where a path ends its prices are exact on every shortest path, so the
tight arcs, whose cost is the difference of their ends' prices, are the arcs of the cheapest
edits; they are traced in the order D, I, K, R, so the least of equally cheap audits is
found.  Conversations are auctioned in blocks of layers from the end: the four prices where a
block begins, less the least of them, are those the block before it ends with, so the work is
linear in the rows; the trace auctions each block again from its one state.

Spark deals the rows by conversation and sorts them; a task sees them as a stream.  The
first pass carries no texts: a byte for each row, and then the audit, which is as long as the
conversation.  The second streams each conversation's texts behind its audit; nothing is
collected, so a conversation of any length needs three bytes a row in a task.

Rows: order is by turn (nulls first), ties by role, then the text's first 64 characters, then
a hash of both; a null role or text is one space; a null conv_id is a conversation of its own;
repeated rows are rows like others (the later ones duplicates); an empty role may not stay;
conversations without rows have zeros and an empty audit; an empty table gives no rows; more
columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slices

# White space, what ends a sentence, and the costs of the edits.
_SPACES = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5

USER, ASSISTANT, SYSTEM, OTHER = range(4)  # what a role's initial says
_MUST_GO, _TRUNCATED = 4, 8
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_BLOCK = 16       # layers auctioned at a time
_REMEMBERED = 50_000  # auctioned blocks that a task keeps


def _due(state: int) -> tuple[str, int]:
    """The role that may follow, and the state it leads to."""
    return ("assistant", _AFTER_A) if state == _AFTER_U else ("user", _AFTER_U)


def _after_kept(state: int, who: int) -> int | None:
    """The state after a kept row, None if it may not stand there."""
    if who == SYSTEM:
        return _AFTER_S if state == _START else None
    role, then = _due(state)
    return then if who == (ASSISTANT if role == "assistant" else USER) else None


def _arcs(code: int | None) -> list[list[tuple[str, int, int, int]]]:
    """For each state the edits (label, cost, rows used, next state) where a row with this
    code is next (None: no row is left), in the labels' order."""
    out = []
    for state in range(4):
        then = _due(state)[1]
        arcs = [("I", COSTS["I"], 0, then)]
        if code is not None:
            arcs.append(("D", COSTS["D"], 1, state))
            if not code & _MUST_GO:
                more = TRUNCATED_COST if code & _TRUNCATED else 0
                kept = _after_kept(state, code & 3)
                if kept is not None:
                    arcs.append(("K", COSTS["K"] + more, 1, kept))
                arcs.append(("R", COSTS["R"] + more, 1, then))
        out.append(sorted(arcs))
    return out


_ARCS = {code: _arcs(code) for code in [None, *range(16)]}


def _auction(origin: int, prices: list[int], layers: list, ends: dict[int, int]) -> None:
    """Raise ``prices`` until that of ``origin`` is exact.  A node is 4 x layer + state;
    ``ends`` are the nodes whose price is final."""
    path = [origin]
    while path[-1] not in ends:
        node = path[-1]
        layer, state = node >> 2, node & 3
        best = via = None
        for _, cost, used, then in layers[layer][state]:
            to = ((layer + used) << 2) + then
            price = cost + (ends[to] if to in ends else prices[to])
            if best is None or price < best:
                best, via = price, to
        if prices[node] < best:
            prices[node] = best  # contraction
            if len(path) > 1:
                path.pop()
        else:
            path.append(via)  # extension


def _trace(origin: int, prices: list[int], layers: list, ends: dict[int, int]) -> tuple[str, int]:
    """The ASCII-least way over tight arcs to a final node, and that node."""
    path, labels, dead = [origin], [], set()
    while path[-1] not in ends:
        node = path[-1]
        layer, state = node >> 2, node & 3
        for label, cost, used, then in layers[layer][state]:
            to = ((layer + used) << 2) + then
            if to not in dead and prices[node] == cost + (ends[to] if to in ends else prices[to]):
                path.append(to)
                labels.append(label)
                break
        else:  # a price below its distance: no way on
            dead.add(path.pop())
            labels.pop()
    return "".join(labels), path[-1]


def _block(codes: bytes, after: tuple | None) -> tuple[list, dict[int, int]]:
    """A block's arcs by layer, and its final nodes with their prices: ``after`` of the four
    states where the next block begins, None for the last block."""
    layers = [_ARCS[c] for c in codes]
    end = 4 * len(layers)
    if after is not None:
        return layers, {end + s: p for s, p in enumerate(after)}
    return [*layers, _ARCS[None]], {end + s: 0 for s in (_START, _AFTER_A)}  # where a conversation may end


def _block_prices(codes: bytes, after: tuple | None) -> tuple:
    """The prices of the four states at the start of a block."""
    layers, ends = _block(codes, after)
    prices = [0] * (4 * len(layers) + 4)
    for state in range(4):
        if state not in ends:
            _auction(state, prices, layers, ends)
    return tuple(ends.get(state, prices[state]) for state in range(4))


def _block_trace(codes: bytes, after: tuple | None, state: int) -> tuple[str, int]:
    """The least edits through a block from ``state``, and the state they lead to."""
    layers, ends = _block(codes, after)
    prices = [0] * (4 * len(layers) + 4)
    _auction(state, prices, layers, ends)
    labels, node = _trace(state, prices, layers, ends)
    return labels, node & 3


def _once(remembered: dict, solve, *args):
    found = remembered.get(args)
    if found is None:
        if len(remembered) >= _REMEMBERED:
            remembered.clear()
        found = remembered[args] = solve(*args)
    return found


def cheapest_edits(codes: bytes, remembered: dict | None = None) -> tuple[int, str]:
    """The least cost and, of the audits that have it, the ASCII-least.  ``remembered`` keeps
    auctioned blocks from one conversation to the next."""
    remembered = {} if remembered is None else remembered
    blocks = range(0, max(len(codes), 1), _BLOCK)
    known = array("q", bytes(32 * len(blocks)))  # the four prices after each block, less the least
    after, cost = None, 0
    for number in reversed(range(len(blocks))):
        if after is not None:
            known[4 * number:4 * number + 4] = array("q", after)
        prices = _once(remembered, _block_prices, codes[blocks[number]:blocks[number] + _BLOCK], after)
        least = min(prices)  # differences stay small however long the conversation is
        after, cost = tuple(p - least for p in prices), cost + least
    audit, state, last = [], _START, len(blocks) - 1
    for number, at in enumerate(blocks):
        rest = None if number == last else tuple(known[4 * number:4 * number + 4])
        labels, state = _once(remembered, _block_trace, codes[at:at + _BLOCK], rest, state)
        audit.append(labels)
    return cost + after[_START], "".join(audit)


class _Report:
    """Faults, codes and edits of one conversation, row by row in order."""

    def __init__(self, conv_id, remembered: dict):
        self.conv_id, self.codes, self.remembered = conv_id, bytearray(), remembered
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, turn, who: int, blank: bool, seen: bool, truncated: bool, key: bytes) -> None:
        seen = seen or (turn, key) == self.last
        if self.codes and (self.codes[-1] & 3, who) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
            self.illegal += 1
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += truncated and not seen and not blank
        self.codes.append(who | (_MUST_GO if blank or seen else _TRUNCATED if truncated else 0))
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last = (turn, key)

    def row(self) -> dict:
        cost, audit = cheapest_edits(bytes(self.codes), self.remembered)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit}


_REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_ORDER = ("conv_id", "kind", "turn", "role", "begin", "key")


def _keyed(messages: DataFrame) -> DataFrame:
    """The columns of a conversation's rows, nulls as one space, with their place in order."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text",
                       F.substring("text", 1, 64).alias("begin"),
                       F.unhex(F.sha2(whole.cast("binary"), 256)).alias("key"))


def _who(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return (F.when(first == "u", USER).when(first == "a", ASSISTANT).when(first == "s", SYSTEM)
            .otherwise(OTHER))


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(*_ORDER)


def report(messages: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row for each conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit``.  ``conversations`` (``conv_id``) adds those that have no rows."""
    rows = _keyed(messages)
    bare = F.rtrim(F.col("text"), F.lit(_SPACES))
    light = rows.select("conv_id", "kind", "turn", "role", "begin", "key", _who(F.col("role")).alias("who"),
                        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*_ENDS)).alias("cut"),
                        F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).alias("conv"))
    # the first turn of what a conversation says more than once
    first = (light.groupBy("conv", "key").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first"))
             .where("n > 1").drop("n"))
    later = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    light = light.join(first, ["conv", "key"], "left").select(*_ORDER, "who", "blank", "cut", later.alias("seen"))
    if conversations is not None:
        none = [F.lit(None).cast(light.schema[c].dataType).alias(c) for c in light.columns[2:]]
        light = light.unionByName(conversations.select("conv_id").distinct().select(
            "conv_id", F.lit(0).alias("kind"), *none))
    kind = T.StructType([messages.schema["conv_id"], *[
        T.StructField(c, T.StringType() if c == "audit" else T.LongType()) for c in _REPORT]])
    schema = to_arrow_schema(kind)

    def judged(batches: Iterator) -> Iterator:
        def rows() -> Iterator[dict]:
            now, remembered = None, {}
            for batch in slices(batches):
                for conv, is_row, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if now is None or conv != now.conv_id:
                        if now is not None:
                            yield now.row()
                        now = _Report(conv, remembered)
                    if is_row:
                        now.add(*rest)
            if now is not None:
                yield now.row()

        return _batched(rows(), schema)

    return (_by_conversation(light).select("conv_id", "kind", "turn", "who", "blank", "seen", "cut", "key")
            .mapInArrow(judged, kind))


def _repair(audit: str) -> Iterator[tuple]:
    """Repaired rows ``(edit, turn, role, text)``: sent each row of the conversation as
    ``(turn, role, text)`` in order, yields None when it takes the next."""
    state = _START
    for edit in audit:
        role, then = _due(state)
        if edit == "I":
            yield edit, None, role, ""
        else:
            turn, own, text = yield None
            if edit == "D":
                continue
            if edit == "K" and own[:1] == "s" and state == _START:
                then = _AFTER_S
            yield edit, turn, own if edit == "K" else role, text
        state = then
    while True:  # the edits are done
        yield None


def _played(batches: Iterator) -> Iterator[tuple]:
    """A task's stream as ``(conv_id, report, None)`` at the start of each conversation and
    ``(conv_id, None, repaired row)`` for each row that its repair puts out."""
    for batch in slices(batches):
        for conv, head, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if head is not None:
                yield conv, head, None
                repair = _repair(head["audit"])
                row = next(repair, None)
            else:
                row = repair.send((turn, role, text)) if row is None else row
                if row is None:  # deleted, the next one is taken
                    continue
            while row is not None:
                yield conv, None, row
                row = next(repair, None)


def _streamed(messages: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order."""
    rows = _keyed(messages)
    own = F.struct(*[c for c in reports.columns if c != "conv_id"])
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "begin", "key")]
    heads = reports.select("conv_id", F.lit(0).alias("kind"), *none, own.alias("report"))
    kind = heads.schema["report"].dataType
    both = heads.unionByName(rows.withColumn("report", F.lit(None).cast(kind)))
    return _by_conversation(both).select("conv_id", "report", "turn", "role", "text")


def _batched(rows: Iterator[dict], schema, most: int = 1024) -> Iterator:
    import pyarrow as pa

    some = []
    for row in rows:
        some.append(row)
        if len(some) >= most:
            yield pa.RecordBatch.from_pylist(some, schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def digests(messages: DataFrame, reports: DataFrame) -> DataFrame:
    """``reports`` with ``repaired_sha256``: of the repaired conversation's ``role:text``
    lines, joined by line feeds."""
    kind = T.StructType([*reports.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    schema = to_arrow_schema(kind)

    def hashed(batches: Iterator) -> Iterator:
        import hashlib

        def rows() -> Iterator[dict]:
            now = lines = None
            for conv, head, row in _played(batches):
                if head is not None:
                    if now is not None:
                        yield now | {"repaired_sha256": lines.hexdigest()}
                    now, lines, between = {"conv_id": conv, **head}, hashlib.sha256(), ""
                else:
                    lines.update(f"{between}{row[2]}:{row[3]}".encode())
                    between = "\n"
            if now is not None:
                yield now | {"repaired_sha256": lines.hexdigest()}

        return _batched(rows(), schema)

    return _streamed(messages, reports).mapInArrow(hashed, kind)


def repaired(messages: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations, a row for each of their rows: ``conv_id, place`` (from 0),
    ``edit`` (K, R or I), ``turn`` (null if inserted), ``role, text``."""
    kind = T.StructType([reports.schema["conv_id"], T.StructField("place", T.LongType()),
                         T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()),
                         T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    schema = to_arrow_schema(kind)

    def rows(batches: Iterator) -> Iterator:
        def each() -> Iterator[dict]:
            place = 0
            for conv, head, row in _played(batches):
                if head is not None:
                    place = 0
                else:
                    yield dict(zip(schema.names, (conv, place, *row), strict=True))
                    place += 1

        return _batched(each(), schema, 256)

    return _streamed(messages, reports).mapInArrow(rows, kind)
