"""Cheapest repair of the turns of conversations: a Viterbi search whose survivors coalesce."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.llm.common import send_by_value, text_key
from linetrace.session import checkpointed

send_by_value(__name__)

#: Rows of a conversation that one search covers; longer conversations are searched block by block.
BLOCK = 512
#: Blocks that one task joins at once.
FAN = 4096
#: Blocks whose searches a worker remembers: conversations with the same faults have the same edits.
MEMORY = 1 << 12

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States: nothing said yet, after the system, the user, the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that must follow each state.
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: Roles that may stay, by the state before.
KEEP = {
    ("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT,
}
ENDS = (START, ASSISTANT)
#: What it costs at most to go on from the first state as one could from the second: turns to insert,
#: a system turn to delete, and two turns to insert at the end after the system.
BRIDGE = {
    (START, SYSTEM): 0, (START, USER): INSERT, (START, ASSISTANT): 0,
    (SYSTEM, START): DELETE + 2 * INSERT, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, START): INSERT + DELETE, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, START): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
}
#: A row that must go, and the end of a conversation.
GONE, END = "-", "$"
WHITE_CHARS = " \t\n\x0b\f\r"


def _moves(symbol: str) -> list[tuple]:
    """``(before, after, cost, edits, roles)``: the best edits at a row for each two states.

    A row is ``s u a o`` by its role, in capitals if its text is cut off. Up to two turns are
    inserted before it: more would come back to the same state at a price. Strings of
    edits over the same rows end with the edit of the last row, so that none starts another.
    """
    best: dict[tuple[int, int], tuple] = {}

    def offer(before: int, after: int, *move) -> None:
        if (before, after) not in best or move < best[before, after]:
            best[before, after] = move

    for before in NEXT:
        state, cost, edits, roles = before, 0, "", ()
        for _ in range(3):
            if symbol == END:
                if state in ENDS:
                    offer(before, state, cost, edits, roles)
            else:
                offer(before, state, cost + DELETE, edits + "D", (*roles, ""))
                if symbol != GONE:
                    fault = TRUNCATED if symbol.isupper() else 0
                    if (kept := KEEP.get((symbol.lower(), state))) is not None:
                        offer(before, kept, cost + fault, edits + "K", (*roles, ""))
                    after, role = NEXT[state]
                    offer(before, after, cost + fault + REROLE, edits + "R", (*roles, role))
            state, role = NEXT[state]
            cost, edits, roles = cost + INSERT, edits + "I", (*roles, role)
    return [(*states, *move) for states, move in best.items()]


MOVES = {symbol: _moves(symbol) for symbol in ("s", "u", "a", "o", "S", "U", "A", "O", GONE, END)}


class _Node:
    """Edits at one row. ``uses`` counts survivors that end here and nodes that go on from here."""

    __slots__ = ("parent", "row", "edits", "roles", "uses", "children")

    def __init__(self, parent: _Node | None = None, row: int = -1, edits: str = "", roles: tuple = ()):
        self.parent, self.row, self.edits, self.roles = parent, row, edits, roles
        self.uses, self.children = 1, set()


class Survivors:
    """The cheapest way to every state after the rows so far, as branches of one tree.

    Branches that no survivor uses are freed. What lies between the root and the last
    ancestor that all survivors share is decided: ``feed`` returns it and forgets
    it, so only undecided edits are held. Ways of equal cost are told apart by their
    complete undecided edits; the decided ones are the same for all.

    With ``prune``, a survivor is dropped that costs more than another one and its
    ``BRIDGE``: whatever follows, it is no part of a cheapest way. Without, the way that deletes
    all rows would keep its own branch to the end.
    """

    def __init__(self, entry: int = START, prune: bool = True):
        self.root, self.rows, self.prune = _Node(), 0, prune
        self.alive = {entry: (0, self.root)}

    def undecided(self, node: _Node) -> list[_Node]:
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        return way[::-1]

    def _text(self, node: _Node, edits: str) -> str:
        return "".join(n.edits for n in self.undecided(node)) + edits

    def _release(self, node: _Node) -> None:
        node.uses -= 1
        while not node.uses and node is not self.root:
            node.parent.children.discard(node)
            node = node.parent
            node.uses -= 1

    def feed(self, symbol: str) -> list[_Node]:
        """Take the next row; return the nodes that are decided by it, in order."""
        chosen: dict[int, tuple] = {}
        for before, after, cost, edits, roles in MOVES[symbol]:
            if before not in self.alive:
                continue
            total, node = self.alive[before]
            total += cost
            other = chosen.get(after)
            if (
                other is None
                or total < other[0]
                or total == other[0] and self._text(node, edits) < self._text(other[1], other[2])
            ):
                chosen[after] = total, node, edits, roles
        if self.prune:
            totals = [(state, way[0]) for state, way in chosen.items()]
            for p, cost in totals:
                if any(q != p and other + BRIDGE[q, p] < cost for q, other in totals):
                    del chosen[p]
        old, self.alive = self.alive, {}
        for after, (total, node, edits, roles) in chosen.items():
            child = _Node(node, self.rows, edits, roles)
            node.children.add(child)
            node.uses += 1
            self.alive[after] = total, child
        for _, node in old.values():
            self._release(node)
        self.rows += 1
        decided = []
        while self.root.uses == 1 and self.root.children:
            (self.root,) = self.root.children
            self.root.parent = None
            decided.append(self.root)
        return decided

    def best(self) -> int:
        return min(self.alive, key=lambda state: (self.alive[state][0], self._text(self.alive[state][1], "")))


@lru_cache(maxsize=MEMORY)
def cheapest_edits(symbols: str, entry: int, exit_: int | None) -> tuple[int, tuple]:
    """Cost of the best way from state ``entry`` over the rows, and its steps ``(edit, row, role)``.

    The way ends in ``exit_``, or in the state of the cheapest if that is ``None``.
    """
    survivors, nodes = Survivors(entry), []
    for symbol in symbols:
        nodes += survivors.feed(symbol)
    cost, last = survivors.alive[survivors.best() if exit_ is None else exit_]
    nodes += survivors.undecided(last)
    return cost, tuple((e, None if e == "I" else n.row, r or None) for n in nodes for e, r in zip(n.edits, n.roles))


@lru_cache(maxsize=MEMORY)
def transfer(symbols: str) -> tuple[int, ...]:
    """Best ways over the rows between all states: 16 costs, -1 for none, and 16 places.

    The places order the ways by their edits, equal ones alike.
    """
    costs, texts = [-1] * 16, [None] * 16
    for entry in NEXT:
        survivors, text = Survivors(entry, prune=False), []
        for symbol in symbols:
            text += [n.edits for n in survivors.feed(symbol)]
        for state, (cost, node) in survivors.alive.items():
            costs[4 * entry + state] = cost
            texts[4 * entry + state] = "".join(text + [n.edits for n in survivors.undecided(node)])
    return (*costs, *_places(texts))


def _places(keys: list) -> list[int]:
    known = {key: place for place, key in enumerate(sorted({k for k in keys if k is not None}))}
    return [known.get(key, -1) for key in keys]


def _step(ways: dict[int, tuple], block: list[int]) -> dict[int, tuple]:
    """Go on from ``{state: (cost, key)}`` over a block: ``{state: (cost, key, state before)}``."""
    out: dict[int, tuple] = {}
    for before, (cost, key) in ways.items():
        for after in NEXT:
            if (more := block[4 * before + after]) >= 0:
                way = cost + more, (key, block[16 + 4 * before + after]), before
                if after not in out or way < out[after]:
                    out[after] = way
    return out


def joined_transfer(blocks: list[list[int]]) -> list[int]:
    """The ``transfer`` of blocks one after another.

    Ways over the same rows never start one another, so their first block that
    differs decides which edits come first.
    """
    ways = {entry: {entry: (0, 0)} for entry in NEXT}
    for block in blocks:
        found = {entry: _step(reached, block) for entry, reached in ways.items()}
        flat = [(e, s, way) for e, reached in found.items() for s, way in reached.items()]
        places = _places([way[1] for _, _, way in flat])
        ways = {entry: {} for entry in NEXT}
        for (entry, state, way), place in zip(flat, places):
            ways[entry][state] = way[0], place
    costs, keys = [-1] * 16, [-1] * 16
    for entry, reached in ways.items():
        for state, (cost, place) in reached.items():
            costs[4 * entry + state], keys[4 * entry + state] = cost, place
    return costs + keys


def route(blocks: list[list[int]], entry: int, exit_: int | None) -> list[tuple[int, int]]:
    """States before and after every block on the best way from ``entry`` to ``exit_``, or to the best end."""
    ways, back = {entry: (0, 0)}, []
    for block in blocks:
        found = _step(ways, block)
        places = _places([way[1] for way in found.values()])
        ways = {state: (way[0], place) for (state, way), place in zip(found.items(), places)}
        back.append({state: way[2] for state, way in found.items()})
    state = min(ways, key=ways.get) if exit_ is None else exit_
    out = []
    for before in reversed(back):
        out.append((before[state], state))
        state = before[state]
    return out[::-1]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STEPS = _struct(
    cost=T.LongType(), steps=T.ArrayType(_struct(edit=T.StringType(), row=T.IntegerType(), role=T.StringType()))
)


@F.arrow_udf(_STEPS)
def _searched(symbols: pa.Array, entry: pa.Array, exit_: pa.Array) -> pa.Array:
    found = [cheapest_edits(s.as_py(), e.as_py(), x.as_py()) for s, e, x in zip(symbols, entry, exit_)]
    step = pa.struct([("edit", pa.string()), ("row", pa.int32()), ("role", pa.string())])
    rows = [{"cost": c, "steps": [dict(zip(("edit", "row", "role"), s)) for s in steps]} for c, steps in found]
    return pa.array(rows, pa.struct([("cost", pa.int64()), ("steps", pa.list_(step))]))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _transfers(symbols: pa.Array) -> pa.Array:
    return pa.array([transfer(s.as_py()) for s in symbols], pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _joined(blocks: pa.Array) -> pa.Array:
    return pa.array([joined_transfer(b.as_py()) for b in blocks], pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(_struct(entry=T.IntegerType(), exit=T.IntegerType())))
def _routes(blocks: pa.Array, entry: pa.Array, exit_: pa.Array) -> pa.Array:
    found = [route(b.as_py(), e.as_py(), x.as_py()) for b, e, x in zip(blocks, entry, exit_)]
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32())]))
    return pa.array([[{"entry": e, "exit": x} for e, x in ways] for ways in found], kind)


def _fault(text: Column, repeated: Column) -> Column:
    seen = F.rtrim(text, F.lit(WHITE_CHARS))
    return (
        F.when(seen == "", "blank")
        .when(repeated, "duplicate")
        .when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), "truncated")
    )


def _short(rows: DataFrame) -> DataFrame:
    """Rows of conversations of one block; ``place`` is left to their order by turn."""
    same = Window.partitionBy("conv", "role", "text").orderBy("turn")
    return rows.repartition("conv").select(
        "*", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("place"), (F.row_number().over(same) > 1).alias("again")
    )


def _long(rows: DataFrame, block: int) -> DataFrame:
    """Rows of long conversations, numbered by range parts and prefix sums of their counts.

    Nothing gathers a conversation: equal rows are spread by a number of their own,
    the first of them comes from a grouping and is marked by its place.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = checkpointed(rows)
    order = ["conv", "turn", "role", "text", "id"]
    ranged = kept.withColumn("id", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    ranged = checkpointed(ranged.withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("conv", "part").count()
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy("turn", "role", "text", "id"))
    placed = ranged.withColumn("inside", inside).join(offsets, ["conv", "part"])
    placed = checkpointed(placed.select("conv", "turn", "role", "text", (F.col("offset") + F.col("inside") - 1).alias("place")))
    firsts = placed.groupBy("conv", "role", text_key(F.col("text")).alias("key")).agg(F.min("place").alias("place"))
    marked = placed.join(firsts.select("conv", "place", F.lit(True).alias("first")), ["conv", "place"], "left")
    return marked.select(
        "conv", "turn", "role", "text", F.expr(f"place div {block}").alias("block"), "place", F.col("first").isNull().alias("again")
    )


def _ways(blocks: DataFrame, fan: int) -> DataFrame:
    """``(conv, block, entry, exit)`` of the best way through the blocks of every conversation.

    Transfers of up to ``fan`` blocks at a time are joined until a conversation has one; then the
    states are handed down the same levels.
    """
    levels = [checkpointed(blocks.select("conv", F.col("block").alias("node"), _transfers("symbols").alias("transfer")))]

    def grouped(level: DataFrame) -> DataFrame:
        nodes = level.groupBy("conv", F.expr(f"node div {fan}").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("node").alias("child"), "transfer"))).alias("children")
        )
        return nodes.select("conv", "node", "children")

    while levels[-1].agg(F.max("node")).first()[0]:
        levels.append(checkpointed(grouped(levels[-1]).select("conv", "node", _joined("children.transfer").alias("transfer"))))
    ways = levels[-1].select("conv", "node", F.lit(START).alias("entry"), F.lit(None).cast("int").alias("exit"))
    for level in reversed(levels[:-1]):
        routed = grouped(level).join(ways, ["conv", "node"]).select(
            "conv", "children.child", _routes("children.transfer", "entry", "exit").alias("ways")
        )
        pairs = F.explode(F.arrays_zip("child", "ways")).alias("w")
        ways = checkpointed(routed.select("conv", pairs).select("conv", F.col("w.child").alias("node"), "w.ways.*"))
    return ways.select("conv", F.col("node").alias("block"), "entry", "exit")


def repaired_blocks(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    block: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """Up to ``block`` rows of a conversation each, with their faults and the cheapest edits.

    ``(conv, block, blocks, rows, cost, steps)``: ``conv`` is a struct of the conversation's id,
    ``rows`` are ``(turn, role, text, fault)`` in order and ``steps`` are ``(edit, row, role)`` in order:
    ``K`` keeps a row, ``R`` gives it another role, ``D`` takes it out and ``I`` puts in an empty turn
    of a role (no row). The edits of a conversation leave roles that read ``(s?(ua)+)?`` by their first
    letters, at the least cost, and among the cheapest they are the least in ASCII order.

    A row's fault is the first of ``blank`` (no character beyond white space), ``duplicate`` (role and
    text occur earlier in the conversation; both must go) and ``truncated`` (does not end in ``. ! ?``).
    Rows are ordered by turn, null first, then by role and text; equal rows are
    interchangeable. Null roles and texts count as one blank; an empty role may not stay. A null id is a
    conversation like any other. Columns beyond the four are not looked at. No rows
    give no blocks.
    """
    named = [F.col(f"`{c}`") for c in (turn_column, role_column, text_column)]
    rows = conversations.select(
        F.struct(F.col(f"`{conv_column}`").alias("id")).alias("conv"),
        named[0].alias("turn"),
        *[F.coalesce(c, F.lit(" ")).alias(n) for c, n in zip(named[1:], ("role", "text"))],
    )
    long = checkpointed(rows.groupBy("conv").count().where(F.col("count") > block))
    sizes = [] if long.isEmpty() else [long]
    placed = _short(rows.join(long, "conv", "left_anti") if sizes else rows)
    if sizes:
        placed = placed.unionByName(_long(rows.join(long, "conv", "left_semi"), block))
    fault = _fault(F.col("text"), F.col("again"))
    letter = F.left("role", F.lit(1))
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), GONE)
        .when(F.col("fault") == "truncated", F.upper("letter"))
        .otherwise(F.col("letter"))
    )
    listed = placed.select(
        "conv", "block", "place", "turn", "role", "text", "again", fault.alias("fault"),
        F.when(letter.isin("s", "u", "a"), letter).otherwise("o").alias("letter"),
    ).withColumn("symbol", symbol)
    blocks = listed.groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "turn", "role", "text", "again", "fault", "symbol"))).alias("rows")
    )
    symbols = F.array_join("rows.symbol", "")
    slim = F.transform("rows", lambda r: F.struct(r.turn.alias("turn"), r.role.alias("role"), r.text.alias("text"), r.fault.alias("fault")))
    if not sizes:
        searched = blocks.select(
            "conv", "block", F.lit(1).cast("bigint").alias("blocks"), slim.alias("rows"), F.concat(symbols, F.lit(END)).alias("symbols"),
            F.lit(START).alias("entry"), F.lit(None).cast("int").alias("exit"),
        )
    else:
        last = F.expr(f"(count - 1) div {block}")
        counted = checkpointed(
            blocks.join(long.withColumn("last", last), "conv", "left").select(
                "conv", "block", F.coalesce(F.col("last") + 1, F.lit(1)).alias("blocks"), slim.alias("rows"),
                F.concat(symbols, F.when(F.coalesce("last", F.lit(0)) == F.col("block"), END).otherwise("")).alias("symbols"),
            )
        )
        ways = _ways(counted.where("blocks > 1").select("conv", "block", "symbols"), fan)
        searched = counted.join(ways, ["conv", "block"], "left").withColumn("entry", F.coalesce("entry", F.lit(START)))
    found = searched.withColumn("found", _searched("symbols", "entry", "exit"))
    return found.select("conv", "block", "blocks", "rows", "found.cost", "found.steps")


def _kept_rows() -> Column:
    """Rows ``(role, text)`` that the steps of a block leave."""
    return F.expr(
        "transform(filter(steps, s -> s.edit <> 'D'), s -> named_struct("
        "'role', coalesce(s.role, get(rows, s.row).role), 'text', if(s.edit = 'I', '', get(rows, s.row).text)))"
    )


def repaired_rows(blocks: DataFrame) -> DataFrame:
    """``(conv, block, place, role, text)``: the repaired conversations, from ``repaired_blocks``."""
    return blocks.select("conv", "block", F.posexplode(_kept_rows()).alias("place", "r")).select("conv", "block", "place", "r.*")


def _hashed(chunks: DataFrame) -> DataFrame:
    """``(conv, sha)``: SHA-256 of the chunks of a conversation in order, joined by newlines.

    A hash is taken from front to back, so one task reads a conversation's chunks; it holds one at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([sha.hexdigest()])], ["conv", "sha"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, chunk in zip(batch.column(0), batch.column(1)):
                conv = conv.as_py()
                if sha is None or conv != now:
                    if sha is not None:
                        yield row()
                    now, sha, first = conv, hashlib.sha256(), True
                if (chunk := chunk.as_py()) is not None:
                    sha.update(("" if first else "\n").encode() + chunk.encode())
                    first = False
        if sha is not None:
            yield row()

    schema = T.StructType([chunks.schema["conv"], T.StructField("sha", T.StringType())])
    ordered = chunks.repartition("conv").sortWithinPartitions("conv", "block")
    return ordered.select("conv", "chunk").mapInArrow(digest, schema)


def repair_report(blocks: DataFrame) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha)`` of each conversation.

    ``gaps`` are turns missing between the least and the greatest, ``illegal`` counts neighbours
    before the repair whose roles do not follow each other, ``audit`` has the first letters of the
    edits and ``sha`` is the SHA-256 of the repaired rows ``role:text``, joined by newlines. Conversations of
    several blocks are put together from what their blocks say of themselves and their borders.
    """
    faults = [F.expr(f"cast(size(filter(rows, r -> r.fault = '{f}')) as bigint)").alias(f) for f in ("blank", "duplicate", "truncated")]
    letters = F.expr("transform(rows, r -> left(r.role, 1))")
    lines = F.transform(_kept_rows(), lambda r: F.concat(r.role, F.lit(":"), r.text))
    said = blocks.select(
        "conv", "block", "blocks", "cost", *faults,
        letters.alias("letters"),
        F.expr("array_distinct(filter(transform(rows, r -> r.turn), t -> t is not null))").alias("turns"),
        F.array_join("steps.edit", "").alias("audit"),
        lines.alias("lines"),
    ).select(
        "*",
        F.expr(
            "cast(size(filter(sequence(0, size(letters) - 1), i -> i > 0 and"
            " concat(get(letters, i - 1), get(letters, i)) not in ('su', 'ua', 'au'))) as bigint)"
        ).alias("illegal"),
        F.array_min("turns").alias("least"), F.array_max("turns").alias("most"), F.size("turns").cast("bigint").alias("n_turns"),
        F.when(F.size("lines") > 0, F.array_join("lines", "\n")).alias("chunk"),
    )
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"]
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n_turns"), F.lit(0)).cast("bigint")
    single = said.where("blocks = 1").withColumn("gaps", gaps).withColumn("sha", F.sha2(F.coalesce("chunk", F.lit("")), 256))
    single = single.select("conv", *columns)
    several = said.where("blocks > 1")
    several = checkpointed(several)
    if several.isEmpty():
        return single
    order = Window.partitionBy("conv").orderBy("block")
    border = F.concat(F.lag(F.element_at("letters", -1)).over(order), F.element_at("letters", 1))
    # The turns ascend, so a turn can only go on from one block into the next.
    so_far = F.max("most").over(order.rowsBetween(Window.unboundedPreceding, -1))
    shared = F.when(so_far == F.col("least"), 1).otherwise(0)
    bordered = several.select(
        "conv", "block", "blank", "duplicate", "truncated", "cost", "audit", "least", "most",
        (F.col("illegal") + F.when(F.coalesce(border, F.lit("su")).isin("su", "ua", "au"), 0).otherwise(1)).alias("illegal"),
        (F.col("n_turns") - shared).alias("n_turns"),
    )
    summed = bordered.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "n_turns")],
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x.audit), "").alias("audit"),
    )
    joined = summed.withColumn("gaps", gaps).join(_hashed(several.select("conv", "block", "chunk")), "conv")
    return single.unionByName(joined.select("conv", *columns))
