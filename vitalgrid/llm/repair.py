"""Conversation structure repair by the auction shortest-path algorithm.

A conversation is a lattice: a node is a number of rows consumed and what the roles so far allow next; arcs keep, rerole,
delete or insert a turn at integer costs. The auction keeps a price for each node and a path of tight arcs from the
origin: while the path's end can be continued at its price, the path is extended, else the price rises to what the best
arc asks and the path is contracted. When the path arrives, the prices are a dual solution: every arc of every cheapest
path is tight, and the tight arcs are traced in lexicographic order.

Long conversations are cut into chunks of rows. A chunk is solved from each state it may be entered in to each state it
may be left in; a conversation then chains a few numbers a chunk, and every chunk writes its own part of the result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.session import stored

#: Rows solved together.
CHUNK = 64
BLANK = "[^\\x20\\x09-\\x0D]"
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role a state asks for, and the state that role leads to.
ASKS, THEN = "uuau", (USER, USER, ASSISTANT, USER)
ROLE = {"u": "user", "a": "assistant"}
DELETE, RELABEL, INSERT, UNFINISHED = 3, 2, 2, 1
#: What ends a conversation from each state: cost and edits.
TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows after damage by the check sum of id and turn; nulls are one space."""
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn))) % 20
    done = (F.when(fate == 1, "").when(fate == 2, F.regexp_replace(plain(text), "[.!?]", "")).otherwise(plain(text)))
    return (turns.withColumn("fate_", fate).filter("fate_ <> 0")
            .select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.when(F.col("fate_") == 4, "user").otherwise(plain(role)).alias("role"),
                    done.alias("text"), F.when(F.col("fate_") == 3, 2).otherwise(1).cast("long").alias("copies")))


def judged(rows: DataFrame) -> DataFrame:
    """conv_id (never null), turn, role, text, copies and ``fault`` of the first copy; further copies are duplicates, or blank too.

    Rows that repeat conversation, turn, role and text are counted into one, and the first turn of a role and text is a
    minimum by key: both are added up where rows are read, so that a crowd of copies is a few rows.
    """
    keys = ["conv_id", "role", "text"]
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    whole = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    several = (whole.groupBy(*keys).agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1")
               .select(*keys, "first"))
    last = F.substring(F.regexp_extract(F.reverse("text"), BLANK, 0), 1, 1)
    seen = F.col("first").isNotNull() & (F.col("first") != at)
    return (whole.join(several, keys, "left")
            .withColumn("fault", F.when(~F.rlike("text", F.lit(BLANK)), "blank").when(seen, "duplicate")
                        .when(~last.isin(".", "!", "?"), "truncated").otherwise("none")).drop("first"))


def arcs(symbols: str) -> list[list[tuple[int, str, int]]]:
    """For node 4 * rows consumed + state: cost, edit and head of its arcs, in the order of the edits' initials.

    A symbol is x for a row that must go, else its role's initial (any other: o), in upper case if it is truncated.
    Insertions stand before the row they precede; none follow the last row.
    """
    out = []
    for i, x in enumerate(symbols):
        extra, initial = (UNFINISHED if x.isupper() else 0), x.lower()
        for state in range(4):
            own = [(DELETE, "D", 4 * (i + 1) + state), (INSERT, "I", 4 * i + THEN[state])]
            if initial == ASKS[state]:
                own.append((extra, "K", 4 * (i + 1) + THEN[state]))
            elif initial == "s" and state == START:
                own.append((extra, "K", 4 * (i + 1) + SYSTEM))
            if initial != "x":
                own.append((RELABEL + extra, "R", 4 * (i + 1) + THEN[state]))
            out.append(own)
    return out + [[] for _ in range(4)]


def reaching(graph: list, goal: int, tight=None) -> list[bool]:
    """Nodes from which ``goal`` can be reached, over all arcs or those with tight(node, cost, head)."""
    good = [False] * len(graph)
    good[goal] = True
    for layer in range(len(graph) - 4, -1, -4):
        for _ in range(3):  # insertions stay in a layer and lead at most twice to a new state
            for node in range(layer, layer + 4):
                good[node] = good[node] or any(good[h] and (tight is None or tight(node, c, h)) for c, _, h in graph[node])
    return good


def auction(graph: list, price: list[int], origin: int, goal: int) -> int:
    """Cost of the cheapest path; raises ``price``, which stays at most arc cost plus the head's price on every arc."""
    path = [origin]
    while path[-1] != goal:
        node = path[-1]
        least, head = min((c + price[h], h) for c, _, h in graph[node])
        if price[node] < least:
            price[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)
    return price[origin] - price[goal]


@lru_cache(maxsize=20_000)
def solved(symbols: str) -> tuple:
    """For each state at the entry, by state at the exit: cost and the least edits of a chunk, None if there is no way."""
    whole, n = arcs(symbols), len(symbols)
    floor = [0]  # least cost of the rows from each row on: prices no cheapest path can be below
    for x in reversed(symbols):
        floor.append(floor[-1] + (DELETE if x == "x" else x.isupper() + (RELABEL if x.lower() == "o" else 0)))
    found = [[None] * 4 for _ in range(4)]
    for leave in range(4):
        goal = 4 * n + leave
        good = reaching(whole, goal)
        graph = [[a for a in own if good[a[2]]] for own in whole]
        price = [floor[n - node // 4] for node in range(len(whole))]
        enter = [s for s in range(4) if good[s]]
        for state in enter:
            auction(graph, price, state, goal)
        ahead = reaching(graph, goal, lambda node, c, h: price[node] == c + price[h])
        for state in enter:
            node, edits = state, []
            while node != goal:
                _, e, node = next((c, e, h) for c, e, h in graph[node] if price[node] == c + price[h] and ahead[h])
                edits.append(e)
            found[state][leave] = (price[state] - price[goal], "".join(edits))
    return tuple(tuple(x) for x in found)


def symbol(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "truncated" else initial


#: A chunk as stored: counts, first and last initial, its symbols and its rows.
CHUNKS = pa.schema([("run", pa.int64()), ("conv_id", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                    ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("symbols", pa.string()),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
CHUNKS_SQL = ("run long, conv_id string, blank long, duplicate long, truncated long, illegal long, first string, last string, symbols string, "
              "roles array<string>, texts array<string>")
LEGAL = ("su", "ua", "au")


def chunk_of(number: int, conv, rows: list) -> tuple:
    faults, initials = [r[2] for r in rows], [r[0][:1] for r in rows]
    symbols = "".join(symbol(r[0], r[2]) for r in rows)
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return (number, conv, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, initials[0], initials[-1], symbols,
            [r[0] for r, x in zip(rows, symbols) if x != "x"], [r[1] for r, x in zip(rows, symbols) if x != "x"])


def cutter(size: int):
    """Rows of sorted partitions as chunks; numbers ascend with the order of the rows."""
    def cut(batches):
        number, conv, rows = TaskContext.get().partitionId() << 40, object(), []
        for batch in batches:
            out = []
            for c, role, text, fault, copies in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text", "fault", "copies"))):
                if c != conv and rows:
                    out.append(chunk_of(number, conv, rows))
                    number, rows = number + 1, []
                conv = c
                for copy in range(copies):
                    rows.append((role, text, fault if copy == 0 or fault == "blank" else "duplicate"))
                    if len(rows) == size:
                        out.append(chunk_of(number, conv, rows))
                        number, rows = number + 1, []
                    if len(out) == 1_000:
                        yield table_of(out, CHUNKS)
                        out = []
            yield table_of(out, CHUNKS)
        if rows:
            yield table_of([chunk_of(number, conv, rows)], CHUNKS)
    return cut


def table_of(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def crossings(batches):
    """run, conv_id and 16 numbers a chunk: cost by entry and exit, and the rank of its edits among those of the entry."""
    for batch in batches:
        costs, ranks = [], []
        for symbols in batch.column("symbols").to_pylist():
            for own in solved(symbols):
                order = sorted(x[1] for x in own if x)
                costs.append([x[0] if x else -1 for x in own])
                ranks.append([order.index(x[1]) if x else -1 for x in own])
        grouped = [[[y for x in values[4 * k : 4 * k + 4] for y in x] for k in range(batch.num_rows)] for values in (costs, ranks)]
        yield pa.RecordBatch.from_arrays([batch.column("run"), batch.column("conv_id"), *[pa.array(g, pa.list_(pa.int32())) for g in grouped]],
                                         ["run", "conv_id", "costs", "ranks"])


def way_through(costs: list, ranks: list) -> list[tuple[int, int]]:
    """The states in which the chunks of a conversation are entered and left on its cheapest, least path."""
    ahead, choice = [t[0] for t in TAIL], []
    for c, r in zip(reversed(costs), reversed(ranks)):
        best = [min(((c[k] + ahead[k % 4], r[k], k % 4) for k in range(4 * s, 4 * s + 4) if c[k] >= 0 and ahead[k % 4] is not None),
                    default=(None, 0, 0)) for s in range(4)]
        ahead = [b[0] for b in best]
        choice.append([b[2] for b in best])
    enter, states = START, []
    for own in reversed(choice):
        states.append((enter, own[enter]))
        enter = own[enter]
    return states


WAY = pa.schema([("run", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())])


def chained(batches):
    """``way_through`` for conversations whose chunks follow one another."""
    conv, runs, costs, ranks = object(), [], [], []
    for batch in batches:
        out = []
        for c, run, cost, rank in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "run", "costs", "ranks"))):
            if c != conv:
                out += [(r, *s) for r, s in zip(runs, way_through(costs, ranks))]
                conv, runs, costs, ranks = c, [], [], []
            runs.append(run)
            costs.append(cost)
            ranks.append(rank)
        yield table_of(out, WAY)
    yield table_of([(r, *s) for r, s in zip(runs, way_through(costs, ranks))], WAY)


PARTS = pa.schema([("run", pa.int64()), ("conv_id", pa.string()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("lines", pa.list_(pa.string()))])


def edited(symbols: str, edits: str, roles: list, texts: list, state: int) -> list[str]:
    """``role:text`` of the turns that the edits leave or make."""
    lines, row, kept = [], 0, 0
    for e in edits:
        asked = ASKS[state]
        if e == "I":
            lines.append(f"{ROLE[asked]}:")
            state = THEN[state]
            continue
        x = symbols[row].lower()
        row += 1
        if e in "KR":
            lines.append(f"{roles[kept] if e == 'K' else ROLE[asked]}:{texts[kept]}")
            state = SYSTEM if e == "K" and x == "s" else THEN[state]
        kept += x != "x"
    return lines


def written(batches):
    """Cost, edits and repaired lines of each chunk between its states."""
    for batch in batches:
        out = []
        for run, conv, symbols, roles, texts, enter, leave in zip(*(batch.column(k).to_pylist() for k in ("run", "conv_id", "symbols", "roles", "texts", "enter", "leave"))):
            cost, edits = solved(symbols)[enter][leave]
            out.append((run, conv, leave, cost, edits, edited(symbols, edits, roles, texts, enter)))
        yield table_of(out, PARTS)


#: What a conversation has after repair.
ENDS = pa.schema([("c_key", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def ended(batches):
    """Conversations from their parts in order; a long text goes through the hash part by part."""
    conv, digest, edits, cost, leave = object(), None, [], 0, START

    def end():
        state = leave
        for _ in TAIL[leave][1]:
            put(f"{ROLE[ASKS[state]]}:")
            state = THEN[state]
        return conv, cost + TAIL[leave][0], "".join(edits) + TAIL[leave][1], digest[0].hexdigest()

    def put(line):
        digest[0].update((("\n" if digest[1] else "") + line).encode())
        digest[1] = True

    for batch in batches:
        out = []
        for c, own_leave, own_cost, audit, lines in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "leave", "cost", "audit", "lines"))):
            if c != conv:
                if digest:
                    out.append(end())
                conv, digest, edits, cost = c, [hashlib.sha256(), False], [], 0
            for line in lines:
                put(line)
            edits.append(audit)
            cost, leave = cost + own_cost, own_leave
        yield table_of(out, ENDS)
    if digest:
        yield table_of([end()], ENDS)


def repaired(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of ``turns``.

    Rows are damaged first (see ``damaged``). They are ordered by turn, null turns first; rows of one turn by role and text.
    Null ids are one conversation. A role's initial is its first character; an empty role has none and can only be
    reroled or deleted. Conversations without rows after damage have zeros, no edits and the hash of the empty text. An
    empty table gives no rows; other columns are not looked at.

    Rows are dealt by ranges of id and turn, so that one conversation of very many rows is spread over many tasks; what
    then meets for a conversation is some forty numbers for each chunk, and its result, which passes through one task.
    """
    rows = stored(judged(damaged(turns, conv, turn, role, text).withColumn("conv_id", F.to_json(F.struct("conv_id")))), "turns-judged")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    chunks = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("conv_id", "role", "text", "fault", "copies").mapInArrow(cutter(chunk), CHUNKS_SQL), "turn-chunks")
    way = (chunks.select("run", "conv_id", "symbols").mapInArrow(crossings, "run long, conv_id string, costs array<int>, ranks array<int>")
           .repartition("conv_id").sortWithinPartitions("conv_id", "run").mapInArrow(chained, "run long, enter int, leave int"))
    pieces = (chunks.select("run", "conv_id", "symbols", "roles", "texts").join(way, "run")
              .mapInArrow(written, "run long, conv_id string, leave int, cost long, audit string, lines array<string>"))
    ends = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "run")
            .mapInArrow(ended, "c_key string, cost long, audit string, repaired_sha256 string"))
    beside = F.lag("last").over(Window.partitionBy("conv_id").orderBy("run"))
    joint = F.when(beside.isNotNull() & ~F.concat(beside, "first").isin(*LEGAL), 1).otherwise(0)
    counts = (chunks.select("conv_id", "run", "blank", "duplicate", "truncated", "illegal", "first", "last").withColumn("joint", joint).groupBy("conv_id")
              .agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("joint")).alias("illegal")))
    span = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    found = counts.join(span, "conv_id").join(ends, F.col("conv_id") == F.col("c_key")).drop("c_key").withColumnRenamed("conv_id", "key_")
    every = turns.select(F.col(conv).alias("conv_id")).distinct().withColumn("own_", F.to_json(F.struct("conv_id")))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (every.join(found, F.col("own_") == F.col("key_"), "left")
            .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
