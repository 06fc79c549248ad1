"""Conversation structure repair by banded target alignment.

A conversation should read ``(s?(ua)+)?`` in role initials.  Its turns are aligned, Wagner-Fischer
fashion, to every feasible length of that alternating string.  The lengths of one parity are prefixes
of each other, so one table for each parity holds them all; Ukkonen's band around the diagonal follows
from the cost of an incumbent, a greedy repair.  Cells on cheapest paths are marked backwards and the
ASCII-least audit is read forwards, then the audits of both parities are compared.

Rows are sorted once, by ranges of (conversation, turn, ...).  A conversation inside a task and of at
most one block is repaired there.  The others, cut by a range border or long, become blocks that are
aligned apart: a block's costs from each entry state to each exit state form a small matrix, a
backward pass over matrices yields what every exit still costs, and with that each block finds its own
audits.  Only the digest and the audit of a conversation, which the result wants in one piece, are
put together in order, one block in memory at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import scratch_path

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 18
#: Characters of a text that take part in the ranges by which rows are dealt out.
RANGE_CHARS = 64
FAR = 1 << 40

# States are what the repaired rows so far end with: nothing, or a role initial.
START, STATES = "", ("", "s", "u", "a")
ROLE = {"u": "user", "a": "assistant"}
#: Cost of ending in a state: trailing inserts complete the last pair.
CLOSING = {"": 0, "s": 2 * INSERT, "u": INSERT, "a": 0}
#: No two states differ by more in what the rest of a conversation costs.
GAP = 10


def following_role(state: str) -> str:
    return "a" if state == "u" else "u"


def greedy(initials: list[str], kinds: str, entry: str) -> tuple[int, str]:
    """Cost and exit state of a plain repair: keep what fits, insert before what does not."""
    cost, state = 0, entry
    for c, kind in zip(initials, kinds):
        extra, want = TRUNCATED * (kind == "t"), following_role(state)
        if kind == "x":
            cost += DELETE
        elif c == want or (c == "s" and state == START):
            cost, state = cost + extra, c
        elif c in ROLE:
            cost, state = cost + INSERT + extra, c
        elif REROLE + extra < DELETE:
            cost, state = cost + REROLE + extra, want
        else:
            cost += DELETE
    return cost, state


class Table:
    """Alignment of a block's turns to all lengths of one target: ``lead`` (nothing or s), then users
    and assistants in turn, as they follow the entry state.

    ``rows[i]`` holds the costs of the first i turns against the slots from ``low[i]`` on, as far as a
    path within ``bound`` can lie; the last row ends on a turn, not on an insert."""

    def __init__(self, initials: list[str], kinds: str, entry: str, lead: str, bound: int):
        self.initials, self.kinds, self.entry = initials, kinds, entry
        n, free = len(kinds), [0]
        for k in kinds:
            free.append(free[-1] + (k != "x"))
        late = kinds.count("t")
        slack = max(0, bound - DELETE * (n - free[-1]) - TRUNCATED * late)
        down = slack if slack <= late else late + (slack - late) // DELETE
        up = slack // INSERT
        first = following_role(entry)
        self.slots = lead + (first + following_role(first)) * ((free[-1] + up) // 2 + 2)
        self.low = [max(0, m - down) for m in free]
        self.rows = [[0 if j == 0 else FAR if lead else INSERT * j for j in range(up + 1)]]
        for i in range(n):
            cells, prev, at = [], self.rows[-1], self.low[i]
            for j in range(self.low[i + 1], free[i + 1] + up + 1):
                best = prev[j - at] + DELETE if at <= j < at + len(prev) else FAR
                if j and at <= j - 1 < at + len(prev):
                    best = min(best, prev[j - 1 - at] + self.match(i, j))
                if cells and i + 1 < n and self.slots[j - 1] != "s":
                    best = min(best, cells[-1] + INSERT)
                cells.append(best)
            self.rows.append(cells)

    def match(self, i: int, j: int) -> int:
        """Cost of turn i in slot j (from 1): kept or reroled."""
        kind, slot = self.kinds[i], self.slots[j - 1]
        if kind == "x" or (slot == "s" and self.initials[i] != "s"):
            return FAR
        return (0 if self.initials[i] == slot else REROLE) + TRUNCATED * (kind == "t")

    def cost(self, i: int, j: int) -> int:
        k = j - self.low[i]
        return self.rows[i][k] if 0 <= k < len(self.rows[i]) else FAR

    def state(self, j: int) -> str:
        return self.slots[j - 1] if j else self.entry

    def exits(self) -> Iterator[tuple[int, str, int]]:
        """(slots, exit state, cost) of each length."""
        for k, cost in enumerate(self.rows[-1]):
            if cost < FAR:
                yield self.low[-1] + k, self.state(self.low[-1] + k), cost

    def least_audit(self, ends: set[int]) -> tuple[str, str]:
        """ASCII-least of the cheapest audits that end at one of the lengths ``ends``, with its exit."""
        n = len(self.kinds)
        marked = [set() for _ in range(n)] + [set(ends)]
        for i in range(n, -1, -1):
            for j in sorted(marked[i], reverse=True) if i == n else _descending(marked[i]):
                here = self.cost(i, j)
                if i and self.cost(i - 1, j) + DELETE == here:
                    marked[i - 1].add(j)
                if i and j and self.cost(i - 1, j - 1) + self.match(i - 1, j) == here:
                    marked[i - 1].add(j - 1)
                if i < n and j and self.slots[j - 1] != "s" and self.cost(i, j - 1) + INSERT == here:
                    marked[i].add(j - 1)
        audit, i, j = [], 0, 0
        while i < n:
            here = self.cost(i, j)
            if j in marked[i + 1] and here + DELETE == self.cost(i + 1, j):
                audit.append("D")
                i += 1
            elif j + 1 in marked[i] and self.slots[j] != "s" and here + INSERT == self.cost(i, j + 1):
                audit.append("I")
                j += 1
            else:
                audit.append("K" if self.initials[i] == self.slots[j] else "R")
                i, j = i + 1, j + 1
        return "".join(audit), self.state(j)


def _descending(cells: set[int]) -> Iterator[int]:
    """Members from the largest down, those included that are added below the current one."""
    j = max(cells, default=-1)
    while j >= 0:
        if j in cells:
            yield j
        j -= 1


def _tables(initials: list[str], kinds: str, entry: str, bound: int) -> list[Table]:
    return [Table(initials, kinds, entry, lead, bound) for lead in (("", "s") if entry == START else ("",))]


def cost_matrix(initials: list[str], kinds: str) -> list[int]:
    """Least cost of a block from each entry to each exit state, four by four; ``FAR`` where no
    cheapest repair of any conversation can pass."""
    out = []
    for entry in STATES:
        best = dict.fromkeys(STATES, FAR)
        for table in _tables(initials, kinds, entry, greedy(initials, kinds, entry)[0] + GAP):
            for _, state, cost in table.exits():
                best[state] = min(best[state], cost)
        out += best.values()
    return out


def align(initials: list[str], kinds: str, entry: str, rest: dict[str, int]) -> tuple[int, str, str]:
    """Cost (with the rest), least audit and exit state of a block, given what each exit still costs."""
    upper, state = greedy(initials, kinds, entry)
    tables = _tables(initials, kinds, entry, upper + rest[state] - min(rest.values()))
    found = [(cost + rest[x], k, j) for k, t in enumerate(tables) for j, x, cost in t.exits()]
    best = min(found)[0]
    ends = {k: {j for c, q, j in found if c == best and q == k} for k in range(len(tables))}
    return best, *min(t.least_audit(ends[k]) for k, t in enumerate(tables) if ends[k])


def repaired_lines(audit: str, roles: list[str], texts: list[bytes], state: str) -> Iterator[bytes]:
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        state = roles[at][:1] if edit == "K" else following_role(state)
        role = roles[at] if edit == "K" else ROLE[state]
        yield role.encode() + b":" + (b"" if edit == "I" else texts[at])
        at += edit != "I"


def kind_of(text: bytes, repeated: bool) -> str:
    """x blank, d duplicate, t truncated, . sound."""
    words = text.strip()  # of 0x20 and 0x09-0x0D
    return "x" if not words else "d" if repeated else "." if words[-1:] in (b".", b"!", b"?") else "t"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def edit_kinds(kinds: str) -> str:
    return kinds.replace("d", "x")


class Piece:
    """Consecutive rows of one conversation."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[bytes] = []
        self.turns = [None, None, 0]  # first, last, distinct; rows come in order of turn
        self.bytes = 0

    def add(self, turn, role: str, text: bytes, copies: int) -> None:
        for _ in range(copies):
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text)
        if copies and turn is not None:
            first, last, distinct = self.turns
            self.turns = [turn if first is None else first, turn, distinct + (turn != last)]

    def full(self, block_rows: int) -> bool:
        return len(self.roles) >= block_rows or self.bytes >= BLOCK_BYTES

    def kinds(self, seen: set[bytes] = frozenset()) -> str:
        known, out = set(seen), []
        for role, text in zip(self.roles, self.texts):
            d = digest(role, text)
            out.append(kind_of(text, d in known))
            known.add(d)
        return "".join(out)


def digest(role: str, text: bytes) -> bytes:
    name = role.encode()
    return hashlib.sha256(b"%d:%s%s" % (len(name), name, text)).digest()[:16]


def _gaps(first, last, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


def repair(piece: Piece) -> dict:
    """The result of a whole conversation."""
    initials, kinds = [r[:1] for r in piece.roles], piece.kinds()
    cost, audit, lines = 0, "", []
    if kinds:
        cost, audit, state = align(initials, edit_kinds(kinds), START, CLOSING)
        audit += "I" * (CLOSING[state] // INSERT)
        lines = repaired_lines(audit, piece.roles, piece.texts, START)
    return _result(_gaps(*piece.turns), kinds, illegal_pairs(initials), cost, audit, hashlib.sha256(b"\n".join(lines)))


def _result(gaps: int, kinds: str, illegal: int, cost: int, audit: str, sha) -> dict:
    return {
        "gaps": gaps, "blank": kinds.count("x"), "duplicate": kinds.count("d"), "truncated": kinds.count("t"),
        "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": sha.hexdigest(),
    }


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SORTED = f"key string, {RESULT}, block long, roles array<string>, texts array<binary>, turns array<bigint>, digests array<binary>"


def _emit(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 2000, weigh: Callable[[dict], int] = lambda r: 1):
    """Arrow batches of about ``most`` rows or a block of bytes."""
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += weigh(r)
        if len(held) >= most or weight >= BLOCK_BYTES:
            yield _emit(held, schema)
            held, weight = [], 0
    yield _emit(held, schema)


TYPES = {
    "string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64()),
}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, TYPES[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            yield from batch.slice(k, 64).to_pylist()


def _cut(block_rows: int):
    """Results of conversations that lie whole in a task and in one block, blocks of the others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = _pieces(_rows(batches), TaskContext.get().partitionId() << 32, block_rows)
        return _batched(rows, _arrow(SORTED), weigh=lambda r: sum(map(len, r.get("texts") or ())))

    return cut


def _pieces(rows: Iterator[dict], number: int, block_rows: int) -> Iterator[dict]:
    key, piece, first, cut = None, Piece(), True, False

    def block() -> dict:
        return {
            "key": key, "block": number, "roles": piece.roles, "texts": piece.texts,
            "turns": piece.turns, "digests": [digest(r, t) for r, t in zip(piece.roles, piece.texts)],
        }

    for r in rows:
        same = r["key"] == key
        if key is not None and (not same or piece.full(block_rows)):
            if same or first or cut:  # more of it follows, or may stand in the task before
                yield block()
                number += 1
            else:
                yield {"key": key} | repair(piece)
            first, cut, piece = first and same, same, Piece()
        key = r["key"]
        piece.add(r["turn"], r["role"], r["text"], r["copies"])
    if key is not None:
        yield block()


ALIGNED = "key string, block long, roles array<string>, kinds string, costs array<bigint>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        for r in _rows(batches):
            piece = Piece()
            piece.roles, piece.texts = r["roles"], r["texts"]
            kinds = piece.kinds(set(r["seen"] or ()))
            yield {
                "key": r["key"], "block": r["block"], "roles": [x[:1] for x in piece.roles], "kinds": kinds,
                "costs": cost_matrix([x[:1] for x in piece.roles], edit_kinds(kinds)) if kinds else None,
            }

    return _batched(found(), _arrow(ALIGNED))


RESTED = "key string, block long, roles array<string>, kinds string, rest array<bigint>"


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each exit of a block still costs; blocks come last first."""

    def found() -> Iterator[dict]:
        key, rest = None, []
        for r in _rows(batches):
            if r["key"] != key:
                key, rest = r["key"], list(CLOSING.values())
            yield {k: r[k] for k in ("key", "block", "roles", "kinds")} | {"rest": rest}
            if r["costs"]:
                rest = [min(r["costs"][4 * e + x] + rest[x] for x in range(4)) for e in range(4)]

    return _batched(found(), _arrow(RESTED))


AUDITED = "key string, block long, kinds string, audits array<string>, exits array<string>, totals array<bigint>"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        for r in _rows(batches):
            out = {"key": r["key"], "block": r["block"], "kinds": r["kinds"]}
            if r["kinds"]:
                rest = dict(zip(STATES, r["rest"]))
                each = [align(r["roles"], edit_kinds(r["kinds"]), entry, rest) for entry in STATES]
                out |= {"totals": [x[0] for x in each], "audits": [x[1] for x in each], "exits": [x[2] for x in each]}
            yield out

    return _batched(found(), _arrow(AUDITED))


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose blocks come in order; one block is held at a time."""

    def found() -> Iterator[dict]:
        key, done = None, None
        for r in _rows(batches):
            if r["key"] != key:
                if done:
                    yield done()
                key, state, sha, empty, cost, audit = r["key"], START, hashlib.sha256(), True, 0, []
                counts, illegal, last, span = dict.fromkeys("xdt", 0), 0, None, [None, None, 0]

                def done() -> dict:
                    tail = "I" * (CLOSING[state] // INSERT)
                    for line in repaired_lines(tail, [], [], state):
                        sha.update(b"\n" + line)
                    out = _result(_gaps(*span), "", illegal, cost, "".join(audit) + tail, sha)
                    return {"key": key} | out | {"blank": counts["x"], "duplicate": counts["d"], "truncated": counts["t"]}

            first, end, distinct = r["turns"]
            if first is not None:
                span = [first if span[0] is None else span[0], end, span[2] + distinct - (span[1] == first)]
            if r["kinds"]:
                initials = [x[:1] for x in r["roles"]]
                illegal += illegal_pairs(initials if last is None else [last, *initials])
                last = initials[-1]
                for k in counts:
                    counts[k] += r["kinds"].count(k)
                at = STATES.index(state)
                cost = r["totals"][at] if not audit else cost
                audit.append(r["audits"][at])
                for line in repaired_lines(audit[-1], r["roles"], r["texts"], state):
                    sha.update(line if empty else b"\n" + line)
                    empty = False
                state = r["exits"][at]
        if done:
            yield done()

    return _batched(found(), _arrow(f"key string, {RESULT}"), weigh=lambda r: len(r["audit"]))


def damaged(rows: DataFrame) -> DataFrame:
    """``key, turn, role, text, copies``: rows after damage by the checksum of conversation and turn;
    dropped rows stay with 0 copies, so that their conversation is not lost."""
    draw = F.crc32(F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"), draw.alias("draw"), role.alias("role"), text.alias("text"),
    )
    return rows.select(
        "key", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw").isin(0, 1), "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1).alias("copies"),
    )


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation of ``damaged``-like ``rows(key, turn, role, text, copies)``:
    ``key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows stand by turn, nulls first; rows of one turn by role and text, in code point order, so that
    equal rows are adjacent and any of them is the duplicate.  An empty role has no initial and fits no
    slot.  Turns may repeat, be negative or null (they then count for no gap).  Texts of any length;
    a conversation of any length is aligned in blocks of ``block_rows``.  Empty table: no rows."""
    spark = rows.sparkSession
    order = ["key", F.col("turn").asc_nulls_first(), "role"]
    path = scratch_path(spark, "conversations")
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions(*order, "text")
    dealt.withColumn("text", F.col("text").cast("binary")).mapInArrow(_cut(block_rows), SORTED).write.parquet(path)
    cut = spark.read.schema(SORTED).parquet(path)
    names = [x.split()[0] for x in RESULT.split(", ")]
    whole = cut.where("block IS NULL").select("key", *names)

    pieces = cut.where("block IS NOT NULL")
    texts = pieces.select("key", "block", F.explode("digests").alias("digest")).distinct()
    firsts = texts.groupBy("key", "digest").agg(F.min("block").alias("first"))
    seen = (
        texts.join(firsts, ["key", "digest"]).where("block > first")
        .groupBy("key", "block").agg(F.collect_list("digest").alias("seen"))
    )
    aligned = pieces.select("key", "block", "roles", "texts").join(seen, ["key", "block"], "left").mapInArrow(_blocks, ALIGNED)
    rested = aligned.repartition("key").sortWithinPartitions("key", F.col("block").desc()).mapInArrow(_backward, RESTED)
    audits = rested.repartition("key", "block").mapInArrow(_audits, AUDITED)
    joined = pieces.select("key", "block", "roles", "texts", "turns").join(audits, ["key", "block"])
    chained = joined.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_forward, f"key string, {RESULT}")
    return whole.unionByName(chained)


def damaged_and_repaired(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``conv_id`` and the result columns for every conversation of ``conversations(conv_id, turn, role,
    text)``, null among them, after ``damaged``.  A conversation that lost all rows has zeros, an empty
    audit and the digest of nothing.  Other columns are not read."""
    kind = conversations.schema["conv_id"].dataType
    out = repair_conversations(damaged(conversations), block_rows)
    conv = F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(kind)
    return out.select(conv.alias("conv_id"), *[c for c in out.columns if c != "key"])


def oracle_sql() -> str:
    """Damage and repair in DuckDB SQL: a turn at a time, with the cheapest repair for each state."""
    step = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    for _ in range(7):
        step = f"list_transform([{step}], lambda x: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(k, '')]), "
        f"lambda s, b: list_transform([xor(s, b)], lambda x: {step})[1]), 4294967295)"
    )

    def moved(base: str, cost: str, edits: str, line: str) -> str:
        return f"CASE WHEN {base} IS NOT NULL THEN {{'c': {base}.c + {cost}, 'e': {base}.e || '{edits}', 'o': list_append({base}.o, {line})}} END"

    def least(*parts: str) -> str:
        return f"list_min([{', '.join(parts)}])"

    late = f"CASE WHEN kind = 't' THEN {TRUNCATED} ELSE 0 END"
    keep = f"(CASE WHEN kind = 'x' THEN {FAR} ELSE 0 END + {late})"
    line = "role || ':' || text"

    def dropped(base: str) -> str:
        return f"CASE WHEN {base} IS NOT NULL THEN {{'c': {base}.c + {DELETE}, 'e': {base}.e || 'D', 'o': {base}.o}} END"

    def taken(base: str, to: str) -> str:
        fits = f"left(role, 1) = '{to}'"
        lost = FAR if to == "s" else REROLE
        return (
            f"CASE WHEN {base} IS NOT NULL THEN {{'c': {base}.c + {keep} + CASE WHEN {fits} THEN 0 ELSE {lost} END, "
            f"'e': {base}.e || CASE WHEN {fits} THEN 'K' ELSE 'R' END, "
            f"'o': list_append({base}.o, CASE WHEN {fits} THEN {line} ELSE '{ROLE.get(to, '')}:' || text END)}} END"
        )

    # i0 .. ia: states after the inserts before a row, at most two of them.
    pushed = f"""
    SELECT r.*, b0 AS i0, bs AS is_, {least("bu", moved("b0", INSERT, "I", "'user:'"), moved("bs", INSERT, "I", "'user:'"), moved("ba", INSERT, "I", "'user:'"))} AS iu1,
      {least("ba", moved("bu", INSERT, "I", "'assistant:'"))} AS ia1
    FROM walk w JOIN faults r ON r.key = w.key AND r.place = w.place + 1"""
    return f"""
WITH RECURSIVE base AS (
  SELECT coalesce('=' || conv_id, '') AS key, conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
drawn AS (SELECT *, {crc} % 20 AS draw FROM base),
damaged AS (
  SELECT key, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged),
faults AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN 't' ELSE '.' END AS kind FROM (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY key ORDER BY place) || left(role, 1) AS pair FROM placed)),
walk AS (
  SELECT key, CAST(0 AS BIGINT) AS place, {{'c': CAST(0 AS BIGINT), 'e': '', 'o': CAST([] AS VARCHAR[])}} AS b0,
    CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, o VARCHAR[])) AS bs, CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, o VARCHAR[])) AS bu,
    CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, o VARCHAR[])) AS ba FROM (SELECT DISTINCT key FROM faults)
  UNION ALL
  SELECT key, place, {dropped("i0")}, {least(dropped("is_"), taken("i0", "s"))},
    {least(dropped("iu"), taken("i0", "u"), taken("is_", "u"), taken("ia", "u"))}, {least(dropped("ia"), taken("iu", "a"))}
  FROM (SELECT *, {least("iu1", moved("ia1", INSERT, "I", "'user:'"))} AS iu, {least("ia1", moved("iu1", INSERT, "I", "'assistant:'"))} AS ia
    FROM ({pushed}))),
ended AS (
  SELECT w.key, list_min([b0, ba, {moved("bu", INSERT, "I", "'assistant:'")}, {moved("bs", INSERT, "I", "'user:'").replace("'I'", "'II'").replace(f"bs.c + {INSERT}", f"bs.c + {2 * INSERT}").replace("list_append(bs.o, 'user:')", "list_concat(bs.o, ['user:', 'assistant:'])")}]) AS best
  FROM walk w JOIN (SELECT key, max(place) AS place FROM faults GROUP BY key) m ON w.key = m.key AND w.place = m.place),
counted AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY key)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.e, '') AS audit,
  sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT key, conv_id FROM base) b LEFT JOIN counted c ON b.key = c.key LEFT JOIN ended e ON b.key = e.key
"""
