"""Conversation repair: the cheapest edits that give a conversation a legal order of roles, with an audit of them.

A repaired conversation's role initials are ``(s?(ua)+)?``. Keep costs 0, Rerole to user or assistant 1, Delete 2
(required for blank rows and duplicates), Insert of an empty user or assistant row 5, and a truncated row that stays 5
more. The audit is the edits' initials in order; of the cheapest, the one that is least in ASCII.

Method: run-length DP over the four states of the order (start, after system, user, assistant). A row is a symbol, its
role class and fault; equal consecutive symbols are one run. A symbol is a 4 x 4 min-plus transition (its edits, after any
inserts); a run of n is the product of the cached binary powers that n is made of. Costs to go are taken through the
runs from behind; then the choices are unrolled from the front, at each row the least letter that keeps the cost.

Scale: rows get their places by ranges (``common.positions``), and ``CHUNK`` consecutive rows of a conversation are one
product of runs, so a conversation of any length is spread over many tasks. What goes through a conversation in order
is one slim row per chunk (backwards, carrying four numbers) and at last its rows, streamed in sorted order into the
digest of the repaired text and into the audit, which are single values by definition; nothing is collected.

Defined results: NULL role or text is one space, and so is a NULL conv_id or turn in the text the damage hashes; a NULL
conv_id is a conversation; rows of one turn stand by role, then text's MD5; a role of other initials is never kept; a
conversation without rows left has zeros, an empty audit and the digest of nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, positions, written
from .merkle import CRC32

CHUNK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Fixed: states and the state after a user, assistant or system row; -1 where the order forbids it.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1), "s": (SYSTEM, -1, -1, -1), "x": (-1,) * 4}
_NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted or reroled row leads
_ENDS = (START, ASSISTANT)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 50

#: A symbol is one letter: role class, capital for truncated rows, ``-`` for rows that must go.
SYMBOLS = "uasxUASX-"


def _options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row, without inserts, least letter first."""
    out = [("D", DELETE, state)]
    if symbol == "-":
        return out
    more, kind = (TRUNCATED, symbol.lower()) if symbol.isupper() else (0, symbol)
    if _AFTER[kind][state] >= 0:
        out.append(("K", KEEP + more, _AFTER[kind][state]))
    return [*out, ("R", REROLE + more, _NEXT[state])]


def _closed() -> np.ndarray:
    """Cheapest ways between states by inserts alone."""
    out = np.full((4, 4), _FAR, np.int64)
    for s in range(4):
        cost, at = 0, s
        while cost <= 4 * INSERT:
            out[s, at] = min(out[s, at], cost)
            cost, at = cost + INSERT, _NEXT[at]
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _FAR)


@lru_cache(maxsize=None)
def _power(symbol: str, k: int) -> np.ndarray:
    """The transition of 2^k rows of ``symbol``."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    step = np.full((4, 4), _FAR, np.int64)
    for s in range(4):
        for _, cost, to in _options(symbol, s):
            step[s, to] = min(step[s, to], cost)
    return _times(_closed(), step)


def runs(symbols: str) -> list[tuple[str, int]]:
    """Equal consecutive symbols: (symbol, length)."""
    codes = np.frombuffer(symbols.encode(), np.uint8)
    at = np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)])) if len(codes) else np.zeros(1, int)
    return [(symbols[a], int(b - a)) for a, b in zip(at[:-1], at[1:])]


def product(symbols: str) -> np.ndarray:
    """The transition of a whole chunk."""
    out = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int64)
    for symbol, n in runs(symbols):
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = _times(out, _power(symbol, k))
    return out


def ending() -> np.ndarray:
    """Cost to go from each state when no row is left."""
    return _closed()[:, list(_ENDS)].min(1)


def through(transition: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Cost to go in front of ``transition`` from the cost to go behind it."""
    return np.minimum((transition + cost[None, :]).min(1), _FAR)


def unrolled(symbols: str, cost: np.ndarray, state: int) -> Iterator[tuple[str, list[str], int]]:
    """For every row: the letters of its edits (inserts before it, last its own), the roles inserted and the state
    after it; ``cost`` is the cost to go behind the chunk, ``state`` the state in front of it."""
    todo, behind = runs(symbols), [cost]
    for symbol, n in reversed(todo):  # cost to go behind each run, by powers
        for k in range(n.bit_length()):
            if n >> k & 1:
                cost = through(_power(symbol, k), cost)
        behind.append(cost)
    behind.pop()
    for symbol, n in todo:
        after = [behind.pop().tolist()]
        for _ in range(n - 1):  # inside the run, row by row
            after.append(through(_power(symbol, 0), np.array(after[-1], np.int64)).tolist())
        for left in range(n - 1, -1, -1):
            goal, letters, roles = after[left], "", []
            closed = _closed_options(symbol)
            best = min(cost + goal[to] for cost, _, to, _ in closed[state])
            letters, to, roles = min((w, to, roles) for cost, w, to, roles in closed[state] if cost + goal[to] == best)
            state = to
            yield letters, roles, state


@lru_cache(maxsize=None)
def _closed_options(symbol: str) -> tuple[list[tuple[int, str, int, list[str]]], ...]:
    """By state: (cost, letters, next state, inserted roles) of a row's edits after up to three inserts."""
    out = []
    for state in range(4):
        ways, at, roles = [], state, []
        for inserts in range(4):
            ways += [(inserts * INSERT + cost, "I" * inserts + letter, to, list(roles)) for letter, cost, to in
                     _options(symbol, at)]
            at = _NEXT[at]
            roles.append(_ROLE[at])
        out.append(ways)
    return tuple(out)


def tail(state: int) -> list[str]:
    """Roles inserted behind the last row."""
    roles = []
    while state not in _ENDS:
        state = _NEXT[state]
        roles.append(_ROLE[state])
    return roles


# ---- rows

_FILLED = r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the contract's damage; NULL role and text are one space."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(named.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fate == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" ")))
    times = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text in; out also pos, fault (blank, duplicate, truncated or NULL) and symbol. Written."""
    known = F.sha2(F.concat_ws("|", F.octet_length("role"), "role", "text"), 256)
    slim = written(rows.select("*", known.alias("same"), F.md5(F.col("text").cast("binary")).alias("mark"),
                               F.monotonically_increasing_id().alias("row")), "talk-rows")
    blank = ~F.col("text").rlike(_FILLED)
    ends = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    marks = slim.select("conv_id", "turn", "role", "mark", "same", "row", blank.alias("blank"),
                        (~ends.isin(".", "!", "?")).alias("truncated"))
    placed = written(positions(marks, ["conv_id"], ["turn", "role", "mark", "row"], "talk-order"), "talk-places")
    first = placed.groupBy(F.col("conv_id").alias("_c"), F.col("same").alias("_s")).agg(F.min("pos").alias("_p"))
    rated = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("same") == F.col("_s")))
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("_p"), "duplicate").when(F.col("truncated"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("u", "a", "s"), initial).otherwise("x")
    symbol = F.when(fault.isin("blank", "duplicate"), "-").when(fault == "truncated", F.upper(kind)).otherwise(kind)
    rated = rated.select(F.col("row").alias("_r"), "pos", fault.alias("fault"), kind.alias("kind"), symbol.alias("symbol"))
    return written(slim.join(rated, F.col("row") == F.col("_r")).select(
        "conv_id", "turn", "role", "text", "pos", "fault", "kind", "symbol"), "talk-faults")


_LEGAL = ("su", "ua", "au")


def chunks(rows: DataFrame) -> DataFrame:
    """conv_id, chunk, symbols, ahead (cost to go behind the chunk by state), illegal and start (cost to go in front of
    it from the initial state): a row per chunk. Written."""
    spark = rows.sparkSession
    bounded_batches(spark)
    listed = F.array_sort(F.collect_list(F.struct("pos", "symbol", "kind")))
    each = rows.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(listed.alias("l"))
    each = each.select("conv_id", "chunk", F.array_join(F.transform("l", lambda x: x["symbol"]), "").alias("symbols"),
                       F.array_join(F.transform("l", lambda x: x["kind"]), "").alias("kinds"))
    legal = set(_LEGAL)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = b.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array([product(s).ravel().tolist() for s in b.column(2).to_pylist()], pa.list_(pa.int64())),
                 pa.array([sum(x + y not in legal for x, y in zip(k, k[1:])) for k in kinds], pa.int64()),
                 pa.array([k[0] for k in kinds]), pa.array([k[-1] for k in kinds])],
                names=["conv_id", "chunk", "symbols", "steps", "illegal", "first", "last"])

    parts = map_batches(each, summed, "conv_id long, chunk long, symbols string, steps array<long>, illegal long, "
                                      "first string, last string")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, cost, begins, fresh = None, ending(), "", True
        for b in batches:
            ahead, broken, start = [], [], []
            for c, steps, last, first in zip(*[b.column(k).to_pylist() for k in ("conv_id", "steps", "last", "first")]):
                if fresh or c != conv:
                    conv, cost, begins, fresh = c, ending(), "", False
                ahead.append(cost.tolist())
                broken.append(int(bool(begins) and last + begins not in legal))
                cost, begins = through(np.array(steps, np.int64).reshape(4, 4), cost), first
                start.append(int(cost[START]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(ahead, pa.list_(pa.int64())),
                 pa.array([x + y for x, y in zip(b.column(4).to_pylist(), broken)], pa.int64()),
                 pa.array(start, pa.int64())], names=["conv_id", "chunk", "symbols", "ahead", "illegal", "start"])

    ordered = parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("chunk").desc())
    return written(ordered.mapInArrow(
        back, "conv_id long, chunk long, symbols string, ahead array<long>, illegal long, start long"), "talk-chunks")


def edited(rows: DataFrame, parts: DataFrame, make: Callable[[], tuple], schema: str, names: list[str]) -> DataFrame:
    """Streams every conversation's rows in order with their edits into a sink.

    ``make`` gives (add, end): add(letters, inserted roles, role, text) per row, the conversation's columns from
    end(inserted roles). One chunk's letters and one sink are in memory."""
    bounded_batches(rows.sparkSession)
    kept = F.col("symbol") != "-"
    lines = rows.select("conv_id", "pos", F.lit(1).alias("kind"), F.when(kept, F.col("role")).alias("role"),
                        F.when(kept, F.col("text")).alias("text"), F.lit(None).cast("array<long>").alias("ahead"))
    heads = parts.select("conv_id", (F.col("chunk") * CHUNK).alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast(
        "string").alias("role"), F.col("symbols").alias("text"), "ahead")
    both = lines.union(heads).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
    kinds = [f.dataType for f in rows.sparkSession.createDataFrame([], schema).schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        conv, state, edits, open_ = None, START, iter(()), False
        add = end = None
        done: list[tuple] = []

        def given() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(names)
            types = [pa.int64(), *[to_arrow_type(k) for k in kinds]]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=names)
            done.clear()
            return out

        for b in batches:
            columns = [b.column(k) for k in range(6)]
            for i in range(b.num_rows):
                c = columns[0][i].as_py()
                if not open_ or c != conv:
                    if open_:
                        done.append((conv, *end(tail(state))))
                    (add, end), conv, state, open_ = make(), c, START, True
                if columns[2][i].as_py() == 0:
                    edits = unrolled(columns[4][i].as_py(), np.array(columns[5][i].as_py(), np.int64), state)
                else:
                    letters, inserted, state = next(edits)
                    add(letters, inserted, state, columns[3][i].as_py(), columns[4][i].as_py())
            if len(done) > 500:
                yield given()
        if open_:
            done.append((conv, *end(tail(state))))
        yield given()

    return both.mapInArrow(run, schema)


def _final_role(letter: str, role: str, state: int) -> str:
    return _ROLE[state] if letter == "R" else role


def _digest_sink() -> tuple:
    sha, letters, cost, empty = hashlib.sha256(), [], [0], [True]

    def line(role: str, text: str) -> None:
        sha.update(f"{'' if empty[0] else chr(10)}{role}:{text}".encode())
        empty[0] = False

    def add(word: str, inserted: list[str], state: int, role: str | None, text: str | None) -> None:
        letters.append(word)
        for r in inserted:
            line(r, "")
        if word[-1] != "D":
            line(_final_role(word[-1], role, state), text)

    def end(inserted: list[str]) -> tuple:
        letters.append("I" * len(inserted))
        for r in inserted:
            line(r, "")
        return "".join(letters), sha.hexdigest()

    return add, end


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role, text: the rows of the repaired conversations; ``rows`` are
    conv_id, turn, role, text without NULL roles and texts (as ``damaged`` gives them)."""
    rated = faults(rows)

    def sink() -> tuple:
        out: list[dict] = []

        def add(word: str, inserted: list[str], state: int, role: str | None, text: str | None) -> None:
            out.extend({"edit": "I", "role": r, "text": ""} for r in inserted)
            if word[-1] != "D":
                out.append({"edit": word[-1], "role": _final_role(word[-1], role, state), "text": text})

        def end(inserted: list[str]) -> tuple:
            out.extend({"edit": "I", "role": r, "text": ""} for r in inserted)
            return (out,)

        return add, end

    schema = "conv_id long, lines array<struct<edit:string,role:string,text:string>>"
    whole = edited(rated, chunks(rated), sink, schema, ["conv_id", "lines"])
    return whole.select("conv_id", F.posexplode("lines").alias("place", "l")).select("conv_id", "place", "l.*")


def digest(rows: DataFrame) -> DataFrame:
    """The contract's row for every original conversation."""
    rated = faults(damaged(rows))
    parts = chunks(rated)
    texts = edited(rated, parts, _digest_sink, "conv_id long, audit string, repaired_sha256 string",
                   ["conv_id", "audit", "repaired_sha256"])

    def of(name: str) -> Column:
        return F.count(F.when(F.col("fault") == name, 1)).alias(name)

    facts = rated.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1).alias("_span"), of("blank"), of("duplicate"), of("truncated"))
    turns = rated.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.count("*").alias("_turns"))
    order = parts.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.min_by("start", "chunk").alias("cost"))
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for k, more in enumerate((facts, turns, order, texts)):
        more = more.withColumnRenamed("conv_id", f"_c{k}")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col(f"_c{k}")), "left")
    zero = F.lit(0).cast("long")
    return out.select("conv_id", F.coalesce(F.col("_span") - F.col("_turns"), zero).alias("gaps"),
                      *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


ORACLE = f"""
with recursive base as (
  select row_number() over () as r, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {CRC32.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as fate
  from conversations),
hurt as (
  select r, conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case fate when 0 then 0 when 3 then 2 else 1 end)) as copy
  from base),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), r, copy) as p from hurt),
rated as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
                 when row_number() over (partition by conv_id, role, text order by p) > 1 then 'duplicate'
                 when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated' end as fault,
         left(role, 1) as ini, lag(left(role, 1)) over (partition by conv_id order by p) as before
  from placed),
-- states: 0 start, 1 after system, 2 user, 3 assistant; k inserts first, then the row's own edit
moves(state, ini, letter, after_, price) as (values
  (0, 'u', 'K', 2, 0), (1, 'u', 'K', 2, 0), (3, 'u', 'K', 2, 0), (2, 'a', 'K', 3, 0), (0, 's', 'K', 1, 0),
  (0, '*', 'R', 2, 1), (1, '*', 'R', 2, 1), (2, '*', 'R', 3, 1), (3, '*', 'R', 2, 1),
  (0, '*', 'D', 0, 2), (1, '*', 'D', 1, 2), (2, '*', 'D', 2, 2), (3, '*', 'D', 3, 2)),
inserts(state, n, to_) as (values (0,0,0),(1,0,1),(2,0,2),(3,0,3),(0,1,2),(1,1,2),(2,1,3),(3,1,2),(0,2,3),(1,2,3),(2,2,2),
  (3,2,3)),
edits as (
  select i.state, m.ini, m.letter, m.after_, i.n, repeat('I', i.n) || m.letter as word, 5 * i.n + m.price as price
  from inserts i join moves m on m.state = i.to_),
dp(conv_id, p, state, cost, audit, said) as (
  select conv_id, 0::bigint, 0, 0, '', null::varchar from (select distinct conv_id from rated)
  union all
  select conv_id, p, after_, least_.cost, least_.audit, least_.said from (
    select d.conv_id, d.p + 1 as p, e.after_,
           min(struct_pack(cost := d.cost + e.price + case when e.letter <> 'D' and r.fault = 'truncated' then 5 else 0 end,
               audit := d.audit || e.word,
               said := case when e.letter = 'D' and e.n = 0 then d.said else concat_ws(chr(10), d.said,
                 case when e.n > 0 then case d.state when 2 then 'assistant:' else 'user:' end end,
                 case when e.n > 1 then case d.state when 2 then 'user:' else 'assistant:' end end,
                 case when e.letter <> 'D' then case when e.letter = 'K' then r.role
                   when e.after_ = 3 then 'assistant' else 'user' end || ':' || r.text end) end)) as least_
    from dp d join rated r on r.conv_id is not distinct from d.conv_id and r.p = d.p + 1
    join edits e on e.state = d.state and e.ini in ('*', r.ini)
    where e.letter = 'D' or r.fault is null or r.fault = 'truncated'
    group by d.conv_id, d.p, e.after_)),
ends(state, price, word, said) as (values (0, 0, '', null), (3, 0, '', null), (2, 5, 'I', 'assistant:'),
  (1, 10, 'II', 'user:' || chr(10) || 'assistant:')),
lengths as (select conv_id, max(p) as n from rated group by conv_id),
best as (
  select d.conv_id, min(struct_pack(cost := d.cost + e.price, audit := d.audit || e.word,
                        said := concat_ws(chr(10), d.said, e.said))) as b
  from dp d join lengths l on l.conv_id is not distinct from d.conv_id and d.p = l.n join ends e on e.state = d.state
  group by d.conv_id),
facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
         count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where before is not null and before || ini not in ('su', 'ua', 'au')) as illegal
  from rated group by conv_id)
select c.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank,
       coalesce(f.duplicate, 0)::bigint as duplicate, coalesce(f.truncated, 0)::bigint as truncated,
       coalesce(f.illegal, 0)::bigint as illegal, coalesce(b.b.cost, 0)::bigint as cost, coalesce(b.b.audit, '') as audit,
       sha256(coalesce(b.b.said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join facts f on f.conv_id is not distinct from c.conv_id
left join best b on b.conv_id is not distinct from c.conv_id
"""
