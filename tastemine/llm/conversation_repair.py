"""Repair of conversation structure by Hirschberg's divide and conquer.

A conversation is repaired by the cheapest edits (keep, rerole, delete, insert) that make its roles an optional system
turn and then user and assistant in turn. Roles so far have four states: nothing, system, user, assistant. The cost of
a stretch of rows is therefore four numbers from each end: forward, the least cost to come to each state from where the
stretch starts; backward, the least cost to get from each state to where it ends. Both vectors meet mid-stretch at the
state with the least sum, and the halves are solved alike, so only vectors are kept, never a table of all rows. Of
equally cheap crossings the one whose edits so far are ASCII-least is taken: beside its costs a forward vector holds the
order of the four states' least edit strings. That is enough, since such a string determines its state, and as each ends
with the edit of the same row, none is the beginning of another.

Spark sorts all rows by conversation and turn and cuts them into blocks of ``BLOCK`` consecutive rows, whatever the
conversations: a conversation that holds a third of all rows is spread over a third of the blocks. A stretch that may go
on in the next block is first reduced to its vectors from each state; the crossings at block borders are chosen over
these (in blocks again, where there are many), and each block then reconstructs its rows between known states. All
stretches of a block advance together, row by row, in numpy.

Nulls in role or text are one space, in the turn of the damage key and the null conversation likewise. Rows with the
same turn come in the order of role and text (its first 64 characters, then its digest). A role that begins with neither s, u nor a (also an empty one) cannot be
kept. Rows equal in everything are repetitions of the first. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common
from tastemine.operators.indexing import dense_index
from tastemine.session import checkpoint

BLOCK = 2048
SPACE = " \t\n\x0b\x0c\r"

# Fixed values of the edit costs
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing yet, after system, after user, after assistant. A conversation may end in the first and the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40  # no way
#: what a state's next turn may be -> the state then
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua-"
FAULTS = ("fine", "truncated", "must go")


def _inserted(state: int, n: int) -> list[int]:
    """The states after each of ``n`` inserts: only one role fits at any time."""
    out = []
    for _ in range(n):
        state = USER if USER in NEXT[state].values() else ASSISTANT
        out.append(state)
    return out


def _row_edits(initial: str, fault: str) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...], int | None]]:
    """(state before, after) -> cheapest, then ASCII-least edits of one row: cost, string, inserted turns, new role."""
    best: dict = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for before, n in product(range(4), range(3)):
        inserted = _inserted(before, n)
        at = [before, *inserted][-1]
        ways = [("D", DELETE, at, None)]
        if fault != "must go":
            if initial in NEXT[at]:
                ways.append(("K", KEEP + extra, NEXT[at][initial], None))
            to = _inserted(at, 1)[0]
            ways.append(("R", REROLE + extra, to, to))
        for edit, cost, after, role in ways:
            way = (n * INSERT + cost, "I" * n + edit, tuple(inserted), role)
            if (before, after) not in best or way[:2] < best[before, after][:2]:
                best[before, after] = way
    return best


#: kinds of row: role initial and fault
KINDS = list(product(INITIALS, FAULTS))
EDITS = [_row_edits(*kind) for kind in KINDS]
#: cost[kind, before, after]; rank[kind, before, after]: place of the edit string among those from the same state
COST = np.array([[[e[p, s][0] if (p, s) in e else FAR for s in range(4)] for p in range(4)] for e in EDITS], dtype=np.int64)
RANK = np.array(
    [[[sorted((e[p, t][1], t) for t in range(4) if (p, t) in e).index((e[p, s][1], s)) if (p, s) in e else 4 for s in range(4)] for p in range(4)] for e in EDITS],
    dtype=np.int64,
)
#: inserts behind the last row by state, and their cost
END = np.array([0, 2, 1, 0])
END_COST = INSERT * END


# --- stretches of items; an item is a row or a stretch already reduced to its vectors


def _forward(f: np.ndarray, order: np.ndarray, cost: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One item on: costs and order of the four states for many stretches at once (arrays of one row a stretch)."""
    total = f[:, :, None] + cost  # [stretch, before, after]
    least = total.min(axis=1)
    # of equally cheap ways to a state the one that comes first: by the state before, then within it
    place = np.where(total == least[:, None, :], order[:, :, None] * 8 + rank, 1 << 20).min(axis=1)
    place = np.where(least >= FAR, (1 << 20) + np.arange(4), place)
    return np.minimum(least, FAR), place.argsort(axis=1, kind="stable").argsort(axis=1)


def _start(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    f = np.full((len(states), 4), FAR, dtype=np.int64)
    f[np.arange(len(states)), states] = 0
    return f, np.tile(np.arange(4), (len(states), 1))


def reduce(lo: np.ndarray, hi: np.ndarray, cost: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of whole stretches [lo, hi) from each of the four states: cost and rank like an item's."""
    n = len(lo)
    at = np.repeat(lo, 4)
    f, order = _start(np.tile(np.arange(4), n))
    for step in range(int((hi - lo).max(initial=0))):
        go = np.flatnonzero(np.repeat(lo + step < hi, 4))
        item = at[go] + step
        f[go], order[go] = _forward(f[go], order[go], cost[item], rank[item])
    return f.reshape(n, 4, 4), order.reshape(n, 4, 4)


def solve(lo: np.ndarray, hi: np.ndarray, start: np.ndarray, end: np.ndarray, cost: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The state after each item of stretches [lo, hi) from ``start`` to the least of ``end`` (a cost for each state).

    Hirschberg's recursion, all stretches of a level at once."""
    after = np.full(len(cost), -1, dtype=np.int64)
    lo, hi, start, end = lo[hi > lo], hi[hi > lo], start[hi > lo], end[hi > lo]
    while len(lo):
        mid = (lo + hi + 1) // 2
        f, order = _start(start)
        for step in range(int((mid - lo).max())):
            go = np.flatnonzero(lo + step < mid)
            item = lo[go] + step
            f[go], order[go] = _forward(f[go], order[go], cost[item], rank[item])
        b = end.copy()
        for step in range(1, int((hi - mid).max()) + 1):
            go = np.flatnonzero(hi - step >= mid)
            b[go] = np.minimum((cost[hi[go] - step] + b[go][:, None, :]).min(axis=2), FAR)
        total = f + b
        best = total == total.min(axis=1)[:, None]
        cross = np.where(best, order, 8).argmin(axis=1)  # the audit-least of the cheapest crossings
        after[mid - 1] = cross
        there = np.full((len(lo), 4), FAR, dtype=np.int64)
        there[np.arange(len(lo)), cross] = 0
        left, right = mid - lo > 1, hi > mid
        lo, hi, start, end = (np.concatenate(x) for x in ((lo[left], mid[right]), (mid[left] - 1, hi[right]), (start[left], cross[right]), (there[left], end[right])))
        # a left half ends before the item whose state is known: its end costs are that item's way to the crossing
        n = int(left.sum())
        if n:
            item = hi[:n]
            end[:n] = np.minimum((cost[item] + end[:n][:, None, :]).min(axis=2), FAR)
    return after


# --- Spark: rows, blocks, borders


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy): the rows after the damage that their checksum asks for."""
    rows = conversations.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("r"), F.col(f"`{text}`").alias("t"))
    hit = F.crc32(F.concat_ws(":", _key("conv"), _key("turn")).cast("binary")) % 20
    rows = rows.select("conv", "turn", _key("r").alias("r"), _key("t").alias("t"), hit.alias("hit")).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("r")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with their place in the order of all conversations (``at``), ``fault`` and role ``initial``."""
    # rows equal in all of the order are alike, so which comes first does not matter; the last key only deals them out
    rows = rows.withColumn("deal", F.monotonically_increasing_id())
    rows = rows.withColumns({"begin": F.substring("text", 1, 64), "digest": F.sha2("text", 256)})  # the sort samples its keys: short ones
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("begin"), F.col("digest"), F.col("copy"), F.col("deal")]
    rows = checkpoint(dense_index(rows, order, "at").drop("begin", "digest", "deal"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = rows.groupBy("conv", said.alias("said")).agg(F.min("at").alias("first")).select("first")
    rows = rows.join(first, F.col("at") == F.col("first"), "left")
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    return rows.withColumn("fault", fault).withColumn("initial", F.substring("role", 1, 1)).drop("first", "copy")


def _stretches(conv: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of equal numbers."""
    cut = np.flatnonzero(np.diff(conv)) + 1
    return np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut, [len(conv)]]).astype(np.int64)


_ITEM = [*(f"c{p}{s}" for p in range(4) for s in range(4)), *(f"r{p}{s}" for p in range(4) for s in range(4))]


def _tables(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """cost and rank of a block's items."""
    if "kind" in batch.column_names:
        kind = batch["kind"].to_numpy()
        return COST[kind], RANK[kind]
    return tuple(np.column_stack([batch[c].to_numpy() for c in names]).reshape(-1, 4, 4) for names in (_ITEM[:16], _ITEM[16:]))


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("at").combine_chunks()


def _borders(table: pa.Table) -> pa.Table:
    """A block's first and last stretch as items: conversation, place, vectors."""
    table = _sorted(table)
    cost, rank = _tables(table)
    lo, hi = _stretches(table["conv"].to_numpy())
    ends = sorted({0, len(lo) - 1})
    c, r = reduce(lo[ends], hi[ends], cost, rank)
    at = table["at"].to_numpy()[lo[ends]]
    columns = {"conv": table["conv"].to_numpy()[lo[ends]], "at": at, "home": np.full(len(ends), table["_block"][0].as_py())} | dict(zip(_ITEM, [*c.reshape(-1, 16).T, *r.reshape(-1, 16).T], strict=True))
    return pa.table({k: pa.array(v.astype(np.int64)) for k, v in columns.items()})


def _inside(table: pa.Table, known: pa.Table) -> pa.Table:
    """A block's states before and after each item, and whether it is the last of its conversation. ``known``: for the
    block's first and last stretch their place, the states before and after, and whether they end the conversation."""
    table = _sorted(table)
    cost, rank = _tables(table)
    at = table["at"].to_numpy()
    lo, hi = _stretches(table["conv"].to_numpy())
    start, last = np.full(len(lo), NOTHING), np.ones(len(lo), dtype=bool)
    end = np.tile(END_COST, (len(lo), 1))
    for place, before, after, final in zip(*(known[c].to_pylist() for c in ("at", "before", "after", "last")), strict=True):
        k = int(np.searchsorted(at[lo], place))
        start[k], last[k] = before, final
        end[k] = FAR
        end[k, after] = 0
    after = solve(lo, hi, start, end, cost, rank)
    before = np.roll(after, 1)
    before[lo] = start
    final = np.zeros(len(at), dtype=bool)
    final[hi - 1] = last
    return pa.table({"at": at, "before": before, "after": after, "last": final})


def states(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(at, before, after, last): each item's states in the best repair of its conversation. ``items``: ``conv`` (a
    number that is the same within a conversation and changes between), ``at`` (a place, increasing), ``kind`` or
    vectors, and ``nth`` (the item's number in the order of places)."""
    blocks = items.withColumn("_block", F.floor(F.col("nth") / block)).drop("nth")
    result = "at bigint, before bigint, after bigint, last boolean"
    if items.count() <= block:  # one block: no stretch goes on elsewhere
        known = items.sparkSession.createDataFrame([], f"home bigint, {result}")
    else:  # at most two items a block are left, so the depth is the logarithm of the rows to the base block / 2
        borders = blocks.groupBy("_block").applyInArrow(_borders, "conv bigint, at bigint, home bigint, " + ", ".join(f"{c} bigint" for c in _ITEM))
        borders = dense_index(borders, ["at"], "nth")
        known = borders.select("home", "at").join(states(borders.drop("home"), block), "at")
    return checkpoint(blocks.groupBy("_block").cogroup(known.groupBy("home")).applyInArrow(_inside, result))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` of ``with_faults`` with their edits: ``inserted`` (roles put before), ``edit`` (K, R or D), ``new_role``
    (of a reroled row), ``appended`` (roles put behind the last row of a conversation), ``cost`` of all of these."""
    number = F.coalesce(*[F.when(F.col("initial") == c, k) for k, c in enumerate(INITIALS[:3])], F.lit(3))
    bad = F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    # conversations are told apart by a hash; neighbours in the order with equal hashes would be one, so the null is marked
    conv = F.xxhash64(F.col("conv").isNull(), "conv")
    items = rows.select(conv.alias("conv"), "at", (number * len(FAULTS) + bad).cast("bigint").alias("kind"), F.col("at").alias("nth"))
    found = states(items, block)
    joined = rows.join(found, "at").withColumn("_kind", (number * len(FAULTS) + bad).cast("int"))

    def table(value, kind: str) -> Column:
        flat = [value(EDITS[k].get((p, s))) for k in range(len(KINDS)) for p in range(4) for s in range(4)]
        return F.element_at(F.array(*[F.lit(v).cast(kind) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).cast(kind) for v in flat]), _place)

    _place = (F.col("_kind") * 16 + F.col("before") * 4 + F.col("after") + 1).cast("int")
    name = lambda states_: [NAMES[s] for s in states_]
    n_end = F.when(F.col("last"), F.element_at(F.array(*[F.lit(int(n)) for n in END]), F.col("after").cast("int") + 1)).otherwise(0)
    appended = F.slice(F.when(F.col("after") == SYSTEM, F.array(F.lit("user"), F.lit("assistant"))).otherwise(F.array(F.lit("assistant"))), 1, n_end)
    own = [c for c in rows.columns]
    return joined.select(
        *own,
        table(lambda e: name(e[2]) if e else [], "array<string>").alias("inserted"),
        table(lambda e: e[1][-1] if e else None, "string").alias("edit"),
        table(lambda e: NAMES[e[3]] if e and e[3] is not None else None, "string").alias("new_role"),
        appended.alias("appended"),
        (table(lambda e: e[0] if e else None, "bigint") + n_end * INSERT).cast("bigint").alias("cost"),
    )


def lines(repaired: DataFrame) -> DataFrame:
    """``repaired`` rows with their part of the ``audit`` and the ``lines`` they leave in the repaired conversation."""
    empty = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    own = F.when(F.col("edit") == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.coalesce("new_role", "role"), F.lit(":"), "text")))
    audit = F.concat(F.repeat(F.lit("I"), F.size("inserted")), "edit", F.repeat(F.lit("I"), F.size("appended")))
    return repaired.withColumn("audit", audit).withColumn("lines", F.concat(empty(F.col("inserted")), own, empty(F.col("appended"))))


def digests(rows: DataFrame, conv_type: T.DataType) -> DataFrame:
    """(conv, audit, repaired_sha256): strings in the order of the rows, streamed: a conversation's rows meet in one
    task, as one digest of them must, but one batch at a time."""
    import hashlib

    schema = T.StructType([T.StructField("conv", conv_type), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digest, begun = None, [], None, False

        def told(out):
            if digest is not None:
                out.append((now[0], "".join(audit), digest.hexdigest()))

        for batch in batches:
            out: list[tuple] = []
            for conv, part, put in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if now is None or now[0] != conv:
                    told(out)
                    now, audit, digest, begun = (conv,), [], hashlib.sha256(), False
                audit.append(part)
                for line in put:
                    if begun:
                        digest.update(b"\n")
                    digest.update(line.encode())
                    begun = True
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=arrow)
        out = []
        told(out)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rows.select("conv", "at", "audit", "lines").repartition("conv").sortWithinPartitions("at").mapInArrow(run, schema)


def summary(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: counts of faults, ``cost``, ``audit`` and ``repaired_sha256``."""
    rows = checkpoint(with_faults(damaged(conversations, conv, turn, role, text)))
    repaired = checkpoint(lines(repair(rows)))
    # pairs of neighbours: one partner by place at most
    here = rows.select("conv", "at", "initial")
    there = rows.select(F.col("conv").alias("_conv"), (F.col("at") + 1).alias("_at"), F.col("initial").alias("_before"))
    pairs = here.join(there, (F.col("at") == F.col("_at")) & F.col("conv").eqNullSafe(F.col("_conv")))
    wrong = pairs.where(~F.concat("_before", "initial").isin("su", "ua", "au")).groupBy("conv").agg(F.count(F.lit(1)).alias("illegal"))
    turns = rows.groupBy("conv", "turn").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("conv").agg(
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
    )
    costs = repaired.groupBy("conv").agg(F.sum("cost").alias("cost"))
    told = digests(repaired, conversations.schema[conv].dataType)
    out = conversations.select(F.col(f"`{conv}`").alias("_conv")).distinct()
    for part in (counts, wrong, costs, told):
        out = out.join(part, F.col("_conv").eqNullSafe(F.col("conv")), "left").drop("conv")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_conv").alias(conv), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def query(spark, sf_dir):
    """op12: faults, cheapest repair and its digest for every conversation."""
    return summary(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), hit AS (  -- CRC-32, a bit at a time: -1 stands for a shift
  SELECT * EXCLUDE (k), xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''),
           lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 20 AS hit
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE hit <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), r AS (
  SELECT conv_id, turn, pos, role, text, left(role, 1) AS i, CASE WHEN bare = '' THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS wrong
  FROM placed
), follows(p, i, q) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
inserted(p, q, t, put) AS (  -- no, one or two empty turns
  VALUES ('', '', '', []::VARCHAR[]), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []),
         ('', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']), ('a', 'u', 'I', ['user:']),
         ('', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:']), ('u', 'u', 'II', ['assistant:', 'user:']), ('a', 'a', 'II', ['user:', 'assistant:'])
), edits AS (
  SELECT conv_id, pos, q.q AS p, q.q AS q, 4 AS cost, 'D' AS t, []::VARCHAR[] AS put FROM r, (SELECT DISTINCT q FROM inserted) q
  UNION ALL SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text] FROM r JOIN follows USING (i) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R', [CASE WHEN follows.i = 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
  FROM r JOIN follows ON follows.i <> 's' WHERE fault NOT IN ('blank', 'duplicate')
), way(conv_id, pos, s, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '', {'cost': 0::BIGINT, 'audit': '', 'put': []::VARCHAR[]} FROM r
  UNION ALL
  SELECT w.conv_id, w.pos + 1, e.q, min({'cost': w.best.cost + 3 * length(n.t) + e.cost, 'audit': w.best.audit || n.t || e.t, 'put': list_concat(w.best.put, n.put, e.put)})
  FROM way w JOIN inserted n ON n.p = w.s JOIN edits e ON e.conv_id = w.conv_id AND e.pos = w.pos + 1 AND e.p = n.q
  GROUP BY w.conv_id, w.pos, e.q
), done AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 3 * length(n.t), 'audit': w.best.audit || n.t, 'put': list_concat(w.best.put, n.put)}) AS best
  FROM way w JOIN inserted n ON n.p = w.s JOIN (SELECT conv_id, max(pos) AS pos FROM r GROUP BY conv_id) l ON l.conv_id = w.conv_id AND l.pos = w.pos
  WHERE n.q IN ('', 'a') GROUP BY w.conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
  FROM r GROUP BY conv_id
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.put, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN done USING (conv_id)
"""
