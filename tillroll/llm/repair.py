"""Conversation structure repair: least edits by a Viterbi run that is parallel over chunks.

A conversation is in order if its roles read user, assistant, user, assistant, ..., after a
system turn or none. The cheapest edits come from backward costs over four states (start,
after system, after user, after assistant). Rows are range-partitioned in order, so that a
conversation of any length is cut into chunks. Each chunk starts from a speculative cost
vector at its end. Then chunks whose successor ends up with another vector run again, only
until the new vectors differ from the old ones by a constant (rank convergence): from there
on all decisions are the same. Once no chunk has to run again, the stitched costs drive a
forward trace that takes the least letter among the cheapest edits; chunks are traced from
every entry state, and the states are chained afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage

CHUNK_ROWS = 8192
PIECE = 1 << 20  # bytes of a repaired text that travel in one row
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # CUT_OFF: a truncated row that stays

Costs = tuple[int, int, int, int]
# States: 0 start, 1 after system, 2 after user, 3 after assistant.
TURN = (2, 2, 3, 2)  # where the next user or assistant row leads
ENDS = (True, False, False, True)
END: Costs = (0, 2 * INSERT, INSERT, 0)
# Codes of rows: 4 * status + role (0 other, 1 system, 2 user, 3 assistant).
FINE, TRUNCATED, DOOMED = 0, 1, 2
ABSENT = 12  # stands for a conversation without rows


def _kept(state: int, role: int) -> int | None:
    """The state after a row keeps its role, if it fits."""
    if role == 1:
        return 1 if state == 0 else None
    return role if role and TURN[state] == role else None


@lru_cache(maxsize=None)  # few vectors occur, as costs of states lie within a few inserts
def _moves(code: int, after: Costs) -> tuple[list[list[tuple[str, int, int | None]]], list[int]]:
    """Per state the edits of a row in letter order: (letter, cost to the end, state after;
    None for an insert); and the least costs."""
    status, role = divmod(code, 4)
    stay = CUT_OFF if status == TRUNCATED else 0
    edits = []
    for q in range(4):
        options = [("D", DELETE + after[q], q)]
        if status != DOOMED:
            if (k := _kept(q, role)) is not None:
                options.append(("K", KEEP + stay + after[k], k))
            options.append(("R", REROLE + stay + after[TURN[q]], TURN[q]))
        edits.append(options)
    best = [min(cost for _, cost, _ in options) for options in edits]
    for _ in range(2):  # at most two inserts in a row pay
        best = [min(b, INSERT + best[TURN[q]]) for q, b in enumerate(best)]
    for q, options in enumerate(edits):
        options.insert(1, ("I", INSERT + best[TURN[q]], None))
    return edits, best


@lru_cache(maxsize=None)
def step_back(code: int, after: Costs) -> tuple[Costs, int]:
    """Costs before a row, less their least, and that least."""
    if code == ABSENT:
        return after, 0
    best = _moves(code, after)[1]
    least = min(best)
    return tuple(b - least for b in best), least  # type: ignore[return-value]


Step = tuple[str, int]  # the letter of an edit and the state after it


@lru_cache(maxsize=None)
def decide(code: int, after: Costs, state: int) -> tuple[Step, ...]:
    """The cheapest edits at a row: inserts before it, then its own; of equal cost the least letter."""
    if code == ABSENT:
        return ()
    edits, best = _moves(code, after)
    letter, _, then = next(e for e in edits[state] if e[1] == best[state])
    if then is None:
        return (letter, TURN[state]), *decide(code, after, TURN[state])
    return ((letter, then),)


def closing(state: int) -> tuple[Step, ...]:
    """What is inserted after the last row."""
    return () if ENDS[state] else (("I", TURN[state]), *closing(TURN[state]))


def sweep(codes: bytes, end: Costs) -> tuple[Costs, int]:
    """Costs at the start of a chunk, less their least, and the sum of what was taken off."""
    total = 0
    for c in reversed(codes):
        end, least = step_back(c, end)
        total += least
    return end, total


def fix_up(codes: bytes, was: Costs, end: Costs, start: Costs, total: int) -> tuple[Costs, int]:
    """``sweep`` of a chunk that ran from ``was`` to (start, total) before; stops where the
    old and the new vector differ by a constant."""
    old = new = 0
    for c in reversed(codes):
        was, k = step_back(c, was)
        old += k
        end, k = step_back(c, end)
        new += k
        if was == end:
            return start, total - old + new
    return end, new


def trace(codes: bytes, end: Costs, state: int, last: bool) -> tuple[list[tuple[Step, ...]], int]:
    """The edits at each row of a chunk, and the state after it; ``last``: the conversation
    ends here, and what it lacks follows its last row."""
    after = [end]
    for c in reversed(codes[1:]):
        after.append(step_back(c, after[-1])[0])
    rows = []
    for c in codes:
        rows.append(decide(c, after.pop(), state))
        if rows[-1]:
            state = rows[-1][-1][1]
    if last:
        rows[-1] += closing(state)
    return rows, state


# ---- rows and chunks ------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row
    (its text becomes null and ``absent`` true), 1 empties its text, 2 takes its ``.!?``, 3
    repeats it, 4 makes its role user. Nulls in role and text become one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(fault == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        (fault == 0).alias("absent"),
        F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", "absent", F.explode("copies").alias("copy")).drop("copy")


def _ordered(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows in order, staged; ``at`` numbers them, its high bits are the chunk. Order: conversation,
    turn (nulls first), role, text (its first 64 characters, then a digest)."""
    digest = F.unhex(F.md5(F.concat_ws("\0", "role", "text")))
    rows = rows.select(
        "conv_id", "turn", "role", "text", "absent", digest.alias("digest"), F.monotonically_increasing_id().alias("_row")
    )
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 64), "digest", "_row"]
    n = max(1, -(-rows.count() // chunk_rows))
    parts = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    return stage(parts.drop("_row").withColumn("part", F.shiftright("at", 33)), "turns")


def _codes(rows: DataFrame) -> DataFrame:
    solid = F.rtrim("text", F.lit(SPACES))
    last = F.substring(solid, -1, 1)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return rows.select(
        "part",
        "at",
        "conv_id",
        "turn",
        "absent",
        initial.alias("initial"),
        role.cast("byte").alias("role"),
        (solid == "").alias("blank"),
        (~last.isin(*".!?")).alias("truncated"),
    )


_SLICE = (
    "part long, lo long, conv_id long, codes binary, blank long, duplicate long, truncated long, illegal long,"
    " first_initial string, last_initial string, first_turn long, last_turn long, turns long,"
    " start array<long>, total long"
)
LEGAL = ("su", "ua", "au")


def _cut(key: tuple, rows: pa.Table, firsts: pa.Table) -> pa.Table:
    """One row per conversation of a chunk: codes, faults, and costs from a speculative end."""
    rows = rows.sort_by("at")
    flag = lambda c: rows.column(c).to_numpy(zero_copy_only=False).astype(bool)
    at = rows.column("at").to_numpy()
    conv = rows.column("conv_id").combine_chunks()
    null, conv_id = conv.is_null().to_numpy(zero_copy_only=False), conv.fill_null(0).to_numpy()
    here = ~flag("absent")
    blank = flag("blank") & here
    again = ~np.isin(at, firsts.column("at").to_numpy()) & here & ~blank
    cut = flag("truncated") & here & ~blank & ~again
    code = rows.column("role").to_numpy() + 4 * np.where(blank | again, DOOMED, np.where(cut, TRUNCATED, FINE))
    code = np.where(here, code, ABSENT).astype(np.uint8)
    initials, turns = rows.column("initial").to_pylist(), rows.column("turn").to_pylist()
    new = np.flatnonzero((np.diff(conv_id, prepend=conv_id[:1]) != 0) | (np.diff(null, prepend=null[:1])))
    bounds = [0, *new.tolist(), len(at)]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        own = [i for i in range(lo, hi) if here[i]]
        who = [initials[i] for i in own]
        when = [turns[i] for i in own if turns[i] is not None]
        codes = code[lo:hi].tobytes()
        start, total = sweep(codes, END)
        out.append(
            {
                "part": key[0].as_py(),
                "lo": int(at[lo]),
                "conv_id": None if null[lo] else int(conv_id[lo]),
                "codes": codes,
                "blank": int(blank[lo:hi].sum()),
                "duplicate": int(again[lo:hi].sum()),
                "truncated": int(cut[lo:hi].sum()),
                "illegal": sum(a + b not in LEGAL for a, b in zip(who, who[1:])),
                "first_initial": who[0] if who else None,
                "last_initial": who[-1] if who else None,
                "first_turn": when[0] if when else None,
                "last_turn": when[-1] if when else None,
                "turns": len(set(when)),
                "start": list(start),
                "total": total,
            }
        )
    return pa.Table.from_pylist(out, schema=_ARROW)


_ARROW = pa.schema(
    [
        *((c, pa.int64()) for c in ("part", "lo", "conv_id")),
        ("codes", pa.binary()),
        *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")),
        *((c, pa.string()) for c in ("first_initial", "last_initial")),
        *((c, pa.int64()) for c in ("first_turn", "last_turn", "turns")),
        ("start", pa.list_(pa.int64())),
        ("total", pa.int64()),
    ]
)


def _slices(rows: DataFrame) -> DataFrame:
    # a combinable least, so that a text repeated without end is no burden to one task
    present = rows.where(~F.col("absent"))
    firsts = present.groupBy("conv_id", "digest").agg(F.min("at").alias("at"))
    firsts = firsts.select(F.shiftright("at", 33).alias("part"), "at")
    found = _codes(rows).groupBy("part").cogroup(firsts.groupBy("part")).applyInArrow(_cut, _SLICE)
    return stage(found, "slices")


# ---- costs over chunk borders -----------------------------------------------------------


@dataclass
class Chunk:
    """What the driver knows of a slice whose conversation spans several chunks."""

    lo: int
    runs: dict[Costs, tuple[Costs, int]]  # costs at the end: (costs at the start, taken off)
    end: Costs = END
    last: bool = False  # of its conversation
    entry: int = 0
    cost: int = 0  # of the conversation; on its first slice


def _on_chunks(open_: DataFrame, work) -> list:
    """``work(lo, codes)`` of every slice it has a value for; a few numbers per slice come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            out = [(lo, w) for lo, codes in pairs if (w := work(lo, codes)) is not None]
            columns = [pa.array([lo for lo, _ in out], pa.int64()), pa.array([w for _, w in out], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["lo", "found"])

    return open_.select("lo", "codes").mapInArrow(run, "lo long, found array<long>").collect()


def _unsettled(conversation: list[Chunk]) -> dict[int, list[Costs]]:
    """Hands costs from the last slice to the first; where a slice has not run from them, the
    runs to make: this slice and all before, from all vectors that occurred.

    Few different vectors occur, so the number of passes does not grow with the slices, even
    if no run converges.
    """
    end = END
    for i in reversed(range(len(conversation))):
        conversation[i].end = end
        if end not in conversation[i].runs:
            seen = {start for c in conversation for start, _ in c.runs.values()}
            wanted = {c.lo: sorted(seen - c.runs.keys()) for c in conversation[: i + 1]}
            return {lo: vectors for lo, vectors in wanted.items() if vectors}
        end = conversation[i].runs[end][0]
    return {}


def _stitch(slices: DataFrame) -> tuple[dict[int, Chunk], int]:
    """Every slice of the conversations that span chunks, with its true costs at the end and
    its state at the start; and the number of fix-up passes.

    A chunk has at most two such slices, so the driver holds two small records a chunk.
    """
    spans = slices.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("conv_id", "_id")
    open_ = stage(slices.join(spans, F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi"), "open-slices")
    rows = open_.select("conv_id", "lo", "start", "total").orderBy("lo").collect()
    conversations = [
        [Chunk(r.lo, {END: (tuple(r.start), r.total)}) for r in same] for _, same in groupby(rows, lambda r: r.conv_id)
    ]
    chunks = {c.lo: c for conversation in conversations for c in conversation}
    passes = 0
    while wanted := {k: v for conversation in conversations for k, v in _unsettled(conversation).items()}:
        passes += 1
        known = {lo: chunks[lo].runs[END] for lo in wanted}

        def mend(lo: int, codes: bytes, wanted=wanted, known=known) -> list[int] | None:
            runs = (fix_up(codes, END, end, *known[lo]) for end in wanted.get(lo, ()))
            return [x for start, total in runs for x in (*start, total)] or None

        for lo, found in _on_chunks(open_, mend):
            for i, end in enumerate(wanted[lo]):
                *start, total = found[5 * i : 5 * i + 5]
                chunks[lo].runs[end] = tuple(start), total
    ends = {c.lo: c.end for c in chunks.values()}
    exits = lambda lo, codes: [trace(codes, ends[lo], q, False)[1] for q in range(4)]
    leads = dict(_on_chunks(open_, exits)) if chunks else {}
    for conversation in conversations:
        state, conversation[-1].last = 0, True
        for c in conversation:
            c.entry, state = state, leads[c.lo][state]
            conversation[0].cost += c.runs[c.end][1]
        conversation[0].cost += conversation[0].runs[conversation[0].end][0][0]
    return chunks, passes


# ---- results ------------------------------------------------------------------------------


@dataclass
class Repaired:
    """What ``repair`` finds.

    ``edits``: (conv_id, at, edit, role, text, spans), one row per edit, role and text null where
    a row goes; spans tells that the conversation lies in several chunks. Tasks hold whole
    chunks, each in order. ``faults``: (conv_id, gaps, blank, duplicate, truncated, illegal,
    cost), one row per conversation. ``passes``: fix-up passes that were needed.
    """

    edits: DataFrame
    faults: DataFrame
    passes: int


_EDITS = "conv_id long, at long, edit string, role string, text string, spans boolean"


def _edits(rows: DataFrame, slices: DataFrame, chain: dict[int, Chunk]) -> DataFrame:
    plan = {lo: (c.entry, c.end, c.last) for lo, c in chain.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, spans = iter(()), False
        for b in batches:
            out = []
            for at, conv, role, text, codes in zip(*(c.to_pylist() for c in b.columns)):
                if codes is not None:  # a slice comes before its rows
                    spans = at in plan
                    entry, end, last = plan.get(at, (0, END, True))
                    steps = iter(trace(codes, end, entry, last)[0])
                    continue
                for letter, state in next(steps):
                    said = role if letter == "K" else "user" if state == 2 else "assistant"
                    kept = (None, None) if letter == "D" else (said, "" if letter == "I" else text)
                    out.append((conv, at, letter, *kept, spans))
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _EDIT_TYPES)], _EDIT_NAMES)

    chunks = slices.select("part", F.col("lo").alias("at"), "codes")
    return (
        rows.select("part", "at", "conv_id", "role", "text")
        .unionByName(chunks, allowMissingColumns=True)
        .repartition("part")
        .sortWithinPartitions("part", "at", F.col("codes").isNull())
        .select("at", "conv_id", "role", "text", "codes")
        .mapInArrow(run, _EDITS)
    )


_EDIT_NAMES = ["conv_id", "at", "edit", "role", "text", "spans"]
_EDIT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]


def _faults(slices: DataFrame, chain: dict[int, Chunk]) -> DataFrame:
    """Faults of conversations: those of their slices, and those between slices."""
    spark = slices.sparkSession
    heads = [(c.lo, c.cost, True) for c in chain.values()]
    costs = F.broadcast(spark.createDataFrame(heads, "lo long, known long, spans boolean"))
    before = W.partitionBy("conv_id").orderBy("lo").rowsBetween(W.unboundedPreceding, -1)
    seen = lambda c: F.last(c, ignorenulls=True).over(before)
    pair = F.concat(seen("last_initial"), "first_initial")
    whole = F.col("total") + F.col("start")[0]
    each = slices.join(costs, "lo", "left").select(
        *slices.columns,
        (F.col("illegal") + F.coalesce((~pair.isin(*LEGAL)).cast("long"), F.lit(0))).alias("bad"),
        (F.col("turns") - F.coalesce((seen("last_turn") == F.col("first_turn")).cast("long"), F.lit(0))).alias("distinct"),
        F.coalesce("known", whole).alias("cost"),
    )
    span = F.max("last_turn") - F.min("first_turn") + 1 - F.sum("distinct")
    return each.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum("bad").alias("illegal"),
        F.sum("cost").alias("cost"),
    )


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Repaired:
    """Faults of conversations and the cheapest edits that bring them in order.

    ``rows``: conv_id, turn (longs), role, text (strings, not null), absent (true: no row, but its
    conversation is one). Rows are taken by turn, nulls first, equal turns by role and text;
    null conv_id is a conversation of its own. A row is blank, else duplicate (role and text
    seen before in the conversation), else truncated (no ``.!?`` at its end). Blank and
    duplicate rows have to go. Texts are read whole. An empty table gives no rows.
    """
    ordered = _ordered(rows, chunk_rows)
    slices = _slices(ordered)
    chain, passes = _stitch(slices)
    return Repaired(_edits(ordered, slices, chain), _faults(slices, chain), passes)


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of conversations with an edit, from ``Repaired.edits``.

    SHA-256 has no parallel form: of a conversation that spans chunks the repaired text
    streams through one task, a piece at a time.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, said, first, whole = None, [], [], 0, True
        size = 0

        def flush() -> tuple:
            text = b"".join(said)
            sha = hashlib.sha256(text[1:]).hexdigest() if whole else None
            return key, first, "".join(audit), None if whole else text, sha

        for b in batches:
            out = []
            for conv, at, edit, role, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                if audit and (conv != key or spans == whole or (spans and size > PIECE)):
                    out.append(flush())
                    audit, said, size = [], [], 0
                if not audit:
                    key, first, whole = conv, at, not spans
                audit.append(edit)
                if role is not None:
                    said.append(f"\n{role}:{text}".encode("utf-8", "surrogatepass"))
                    size += len(said[-1])
            yield _batch(out)
        if audit:
            yield _batch([flush()])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, sha, begun = None, [], hashlib.sha256(), False
        for b in batches:
            out = []
            for conv, at, some, text, _ in zip(*(c.to_pylist() for c in b.columns)):
                if audit and conv != key:
                    out.append((key, 0, "".join(audit), None, sha.hexdigest()))
                    audit, sha, begun = [], hashlib.sha256(), False
                key = conv
                audit.append(some)
                sha.update(text if begun else text[1:])
                begun = begun or bool(text)
            yield _batch(out)
        if audit:
            yield _batch([(key, 0, "".join(audit), None, sha.hexdigest())])

    schema = "conv_id long, at long, audit string, piece binary, repaired_sha256 string"
    found = stage(edits.select(*_EDIT_NAMES).mapInArrow(local, schema), "digests")
    pieces = found.where("repaired_sha256 is null").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    spanning = pieces.mapInArrow(joined, schema)
    return found.where("repaired_sha256 is not null").unionByName(spanning).select("conv_id", "audit", "repaired_sha256")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 5
    types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "at", "audit", "piece", "repaired_sha256"]
    )


def audit(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Damage, repair and digest: one row per conv_id of ``conversations`` (also of those that
    lose all their rows: zeros, no edits, the hash of nothing). Extra columns are ignored."""
    found = repair(damage(conversations), chunk_rows)
    said = digests(found.edits).withColumnRenamed("conv_id", "_id")
    return found.faults.join(said, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        *found.faults.columns,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
