"""Conversation structure repair by rank-convergence parallel Viterbi: the cheapest edits to a well-formed conversation.

A conversation's rows, by turn, are edited until the initials of their roles read `(s?(ua)+)?`: perhaps a system turn,
then user and assistant in turn, each user answered. Keep costs 0, Rerole (to user or assistant) 2, Delete 3, and Insert
(an empty user or assistant turn, anywhere) 2; blank and duplicate rows have to be deleted, and a truncated row that stays
costs 1. Of the cheapest edits those whose initials, in order, are least as text are taken. They also say all roles: what
an edit does depends only on the state (start, after system, after user, after assistant) that it is met in.

1. Rows are sorted over all tasks by conversation, turn, role and text and cut into chunks of at most CHUNK rows of
   one conversation, so a long conversation is spread over many tasks. A chunk is one record of the written table.
2. Blank, duplicate and truncated rows are told within a chunk; of conversations with several chunks, the first places
   of each (role, text) are compared between the chunks by an aggregate on hashes.
3. Backward: a chunk's cost vector has for each state the least cost of all that follows. Every chunk starts from the
   vector of a conversation's end. That is right for last chunks and a guess for the others. In fix-up passes a chunk
   whose guess differs (by more than a constant) from the vector that the chunk after it has found is run again, only
   until its vectors differ from the ones before by a constant. Rows that have to be deleted never change a vector (their
   deletion is always taken at once, as D is the least initial), so they take no part. Runs of one role need not
   converge, so after PASSES passes the chunks still open are run from each of the few vectors that can occur (`starts`),
   and one walk over the chunks of a conversation, in order, picks the right one.
4. Forward: from the stitched vectors every chunk is traced from each of the four states, a walk over the chunks of a
   conversation says in which state each begins, and its edits and rows are written out.

Vectors are kept up to a constant, as numbers of the few that can occur: one byte a row. A walk reads a few bytes a
chunk, and nothing of a conversation is gathered but its chunks' records, one after the other.

Defined results: null conversation ids are one conversation; a null role or text is one space; null turns come first; rows
of one turn are in the order of role and text; copies of a row are duplicates of the first. A role other than s..., u...
or a... has to be reroled or deleted. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, written

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1

#: Rows of a chunk, and characters after which a chunk ends.
CHUNK = 256
CHUNK_CHARS = 1 << 20

#: Fix-up passes before open chunks are run from every vector that can occur.
PASSES = 2

START, SYSTEM, USER, ASSISTANT = range(4)

#: The state after a turn of that initial, by state; None if the turn can't stand there.
_AFTER = {
    "s": (SYSTEM, None, None, None),
    "u": (USER, USER, None, USER),
    "a": (None, None, ASSISTANT, None),
    "x": (None, None, None, None),
}
#: The state after the one turn that can be inserted, or that a row can be reroled to.
_NEXT = (USER, USER, ASSISTANT, USER)

_ROLES = {USER: "user", ASSISTANT: "assistant"}
Vector = tuple[int, int, int, int]


def _inserted(costs: list[float]) -> list[float]:
    """The least costs if turns may be inserted first; more than two never help."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return costs


@lru_cache(maxsize=4096)
def step_back(vector: Vector, symbol: str) -> tuple[Vector, int]:
    """The costs before a row, from those after it, less their least, and that least. A capital symbol is a truncated row."""
    cut_off, after = CUT_OFF * symbol.isupper(), _AFTER[symbol.lower()]
    costs = []
    for state in range(4):
        kept = KEEP + cut_off + vector[after[state]] if after[state] is not None else float("inf")
        costs.append(min(kept, REROLE + cut_off + vector[_NEXT[state]], DELETE + vector[state]))
    costs = _inserted(costs)
    least = min(costs)
    return tuple(int(c - least) for c in costs), int(least)


#: The costs at the end of a conversation, where only the start and a turn of the assistant may be last.
END: Vector = tuple(int(c) for c in _inserted([0, float("inf"), float("inf"), 0]))


@lru_cache(maxsize=1)
def starts() -> tuple[Vector, ...]:
    """All vectors that can occur, up to a constant: what rows of every kind make of the last one."""
    found, new = [END], [END]
    while new:
        new = [v for v in dict.fromkeys(step_back(v, s)[0] for v in new for s in "suaxSUAX") if v not in found]
        found += new
    return tuple(found)


@lru_cache(maxsize=1)
def _number() -> dict[Vector, int]:
    return {v: k for k, v in enumerate(starts())}


def run_back(symbols: str, end: int, before: bytes | None = None) -> tuple[bytes, int]:
    """The numbers of the vectors before each row and at the end, and the rows that were run.

    With the vectors of an earlier run it stops where they agree: from there on both differ by a constant only.
    """
    out = bytearray(before or bytes(len(symbols) + 1))
    number, vectors = _number(), starts()
    out[-1], vector = end, vectors[end]
    for k in range(len(symbols) - 1, -1, -1):
        vector, _ = step_back(vector, symbols[k])
        found = number[vector]
        if before is not None and out[k] == found:
            return bytes(out), len(symbols) - k
        out[k] = found
    return bytes(out), len(symbols)


def trace(symbols: str, vectors: bytes, state: int) -> tuple[list[str], int, int]:
    """The edits of each row (inserted turns before it, then its own), the last state, and their cost.

    Of several cheapest edits the one with the least initial is taken, so all of them read least as text.
    """
    known, edits, cost = starts(), [], 0
    for symbol, here, after in zip(symbols, vectors, vectors[1:], strict=False):
        own, constant = step_back(known[after], symbol)
        later = known[after]
        cut_off, then, done = CUT_OFF * symbol.isupper(), _AFTER[symbol.lower()], ""
        while True:
            left = own[state] + constant
            if left == DELETE + later[state]:
                done, cost = done + "D", cost + DELETE
                break
            if left == INSERT + own[_NEXT[state]] + constant:
                done, cost, state = done + "I", cost + INSERT, _NEXT[state]
                continue
            if then[state] is not None and left == KEEP + cut_off + later[then[state]]:
                done, cost, state = done + "K", cost + KEEP + cut_off, then[state]
            else:
                done, cost, state = done + "R", cost + REROLE + cut_off, _NEXT[state]
            break
        edits.append(done)
    return edits, state, cost


def closing(state: int) -> str:
    """The turns inserted after the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows, of which each twentieth by crc32 of `conv_id:turn` is dropped, emptied,
    stripped of its full stops, repeated or given to the user. Nulls are one space."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate.alias("fate"))
        .where("fate <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


_SPACE = " \t\n\x0b\x0c\r"

_CHUNK_FIELDS = [
    ("conv", pa.string()),
    ("part", pa.int32()),
    ("chunk", pa.int32()),
    ("whole", pa.bool_()),
    ("turns", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())),
    ("faults", pa.string()),
    ("hashes", pa.list_(pa.binary())),
]
_CHUNK_SCHEMA = (
    "conv string, part int, chunk int, whole boolean, turns array<long>, roles array<string>, texts array<string>,"
    " faults string, hashes array<binary>"
)
_DONE_FIELDS = [*_CHUNK_FIELDS[:-1], ("edits", pa.list_(pa.string())), ("before", pa.string()), ("tail", pa.string()), ("cost", pa.int64())]
_DONE_SCHEMA = _CHUNK_SCHEMA.replace("hashes array<binary>", "edits array<string>, before string, tail string, cost long")


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _mapped(df: DataFrame, fields: list, schema: str, each: Callable) -> DataFrame:
    """`each` makes one record of each row's values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                values = zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True)
                yield _batch([each(*v) for v in values], fields)

    return map_arrow(df, run, schema)


def _walked(df: DataFrame, fields: list, schema: str, state: Callable, each: Callable) -> DataFrame:
    """One pass over the rows of each conversation (first column), as sorted; `each` gets and returns the running state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now = None, None
        for batch in batches:
            out = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if values[0] != conv:
                    conv, now = values[0], state()
                now, record = each(now, *values)
                out.append(record)
            yield _batch(out, fields)

    return map_arrow(df, run, schema)


def _chunks(rows: DataFrame) -> DataFrame:
    """The sorted rows as chunks. `faults` has a letter for each row: b, d, t or a blank; `hashes` are those of the rows
    that are the first of their role and text in the chunk. A chunk is `whole` if it surely is all of its conversation."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, first, alone = TaskContext.get().partitionId(), 0, True, True
        conv, turns, roles, texts, chars = None, [], [], [], 0

        def record(whole: bool) -> pa.RecordBatch:
            seen, faults, hashes = set(), [], []
            for role, text in zip(roles, texts, strict=True):
                own = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                shown = text.rstrip(_SPACE)
                faults.append("b" if not shown else "d" if own in seen else " " if shown[-1] in ".!?" else "t")
                hashes.append(None if own in seen else own)
                seen.add(own)
            return _batch([(conv, part, number, whole, turns, roles, texts, "".join(faults), hashes)], _CHUNK_FIELDS)

        for batch in batches:
            for c, turn, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if turns and c != conv:
                    yield record(alone and not first)
                    number, first, alone, turns, roles, texts, chars = number + 1, False, True, [], [], [], 0
                elif len(turns) >= CHUNK or chars >= CHUNK_CHARS:
                    yield record(False)
                    number, alone, turns, roles, texts, chars = number + 1, False, [], [], [], 0
                conv, chars = c, chars + len(text)
                turns.append(turn)
                roles.append(role)
                texts.append(text)
        if turns:
            yield record(False)

    keyed = rows.select(
        _key(),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    # The bounds between tasks are samples of the keys that go to the driver, so of a text only its beginning is a key.
    order = ("conv", F.asc_nulls_first("turn"), "role")
    placed = keyed.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    return map_arrow(placed.select("conv", "turn", "role", "text"), cut, _CHUNK_SCHEMA)


def _key() -> Column:
    return F.to_json(F.struct("conv_id")).alias("conv")


def _symbols(roles: list[str], faults: str) -> str:
    """A letter for each row that may stay: its role's initial or x, a capital if the row is truncated."""
    found = []
    for role, fault in zip(roles, faults, strict=True):
        if fault not in "bd":
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            found.append(letter.upper() if fault == "t" else letter)
    return "".join(found)


def _finished(head: tuple, symbols: str, vectors: bytes, state: int, last: bool) -> tuple:
    """The chunk's record with the edits of its rows, the turns after its last one, and the cost."""
    *_, faults = head
    before = ("", "s", "u", "a")[state]
    stayed, state, cost = trace(symbols, vectors, state)
    own = iter(stayed)
    edits = ["D" if fault in "bd" else next(own) for fault in faults]
    tail = closing(state) if last else ""
    return (*head, edits, before, tail, cost + DELETE * (len(edits) - len(stayed)) + INSERT * len(tail))


def repaired_chunks(rows: DataFrame) -> DataFrame:
    """The chunks of all conversations with their faults and edits; in a conversation they ascend by part and chunk."""
    chunks = written(_chunks(rows), "chunks")

    def alone(*head) -> tuple:
        symbols = _symbols(head[5], head[7])
        vectors, _ = run_back(symbols, _number()[END])
        return _finished(head, symbols, vectors, START, True)

    whole = _mapped(chunks.where("whole").drop("hashes"), _DONE_FIELDS, _DONE_SCHEMA, alone)
    long = chunks.where("not whole")

    # Copies in other chunks of the conversation.
    at = F.struct("part", "chunk")
    firsts = long.select("conv", at.alias("at"), F.posexplode("hashes").alias("k", "hash")).where(F.col("hash").isNotNull())
    least = firsts.groupBy("conv", "hash").agg(F.min("at").alias("least"))
    copies = firsts.join(least, ["conv", "hash"]).where("at > least").groupBy("conv", "at").agg(F.collect_list("k").alias("copies"))
    in_order = Window.partitionBy("conv").orderBy("part", "chunk")
    places = long.select("conv", "part", "chunk").withColumn("place", F.row_number().over(in_order)).withColumn(
        "last", F.lead("part").over(in_order).isNull()
    )

    def lane(conv, part, chunk, place, last, roles, faults, copies) -> tuple:
        copied = set(copies or ())
        faults = "".join("d" if k in copied and f != "b" else f for k, f in enumerate(faults))
        symbols, guess = _symbols(roles, faults), _number()[END]
        return conv, part, chunk, place, last, faults, symbols, run_back(symbols, guess)[0]

    lane_fields = [
        ("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("place", pa.int32()), ("last", pa.bool_()),
        ("faults", pa.string()), ("symbols", pa.string()), ("vectors", pa.binary()),
    ]
    lane_schema = "conv string, part int, chunk int, place int, last boolean, faults string, symbols string, vectors binary"
    lanes = long.select("conv", "part", "chunk", at.alias("at"), "roles", "faults").join(places, ["conv", "part", "chunk"])
    lanes = lanes.join(copies, ["conv", "at"], "left").select(
        "conv", "part", "chunk", "place", "last", "roles", "faults", "copies"
    )
    lanes = written(_mapped(lanes, lane_fields, lane_schema, lane), "lanes")
    lanes = _stitched(lanes, lane_fields, lane_schema)

    # The state that each chunk begins in.
    def ends(conv, place, symbols, vectors) -> tuple:
        return conv, place, bytes(trace(symbols, vectors, state)[1] for state in range(4))

    map_fields = [("conv", pa.string()), ("place", pa.int32()), ("after", pa.binary())]
    maps = _mapped(lanes.select("conv", "place", "symbols", "vectors"), map_fields, "conv string, place int, after binary", ends)
    begun = _walked(
        maps.repartition("conv").sortWithinPartitions("conv", "place"),
        [("conv", pa.string()), ("place", pa.int32()), ("state", pa.int32())],
        "conv string, place int, state int",
        lambda: START,
        lambda state, conv, place, after: (after[state], (conv, place, state)),
    )

    def finish(*values) -> tuple:
        *head, symbols, vectors, state, last = values
        return _finished(tuple(head), symbols, vectors, state, last)

    traced = lanes.join(begun, ["conv", "place"]).select("conv", "part", "chunk", "faults", "symbols", "vectors", "state", "last")
    ready = long.drop("hashes", "faults").join(traced, ["conv", "part", "chunk"])
    ready = ready.select("conv", "part", "chunk", "whole", "turns", "roles", "texts", "faults", "symbols", "vectors", "state", "last")
    return whole.unionByName(_mapped(ready, _DONE_FIELDS, _DONE_SCHEMA, finish))


def _stitched(lanes: DataFrame, fields: list, schema: str) -> DataFrame:
    """The chunks with vectors that follow from those of the chunk after them."""
    number = _number()[END]

    def byte(vectors: str, place: Column) -> Column:
        return F.conv(F.hex(F.substring(F.col(vectors), place, F.lit(1))), 16, 10).cast("int")

    for step in range(PASSES + 1):
        after = lanes.select(
            "conv", (F.col("place") - 1).alias("place"), byte("vectors", F.lit(1)).alias("found")
        )
        joined = lanes.join(after, ["conv", "place"], "left").withColumn("found", F.coalesce("found", F.lit(number)))
        is_open = byte("vectors", F.length("vectors")) != F.col("found")
        wrong = joined.where(is_open)
        if step == PASSES or wrong.isEmpty():
            break

        def again(*values) -> tuple:
            *head, symbols, vectors, found = values
            return (*head, symbols, run_back(symbols, found, vectors)[0])

        names = [n for n, _ in fields]
        rerun = _mapped(wrong.select(*names, "found"), fields, schema, again)
        lanes = written(rerun.unionByName(joined.where(~is_open).select(*names)), "lanes")
    if wrong.isEmpty():
        return lanes

    def every(conv, place, symbols) -> tuple:
        return conv, place, bytes(run_back(symbols, k)[0][0] for k in range(len(starts())))

    open_ones = written(wrong.select("conv").distinct(), "open")
    rest = lanes.join(open_ones, "conv", "left_semi")
    map_fields = [("conv", pa.string()), ("place", pa.int32()), ("before", pa.binary())]
    maps = _mapped(rest.select("conv", "place", "symbols"), map_fields, "conv string, place int, before binary", every)
    ends = _walked(
        maps.repartition("conv").sortWithinPartitions("conv", F.desc("place")),
        [("conv", pa.string()), ("place", pa.int32()), ("found", pa.int32())],
        "conv string, place int, found int",
        lambda: number,
        lambda end, conv, place, before: (before[end], (conv, place, end)),
    )

    def last_run(*values) -> tuple:
        *head, symbols, _, found = values
        return (*head, symbols, run_back(symbols, found)[0])

    names = [n for n, _ in fields]
    done = _mapped(rest.join(ends, ["conv", "place"]).select(*names, "found"), fields, schema, last_run)
    return written(lanes.join(open_ones, "conv", "left_anti").select(*names).unionByName(done), "lanes")


def _turns(
    last: str, roles: list[str], texts: list[str], edits: list[str], tail: str
) -> Iterator[tuple[str, int | None, str, str]]:
    """The edits in order as (edit, row or None, role, text); a deleted row has the role and text that it had.

    `last` is the initial of the turn before the chunk, or empty.
    """
    for k, (role, text, steps) in enumerate(zip(roles, texts, edits, strict=True)):
        for step in steps:
            if step == "D":
                yield step, k, role, text
                continue
            if step in "IR":
                role = _ROLES[ASSISTANT if last == "u" else USER]
            last = role[:1]
            yield step, None if step == "I" else k, role, "" if step == "I" else text
            role = roles[k]
    for _ in tail:
        last = "a" if last == "u" else "u"
        yield "I", None, "assistant" if last == "a" else "user", ""


def repair(rows: DataFrame) -> DataFrame:
    """One row for each edit, in the order (part, chunk, step) within a conversation: conv_id, part, chunk, step, edit
    (keep, rerole, delete, insert), fault (of the row that was there, or null), turn, old_role, role, text; inserted
    turns have no turn and no old role, deleted ones no role."""
    kind = rows.schema["conv_id"].dataType
    names = {"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}
    faults = {"b": "blank", "d": "duplicate", "t": "truncated"}
    fields = [
        ("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("step", pa.int32()), ("edit", pa.string()),
        ("fault", pa.string()), ("turn", pa.int64()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, part, chunk, turns, roles, texts, marks, edits, before, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _batch(
                    [
                        (
                            conv, part, chunk, step, names[edit], None if k is None else faults.get(marks[k]),
                            None if k is None else turns[k], None if k is None else roles[k],
                            None if edit == "D" else role, text,
                        )
                        for step, (edit, k, role, text) in enumerate(_turns(before, roles, texts, edits, tail))
                    ],
                    fields,
                )

    schema = "conv string, part int, chunk int, step int, edit string, fault string, turn long, old_role string, role string, text string"
    done = repaired_chunks(rows).select("conv", "part", "chunk", "turns", "roles", "texts", "faults", "edits", "before", "tail")
    conv_id = F.from_json("conv", f"conv_id {kind.simpleString()}")["conv_id"].alias("conv_id")
    return map_arrow(done, run, schema).select(conv_id, *[n for n, _ in fields[1:]])


_REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A line for each conversation from its chunks in order; of the running text only its hash is held."""
    fields = [("conv", pa.string()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))]
    fields += [("audit", pa.string()), ("repaired_sha256", pa.string())]
    conv, out, now = None, [], None

    def line() -> tuple:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        counts = (now["counts"][f] for f in "bdt")
        return conv, gaps, *counts, now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()

    for batch in batches:
        for c, turns, roles, texts, faults, edits, before, tail, cost in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if c != conv:
                if now:
                    out.append(line())
                conv = c
                now = {"low": None, "high": None, "turns": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256()}
                now |= {"counts": dict.fromkeys("bdt ", 0), "initial": None, "lines": 0}
            for turn, role, fault in zip(turns, roles, faults, strict=True):
                now["counts"][fault] += 1
                if now["initial"] is not None:
                    now["illegal"] += now["initial"] + role[:1] not in ("su", "ua", "au")
                now["initial"] = role[:1]
                if turn is not None and turn != now["high"]:
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"], now["turns"] = turn, now["turns"] + 1
            now["cost"] += cost
            audit = []
            for edit, _, role, text in _turns(before, roles, texts, edits, tail):
                audit.append(edit)
                if edit != "D":
                    now["sha"].update(f"{chr(10) * (now['lines'] > 0)}{role}:{text}".encode())
                    now["lines"] = 1
            now["audit"].append("".join(audit))
        yield _batch(out, fields)
        out = []
    if now:
        yield _batch([line()], fields)


def report(rows: DataFrame, all_ids: DataFrame) -> DataFrame:
    """A line for each conv_id of `all_ids`: faults of its `rows`, the cost and audit of their repair, and a checksum of
    the repaired conversation. Conversations without rows have zeros, no audit and the checksum of nothing."""
    done = written(repaired_chunks(rows), "repaired")
    columns = ("conv", "turns", "roles", "texts", "faults", "edits", "before", "tail", "cost")
    whole = map_arrow(done.where("whole").select(*columns), _digests, _REPORT)
    in_order = done.where("not whole").repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    found = whole.unionByName(map_arrow(in_order.select(*columns), _digests, _REPORT))
    ids = all_ids.select("conv_id").distinct().withColumn("conv", _key())
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
