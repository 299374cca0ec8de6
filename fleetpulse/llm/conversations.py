"""Conversation structure repair: the cheapest edits that give every
conversation the roles ``(system? (user assistant)+)?``.

A row is kept (0), given the role its place calls for (2) or deleted (3);
a turn without text may be inserted anywhere (2). Blank and duplicate rows
must go; a truncated row that stays costs 1 more. Of the cheapest edit
sequences the one whose initials (Delete, Insert, Keep, Rerole) are least in
ASCII order is taken, which fixes the result.

Method: depth-first branch-and-bound per conversation (``cheapest``) with an
explicit stack. A node is (rows done, place in the role pattern). Suffix lower
bounds come from the problem without its tie-break: the least cost of finishing
from each node. Children are tried by (cost + bound, initial); the incumbent is
a (cost, audit); a table of the least cost at which each node was entered drops
prefixes that are no better; the search ends when the stack is empty, or when
the incumbent reaches the root's bound, which proves it.

Two passes, neither holding a conversation's texts: the first sorts compact
rows (turn, role, digest of role and text, fault), one byte a row reaches the
search; the second streams the sorted turns past the edits found. A
conversation is one task's stream (its repaired text is one sequence), sorts
spill, and memory is 1 byte a row for the rows, 8 for bounds and table.

Defined cases: null texts, roles and turns read as one space (turns come
first); rows of equal turn are ordered by role, then by digest; a null id is a
conversation of its own; a conversation without rows after ``gone`` has zeros
and no turns; an empty table gives empty results; only named columns are read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetpulse.llm.tables import staged

# Costs of the edits, and of a truncated row that stays.
INSERT, REROLE, DELETE, TRUNCATED_STAYS = 2, 2, 3, 1
WHITE = " \t\n\x0b\x0c\r"

# Places in the role pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}       # by a new or changed role
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua?"
LEGAL = {"su", "ua", "au"}
FINE, MUST_GO, CUT_OFF = 0, 1, 2
FAULTS = ("blank", "duplicate", "truncated")
FAR = 1 << 30


def _row(code: int) -> tuple[str, int]:
    return INITIALS[code & 3], code >> 2


def suffix_bounds(rows: bytes) -> array:
    """Least cost of finishing from (i, place), at 4 * i + place."""
    n = len(rows)
    out = array("i", bytes(16 * (n + 1)))
    after = [0, 2 * INSERT, INSERT, 0]
    out[4 * n:] = array("i", after)
    for i in range(n - 1, -1, -1):
        initial, fault = _row(rows[i])
        stay = FAR if fault == MUST_GO else TRUNCATED_STAYS if fault == CUT_OFF else 0
        here = [0] * 4
        for place in range(4):
            to = KEEP.get((place, initial))
            here[place] = min(DELETE + after[place], stay + REROLE + after[NEXT[place]],
                              FAR if to is None else stay + after[to])
        here[USER], here[ASSISTANT] = (min(here[USER], INSERT + here[ASSISTANT]),
                                       min(here[ASSISTANT], INSERT + here[USER]))
        here[START] = min(here[START], INSERT + here[USER])
        here[SYSTEM] = min(here[SYSTEM], INSERT + here[USER])
        out[4 * i:4 * i + 4] = array("i", here)
        after = here
    return out


def children(rows: bytes, i: int, place: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows done, place) of every edit at a node."""
    out = [("I", INSERT, i, NEXT[place])]
    if i < len(rows):
        initial, fault = _row(rows[i])
        out.append(("D", DELETE, i + 1, place))
        if fault != MUST_GO:
            stay = TRUNCATED_STAYS if fault == CUT_OFF else 0
            out.append(("R", REROLE + stay, i + 1, NEXT[place]))
            to = KEEP.get((place, initial))
            if to is not None:
                out.append(("K", stay, i + 1, to))
    return out


def cheapest(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; a row is its initial's index in
    ``INITIALS`` plus four times its fault."""
    n = len(rows)
    bound = suffix_bounds(rows)
    entered = array("i", [FAR]) * (4 * (n + 1))         # dominance: least cost at each node so far
    incumbent: tuple[int, str] = (FAR, "")
    path = bytearray()
    stack = [(0, START, 0, 0, "")]
    while stack:
        i, place, cost, depth, edit = stack.pop()
        node = 4 * i + place
        # Siblings come by (bound, initial): what is met later at equal cost has the greater audit.
        if cost + bound[node] >= incumbent[0] or cost >= entered[node]:
            continue
        entered[node] = cost
        del path[max(0, depth - 1):]
        path += edit.encode()
        if i == n and place in (START, ASSISTANT):
            incumbent = (cost, path.decode())
            if cost == bound[START]:
                break
            continue
        options = sorted(((cost + c + bound[4 * j + to], e, j, to, cost + c)
                          for e, c, j, to in children(rows, i, place)), reverse=True)
        stack += [(j, to, c, depth + 1, e) for _, e, j, to, c in options]
    return incumbent


def marked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone -> the same without nulls, with what
    orders rows and whether a row is blank or truncated."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    shown = F.rtrim(text, F.lit(WHITE))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        gone.alias("gone"),
                        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
                        .alias("digest"),
                        (shown == "").alias("blank"), (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"))


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, tuple]]:
    """(first row of a conversation, the row's values), over all batches."""
    before, any_row = None, False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            yield not any_row or row[0] != before, row
            before, any_row = row[0], True


def plan(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. ``turns``: conv_id, turn, role, text and, if some
    rows only name their conversation, ``gone``."""
    rows = marked(turns)
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    same = Window.partitionBy("conv_id", "digest", "gone").orderBy(F.col("turn").asc_nulls_first())
    compact = (rows.drop("text").repartition("conv_id")
               .withColumn("again", F.row_number().over(same) > 1)
               .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "gone", "role", "digest",
                       F.when(F.col("blank"), 0).when(F.col("again"), 1).when(F.col("cut"), 2).otherwise(-1)
                       .alias("fault"))
               .sortWithinPartitions("conv_id", *order).select("conv_id", "turn", "initial", "gone", "fault"))
    schema = StructType([turns.schema["conv_id"], *StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = None
        done: list[tuple] = []
        state: dict | None = None

        def close():
            cost, audit = cheapest(bytes(state["rows"]))
            gaps = state["last"] - state["first"] + 1 - state["turns"] if state["turns"] else 0
            done.append((state["id"], gaps, *state["faults"], state["illegal"], cost, audit))

        def flush():
            out = pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*done), out_schema)],
                                  schema=out_schema)
            done.clear()
            return out

        def typed(batches):
            nonlocal out_schema
            for batch in batches:
                out_schema = out_schema or pa.schema(
                    [batch.schema.field("conv_id"), *[pa.field(c, pa.int64()) for c in (
                        "gaps", *FAULTS, "illegal", "cost")], pa.field("audit", pa.string())])
                yield batch

        for new, (conv, turn, initial, gone, fault) in _grouped(
                typed(batches), ["conv_id", "turn", "initial", "gone", "fault"]):
            if new:
                if state is not None:
                    close()
                    if len(done) >= 4096:
                        yield flush()
                state = {"id": conv, "rows": bytearray(), "faults": [0, 0, 0], "illegal": 0, "before": None,
                         "turns": 0, "first": None, "last": None}
            if gone:
                continue
            if turn is not None and (not state["turns"] or turn != state["last"]):
                state["first"] = turn if state["first"] is None else state["first"]
                state["last"], state["turns"] = turn, state["turns"] + 1
            if state["before"] is not None and state["before"] + initial not in LEGAL:
                state["illegal"] += 1
            state["before"] = initial
            if fault >= 0:
                state["faults"][fault] += 1
            at = INITIALS.find(initial) if initial in ("s", "u", "a") else 3
            state["rows"].append(at + 4 * (FINE if fault < 0 else CUT_OFF if fault == 2 else MUST_GO))
        if state is not None:
            close()
        if done:
            yield flush()

    return compact.mapInArrow(scan, schema)


def _streamed(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Every conversation's edits, followed by its turns in order."""
    texts = marked(turns).where("not gone").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    head = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                        F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"))
    return (head.unionByName(texts).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest")
            .select("conv_id", "kind", "role", "text"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, str, str | None, str | None]]:
    """(conversation begins, conv_id, edit, role, text) for every edit; an
    event without an edit ("") announces a conversation."""
    conv, audit, at, place = None, "", 0, START

    def inserts():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            place, at = NEXT[place], at + 1
            yield False, conv, "I", ROLE[place], ""

    for new, (key, kind, role, text) in _grouped(batches, ["conv_id", "kind", "role", "text"]):
        if kind == 0:
            yield from inserts()
            conv, audit, at, place = key, text, 0, START
            yield True, conv, "", None, None
            continue
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "K":
            place = KEEP[place, role[:1]]
            yield False, conv, "K", role, text
        elif edit == "R":
            place = NEXT[place]
            yield False, conv, "R", ROLE[place], text
        else:
            yield False, conv, "D", None, None
    yield from inserts()


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position (from 0), edit, role, text."""
    schema = StructType([turns.schema["conv_id"], *StructType.fromDDL(
        "position long, edit string, role string, text string")])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, size, position, kind = [], [], 0, 0, None

        def typed():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def flush():
            out = pa.record_batch([pa.array(ids, kind), *(pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.string())))],
                names=["conv_id", "position", "edit", "role", "text"])
            ids.clear(), rows.clear()
            return out

        for begins, conv, edit, role, text in _edited(typed()):
            if begins:
                position = 0
            elif edit != "D":
                ids.append(conv)
                rows.append((position, edit, role, text))
                position, size = position + 1, size + len(text)
                if len(rows) >= 4096 or size > 1 << 22:
                    yield flush()
                    size = 0
        if rows:
            yield flush()

    return _streamed(turns, plans).mapInArrow(write, schema)


def digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired ``role:text`` lines, hashed
    as they stream by."""
    schema = StructType([turns.schema["conv_id"], StructField("repaired_sha256", StringType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums, running, first, kind = [], [], None, True, None

        def typed():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def flush():
            out = pa.record_batch([pa.array(ids, kind), pa.array(sums, pa.string())],
                                  names=["conv_id", "repaired_sha256"])
            ids.clear(), sums.clear()
            return out

        held = None
        for begins, conv, edit, role, text in _edited(typed()):
            if begins:
                if running is not None:
                    ids.append(held), sums.append(running.hexdigest())
                    if len(ids) >= 4096:
                        yield flush()
                held, running, first = conv, hashlib.sha256(), True
            elif edit != "D":
                running.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False
        if running is not None:
            ids.append(held), sums.append(running.hexdigest())
        if ids:
            yield flush()

    return _streamed(turns, plans).mapInArrow(write, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The stated damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row
    (it stays, ``gone``, to name its conversation), 1 empties its text, 2
    takes its ``.!?`` away, 3 repeats it, 4 makes its role user."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), F.pmod(
        F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20)).alias("harm"))
    harm = F.col("harm")
    return rows.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (harm == 0).alias("gone"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def repair_report(turns: DataFrame) -> DataFrame:
    """``plan`` with each conversation's ``repaired_sha256``."""
    plans = staged(plan(turns), "edits")
    sums = digests(turns, plans).withColumnRenamed("conv_id", "id")
    return plans.join(sums, plans.conv_id.eqNullSafe(sums.id)).drop("id")
