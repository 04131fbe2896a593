"""Damage to conversations, its faults, and the cheapest repair, streamed turn by turn."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: ASCII white space, the ends of a whole text, the roles that edits give.
SPACE, STOPS = "\t\n\x0b\x0c\r ", ".!?"
GIVEN = {"u": "user", "a": "assistant"}
#: Costs of edits; a truncated row that is not deleted costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Backpointers that a task holds in memory; those of longer conversations go to a file of the task.
HELD = 1 << 20
#: Role initials; any other initial is ``OTHER``.
INITIALS, OTHER = "sua", 3
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Where a repaired conversation may stand: before all, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Where a kept initial leads, and which initial an edit gives.
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
NEXT = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
#: Edits as two bits, in ASCII order.
EDITS = "DIKR"


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copy, was_role, was_text): rows damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user. Null roles,
    texts and, within the checksum, ids and turns are one space.
    """
    blank = F.lit(" ")
    was = [F.coalesce(F.col(f"`{c}`").cast("string"), blank) for c in (conv_id, turn)]
    kind = F.crc32(F.concat(was[0], F.lit(":"), was[1]).cast("binary")) % 20
    base = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), kind.alias("kind"),
        F.coalesce(F.col(f"`{role}`"), blank).alias("was_role"), F.coalesce(F.col(f"`{text}`"), blank).alias("was_text"),
    ).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("was_text", "[.!?]", ""))
    return base.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("was_role")).alias("role"),
        body.otherwise(F.col("was_text")).alias("text"), F.explode(copies).alias("copy"), "was_role", "was_text",
    )


def _key() -> Column:
    """A conversation's name as a string that is never null."""
    return F.to_json(F.struct(F.col("conv_id").alias("c")))


def numbered(rows: DataFrame) -> DataFrame:
    """(key, seq, turn, role, text, kind, fault): damaged rows by turn (null first), numbered from 1, with their first fault.

    Rows of the same turn follow role and text as they were before the damage.
    """
    order = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "was_role", "was_text", "copy")
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    base = written(
        rows.withColumn("key", _key()).select(
            "key", F.row_number().over(order).cast("long").alias("seq"), "turn", "role", "text", kind.alias("kind"),
            (~F.col("text").rlike(WORD)).alias("blank"), (~end.isin(*STOPS)).alias("cut"),
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        )
    )
    first = base.groupBy("key", "digest").agg(F.min("seq").alias("seq")).select("key", "seq", F.lit(True).alias("new"))
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(SOUND)
    )
    faults = base.select("key", "seq", "blank", "cut").join(first, ["key", "seq"], "left").select(
        "key", "seq", fault.alias("fault")
    )
    return written(base.select("key", "seq", "turn", "role", "text", "kind").join(faults, ["key", "seq"]))


class Pointers:
    """One byte per turn, last turn first; what does not fit in memory goes to a file that ends with the task."""

    def __init__(self, held: int = HELD):
        self.held, self.bytes, self.file = held, bytearray(), None

    def add(self, byte: int) -> None:
        self.bytes.append(byte)
        if len(self.bytes) >= self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.bytes)
            self.bytes.clear()

    def from_last(self) -> Iterator[int]:
        yield from reversed(self.bytes)
        end = self.file.tell() if self.file else 0
        while end:
            start = max(0, end - self.held)
            self.file.seek(start)
            yield from reversed(self.file.read(end - start))
            end = start

    def clear(self) -> None:
        self.bytes.clear()
        if self.file:
            self.file.close()
            self.file = None


def ends() -> tuple[tuple[int, ...], int]:
    """What it costs to end in each state, and the edits for it."""
    return _inserted([0, None, None, 0], [None] * 4)


def _inserted(cost: list[int | None], edit: list[int | None]) -> tuple[tuple[int, ...], int]:
    """Costs and edits once turns may be inserted first; an equally cheap edit with a smaller letter wins."""
    cost, edit = list(cost), list(edit)
    insert = EDITS.index("I")
    for _ in range(4):  # no cheapest repair inserts more than three turns in a row
        for state in range(4):
            after = cost[KEPT[state, NEXT[state]]]
            if after is not None and (
                cost[state] is None
                or INSERT + after < cost[state]
                or (INSERT + after == cost[state] and edit[state] is not None and insert < edit[state])
            ):
                cost[state], edit[state] = INSERT + after, insert
    return tuple(cost), sum((e or 0) << (2 * s) for s, e in enumerate(edit))


def step(after: tuple[int, ...], kind: int, fault: int) -> tuple[tuple[int, ...], int, int]:
    """One turn further from the end: the least costs of the rest from each state, less their minimum, that minimum,
    and the edit to make there, the ASCII-least of the cheapest, packed in one byte."""
    cost: list[int | None] = [None] * 4
    edit: list[int | None] = [None] * 4
    more = TRUNCATED if fault == CUT else 0
    for state in range(4):
        choices = [(DELETE + after[state], EDITS.index("D"))]
        if fault not in (BLANK, DUPLICATE):
            if kind != OTHER and (state, INITIALS[kind]) in KEPT:
                choices.append((more + after[KEPT[state, INITIALS[kind]]], EDITS.index("K")))
            choices.append((REROLE + more + after[KEPT[state, NEXT[state]]], EDITS.index("R")))
        cost[state], edit[state] = min(choices)
    total, packed = _inserted(cost, edit)
    least = min(total)
    return tuple(c - least for c in total), least, packed


def follow(pointers: Iterator[int], kinds: Iterator[int], last: int) -> Iterator[str]:
    """The edits of a conversation from its first turn on, by the pointers of its turns and those of its end."""
    state = START
    for packed, kind in zip(pointers, kinds):
        while True:
            edit = EDITS[packed >> (2 * state) & 3]
            yield edit
            if edit in "IR":
                state = KEPT[state, NEXT[state]]
            elif edit == "K":
                state = KEPT[state, INITIALS[kind]]
            if edit != "I":
                break
    while state in (AFTER_S, AFTER_U):
        yield EDITS[last >> (2 * state) & 3]
        state = KEPT[state, NEXT[state]]


def audits(turns: DataFrame, conversations: DataFrame, held: int = HELD) -> DataFrame:
    """(key, blank, duplicate, truncated, illegal, cost, audit) of each of ``conversations`` (key).

    Turns come by conversation, last turn first, one small number each. The least costs of the rest of the
    conversation go from turn to turn, across Arrow batches; each turn leaves one byte that says which edit is best
    in each state. Costs less their minimum take few values, so a step is looked up after its first time. The row
    ``seq`` 0 of a conversation comes last and follows the bytes from the first turn on.
    """
    code = (F.col("kind") * 4 + F.col("fault")).cast("int").alias("code")
    rows = turns.select("key", "seq", code).unionByName(
        conversations.select("key", F.lit(0).cast("long").alias("seq"), F.lit(0).alias("code"))
    )
    rows = rows.repartition("key").sortWithinPartitions("key", F.desc("seq"))
    allowed = {(INITIALS.index(a), INITIALS.index(b)) for a, b in ("su", "ua", "au")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        first, last = ends()
        pointers, classes = Pointers(held), Pointers(held)
        costs, total, counts, illegal, later = first, 0, [0] * 4, 0, None
        for batch in batches:
            out = []
            for key, seq, code in zip(batch["key"].tolist(), batch["seq"].tolist(), batch["code"].tolist()):
                if seq:
                    found = known.get((costs, code))
                    if found is None:
                        found = known[costs, code] = step(costs, code >> 2, code & 3)
                    costs, more, packed = found
                    total += more
                    pointers.add(packed)
                    classes.add(code >> 2)
                    counts[code & 3] += 1
                    if later is not None and (code >> 2, later) not in allowed:
                        illegal += 1
                    later = code >> 2
                    continue
                audit = ""
                if later is not None:
                    audit = "".join(follow(pointers.from_last(), classes.from_last(), last))
                    total += costs[START]
                out.append((key, counts[BLANK], counts[DUPLICATE], counts[CUT], illegal, total, audit))
                pointers.clear(), classes.clear()
                costs, total, counts, illegal, later = first, 0, [0] * 4, 0, None
            yield pd.DataFrame(out, columns=["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return rows.mapInPandas(
        run, "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    )


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(key, at, edit, role, text): the turns of the repaired conversations from 1 on, those of one conversation in order.

    The edits of a conversation come before its turns in the same sorted stream; only they are held.
    """
    rows = turns.select("key", "seq", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(
        found.select("key", F.lit(0).cast("long").alias("seq"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    )
    rows = rows.repartition("key").sortWithinPartitions("key", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, edits, place, state, at = None, "", 0, START, 0
        out: list[tuple] = []

        def add(edit: str, role: str, text: str) -> None:
            nonlocal state, at
            if edit == "K":
                state = KEPT[state, role[0]]
            else:
                role, state = GIVEN[NEXT[state]], KEPT[state, NEXT[state]]
            at += 1
            out.append((current, at, edit, role, text))

        def inserts() -> None:
            nonlocal place
            while edits[place : place + 1] == "I":
                add("I", "", "")
                place += 1

        for batch in batches:
            for key, seq, role, text, audit in zip(*(batch[c].tolist() for c in ("key", "seq", "role", "text", "audit"))):
                if not seq:
                    inserts()
                    current, edits, place, state, at = key, audit, 0, START, 0
                    continue
                inserts()
                if edits[place] != "D":
                    add(edits[place], role, text)
                place += 1
            yield pd.DataFrame(out, columns=["key", "at", "edit", "role", "text"])
            out.clear()
        inserts()
        yield pd.DataFrame(out, columns=["key", "at", "edit", "role", "text"])

    return rows.mapInPandas(run, "key string, at long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of conversations whose turns follow each other: role:text, joined by line feeds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, digest = None, None
        for batch in batches:
            out = []
            for key, at, role, text in zip(*(batch[c].tolist() for c in ("key", "at", "role", "text"))):
                if at == 1:
                    if current is not None:
                        out.append((current, digest.hexdigest()))
                    current, digest = key, sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
        if current is not None:
            yield pd.DataFrame([(current, digest.hexdigest())], columns=["key", "repaired_sha256"])

    return repaired.select("key", "at", "role", "text").mapInPandas(run, "key string, repaired_sha256 string")


def repair(rows: DataFrame, conv_id: str = "conv_id", **columns: str) -> tuple[DataFrame, DataFrame]:
    """What the damage did to each conversation, and the repaired turns of all.

    First: key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; one row per conversation, null
    included, even if no turn is left (zeros, empty audit). Second: key, at, edit, role, text. A repaired
    conversation is empty, or an optional system turn and then user and assistant in turn. Of the cheapest repairs
    the one whose edits come first in ASCII order is made. Repeated rows stay apart; columns other than those named
    are not read; an empty table gives no rows.
    """
    all_ids = rows.select(F.col(f"`{conv_id}`").alias("conv_id")).distinct().withColumn("key", _key())
    turns = numbered(damage(rows, conv_id, **columns))
    found = written(audits(turns, all_ids.select("key")))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = turns.groupBy("key").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))
    report = all_ids.join(found, "key").join(gaps, "key", "left").select(
        "key", "conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", "audit",
    )
    return report, repaired_turns(turns, found)
