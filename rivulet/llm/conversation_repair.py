"""Repair of damaged conversations by iterative-deepening A*.

Rows of a conversation are kept, given another role, deleted, or joined by inserted ones,
so that roles alternate as in ``(s?(ua)+)?``, a system turn and pairs of user and assistant,
at least cost. The search goes depth first and tries edits in ASCII order (Delete, Insert,
Keep, Rerole) under a cost bound. If nothing is accepted, the bound rises to the least
estimate that exceeded it, so the first accepted path is cheapest and, of those, ASCII-least.
A transposition table holds the least cost at which a state (row, role before) has failed
under the bound. The estimate sums what the remaining rows cost in any case and one for each
pair of neighbours that no path may leave as it is; an edit of cost two mends two such pairs.

Long conversations are searched in blocks of rows from the last to the first: each block for
every state at its start, with the exact cost of what follows for every state at its end.
Time so grows in proportion to rows; a search never spans more than a block.

A conversation's audit and the hash of its text are values of its own, so its rows pass one
task, but as sorted streams: the first holds a few bytes a row, the second no more than the
audit. Duplicates are found before by least turns of equal rows, which are aggregated before
they are shuffled.

Null roles and texts are one space. Rows without ``conv_id`` make one conversation, whose id
is null in the result. Rows with the same turn are taken in order of role, then text, those
without turn first. An empty role is the initial of no role. Of an empty table there are no
rows. Gaps beyond 64 bits stand at the greatest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common

#: Faults of a row; the first that holds counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of edits; a truncated row that stays costs one more.
DELETE, INSERT, REROLE, STAYS = 3, 2, 2, 1
#: States between rows: the start, or the role before. What a role leads to from each.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that an insertion or a new role has after each state, and the state it leads to.
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
_LEGAL = {"su", "ua", "au"}
_FAR = 1 << 60
_MOST = (1 << 63) - 1

#: Damage by a row's remainder.
DROP, EMPTY, UNPUNCTUATED, REPEAT, TO_USER = range(5)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after damage; dropped rows keep ``conv_id`` and have a null role."""
    number = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    )
    kind = F.crc32(number.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        kind.alias("kind"),
    )
    dropped = F.col("kind") == DROP
    rows = rows.select(
        "conv_id",
        F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(F.col("kind") == TO_USER, F.lit("user")).when(~dropped, F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTY, F.lit(""))
        .when(F.col("kind") == UNPUNCTUATED, F.regexp_replace("text", "[.!?]", ""))
        .when(~dropped, F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("kind") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Rows with ``fault`` by their text alone, and ``again`` where an earlier turn has the same role and text."""
    key = F.sha2(
        F.concat(
            F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
            F.lit(":"),
            F.length("role").cast("string"),
            F.lit(":"),
            F.col("role"),
            F.col("text"),
        ).cast("binary"),
        256,
    )
    visible = r"[^\x20\x09-\x0D]"
    # Trimming first keeps the search for the last character in proportion to the text.
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(visible), BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    )
    rows = rows.withColumn("key", key).withColumn("fault", fault)
    here = rows.where(F.col("key").isNotNull())
    first = here.groupBy(F.col("key").alias("first_key")).agg(F.min(F.struct("turn")).alias("first"))
    joined = here.join(first, F.col("key") == F.col("first_key"))
    joined = joined.withColumn("again", ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("first_key", "first")
    # Dropped rows have no key; joined by it they would meet in one task.
    return joined.unionByName(rows.where(F.col("key").isNull()).withColumn("again", F.lit(False)))


def estimates(roles: list[str], flaws: bytes, closed: bool) -> tuple[list[int], list[str]]:
    """What rows from each on cost at least, and the first role among them that can stay.

    ``closed`` says that the rows end the conversation, where only an assistant may be last.
    """
    n = len(flaws)
    least, first = [0] * (n + 1), [""] * (n + 1)
    after = ""
    for i in range(n - 1, -1, -1):
        if flaws[i] in (BLANK, DUPLICATE):
            least[i], first[i] = least[i + 1] + DELETE, after
            continue
        pair = roles[i] + after
        amiss = pair not in _LEGAL if after else closed and roles[i] != "a"
        least[i] = least[i + 1] + (flaws[i] == TRUNCATED) * STAYS + amiss
        first[i] = after = roles[i]
    return least, first


def search(
    roles: list[str], flaws: bytes, state: int, beyond: tuple[int, ...] | None = None
) -> tuple[int, str, int]:
    """Cost, audit and last state of the cheapest edits of these rows, the ASCII-least of equals.

    ``beyond`` is the cost of what follows the rows, by state; no rows are inserted behind
    them then, as those come before the rows that follow. Without it the conversation ends.
    """
    n, closed = len(flaws), beyond is None
    least, first = estimates(roles, flaws, closed)
    rest = (0, _FAR, _FAR, 0) if closed else beyond
    floor = 0 if closed else min(rest)

    def estimate(i: int, state: int) -> int:
        if i == n:
            return rest[state] if not closed else 0 if state in (START, ASSISTANT) else INSERT
        return least[i] + floor + (first[i] != "" and first[i] not in STEPS[state])

    bound = estimate(0, state)
    while True:
        higher, failed = _FAR, {}
        # Each entry: row, state, cost, place of the last edit in the path, that edit.
        stack: list[tuple[int, int, int, int, str]] = [(0, state, 0, 0, "")]
        path: list[str] = []
        while stack:
            i, at, cost, depth, edit = stack.pop()
            guess = cost + estimate(i, at)
            if guess > bound:
                higher = min(higher, guess)
                continue
            if failed.get((i, at), _FAR) <= cost:
                continue
            failed[i, at] = cost
            del path[depth:]
            path.append(edit)
            depth = len(path)
            if i == n and (not closed or at in (START, ASSISTANT)):
                return cost + (0 if closed else rest[at]), "".join(path), at
            # The stack gives back the last first, so edits go in from R to D.
            if i < n:
                if flaws[i] not in (BLANK, DUPLICATE):
                    stays = STAYS if flaws[i] == TRUNCATED else 0
                    stack.append((i + 1, NEXT[at][1], cost + REROLE + stays, depth, "R"))
                    if roles[i] in STEPS[at]:
                        stack.append((i + 1, STEPS[at][roles[i]], cost + stays, depth, "K"))
                stack.append((i, NEXT[at][1], cost + INSERT, depth, "I"))
                stack.append((i + 1, at, cost + DELETE, depth, "D"))
            elif closed:
                stack.append((i, NEXT[at][1], cost + INSERT, depth, "I"))
        bound = higher


def repair(roles: list[str], flaws: bytes, block: int = 64) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    ends = list(range(0, len(flaws), block)) or [0]
    found: list[list[tuple[int, str, int]]] = []
    beyond = None
    for begin in reversed(ends):
        own, flaw = roles[begin : begin + block], flaws[begin : begin + block]
        states = (START, SYSTEM, USER, ASSISTANT) if begin else (START,)
        found.append([search(own, flaw, s, beyond) for s in states])
        beyond = tuple(cost for cost, _, _ in found[-1])
    audit, state = [], START
    for blocks in reversed(found):
        _, edits, state = blocks[state]
        audit.append(edits)
    return found[-1][START][0], "".join(audit)


_AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of rows that come sorted."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out: list[tuple] = []
    for conv_id, own in groupby(rows(), key=lambda r: r[0]):
        roles, flaws = [], bytearray()
        low = high = turn_before = key_before = None
        distinct = illegal = 0
        for _, turn, initial, fault, again, key in own:
            if key is None:  # dropped
                continue
            if turn is not None and turn != turn_before:
                distinct += 1
                low, high = turn if low is None else low, turn
                turn_before = turn
            if fault != BLANK and (again or key == key_before):
                fault = DUPLICATE
            key_before = key
            illegal += bool(roles) and roles[-1] + initial not in _LEGAL
            roles.append(initial)
            flaws.append(fault)
        cost, audit = repair(roles, bytes(flaws), block)
        gaps = 0 if low is None else min(high - low + 1 - distinct, _MOST)
        counts = (flaws.count(k) for k in (BLANK, DUPLICATE, TRUNCATED))
        out.append((conv_id, gaps, *counts, illegal, cost, audit))
        if len(out) >= 1000 or len(audit) > 1 << 16:
            yield _batch(out, _AUDITS)
            out = []
    if out:
        yield _batch(out, _AUDITS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in schema.split(", ")), strict=True)
    arrow = {"long": pa.int64(), "string": pa.string()}
    columns = [pa.array(c, arrow[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


_REPAIRED = f"{_AUDITS}, repaired_sha256 string"


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits with the hash of the repaired rows, which follow each audit in order."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out: list[tuple] = []
    for conv_id, own in groupby(rows(), key=lambda r: r[0]):
        about = next(own)[3:]
        audit, digest = about[-1], hashlib.sha256()
        at, state, lines = 0, START, 0

        def line(role: str, text: str) -> None:
            nonlocal lines
            digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())  # noqa: B023
            lines += 1

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":  # noqa: B023
                role, state = NEXT[state]
                line(role, "")  # noqa: B023
                at += 1

        for _, role, text, *_ in own:
            if role is None:
                continue
            inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = STEPS[state][role[:1]]
                line(role, text)
            elif edit == "R":
                role, state = NEXT[state]
                line(role, text)
        inserted()
        out.append((conv_id, *about, digest.hexdigest()))
        if len(out) >= 1000 or len(audit) > 1 << 16:
            yield _batch(out, _REPAIRED)
            out = []
    if out:
        yield _batch(out, _REPAIRED)


def _in_order(rows: DataFrame, *first: Column) -> DataFrame:
    n = common.partitions(rows.sparkSession)
    dealt = rows.repartition(n, "conv_id")
    return dealt.sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def repair_conversations(rows: DataFrame, block: int = 64) -> DataFrame:
    """Per conversation of rows ``conv_id``, ``turn``, ``role``, ``text``: its faults, repair and their hash.

    Rows with a null role only tell that there is such a conversation.
    """
    ordered = _in_order(faults(rows))
    light = ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "again", "key")
    audits = common.written(light.mapInArrow(lambda batches: _audits(batches, block), _AUDITS), "audits")
    names = audits.columns[1:]
    heads = audits.select("conv_id", F.lit(0).alias("part"), *(F.lit(None).cast(t).alias(c) for c, t in _ROW), *names)
    tails = rows.select("conv_id", F.lit(1).alias("part"), *(c for c, _ in _ROW), *(F.lit(None).cast(audits.schema[c].dataType).alias(c) for c in names))
    streamed = _in_order(heads.unionByName(tails), F.col("part"))
    return streamed.select("conv_id", "role", "text", *names).mapInArrow(_hashes, _REPAIRED)


_ROW = (("turn", "bigint"), ("role", "string"), ("text", "string"))
