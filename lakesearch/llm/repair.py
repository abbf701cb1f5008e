"""Repair of conversation structure by iterative-deepening A*.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their first letters. Rows are
kept, reroled or deleted and empty turns are inserted; the cheapest edits win, among
equals the ASCII-least string of edit letters. A depth-first search tries edits in ASCII
order under a bound that grows to the least total it was cut off at; a table of failed
(row, state) pairs with the budget left there keeps it from failing twice. The first
accepting path is the answer, because the next state follows from the letter alone.

A conversation may be of any length, so rows are sorted by range over all tasks and cut
into segments of at most 64. Only a conversation in several segments needs more: the
cheapest prices between a segment's states run backwards through it, so that each
segment knows what every exit will cost, is searched from each of the four states, and the
states are then followed forwards. Both walks stream over a few numbers a segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import written
from .common import table

FOLDS = 20
SPACES = " \t\n\v\f\r"
ENDS = ".!?"
SEGMENT_BITS = 6  # rows of a segment
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

# States: nothing yet, after system, after user, after assistant.
AFTER = (2, 2, 3, 2)  # by a turn that fits in any case: user, but assistant after user
FITS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
NOWHERE = (None, None, None, None)
AT_END = (0, 6, 3, 0)
FAR = 1 << 40


def damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``_conversation, _turn, _role, _text`` after the planted damage; a null counts as one space, but a null turn stays null."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced(conversation), F.lit(":"), spaced(turn))) % FOLDS
    kept = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spaced(text), f"[{ENDS}]", "")).otherwise(spaced(text))
    rows = df.select(
        F.col(conversation).alias("_conversation"),
        F.col(turn).alias("_turn"),
        F.when(fault == 4, "user").otherwise(spaced(role)).alias("_role"),
        kept.alias("_text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.where("_times > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_time")).drop("_times", "_time")


def _token(conversation: str) -> Column:
    """A conversation as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit(""))


def faulty(rows: DataFrame) -> DataFrame:
    """``_c, _turn, _role, _text, _fault, _id``: rows with their first fault, numbered in order.

    Faults: b(lank), d(uplicate), t(runcated) or a dot. Rows are ordered by conversation, turn
    (nulls first), role and text. Equal rows are counted first, so that neither the
    search for duplicates nor the sort by range meets one row very often.
    """
    token = _token("_conversation")
    rows = rows.select(token.alias("_c"), "_turn", F.coalesce("_role", F.lit(" ")).alias("_role"), F.coalesce("_text", F.lit(" ")).alias("_text"))
    units = rows.groupBy("_c", "_turn", "_role", "_text").agg(F.count("*").alias("_n"))
    units = units.withColumn("_same", F.sha2(F.to_json(F.struct("_c", "_role", "_text")), 256))
    place = F.struct(F.col("_turn").isNotNull().alias("set"), F.col("_turn").alias("turn"))
    first = units.groupBy("_same").agg(F.min(place).alias("_first"))
    units = units.join(first, "_same").select("_c", "_turn", "_role", "_text", (place == F.col("_first")).alias("_new"), F.posexplode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    inner = F.rtrim("_text", F.lit(SPACES))
    fault = F.when(inner == "", "b").when(~F.col("_new") | (F.col("pos") > 0), "d").when(~F.substring(inner, -1, 1).isin(*ENDS), "t").otherwise(".")
    units = units.select("_c", "_turn", "_role", "_text", fault.alias("_fault"))
    order = ["_c", F.col("_turn").asc_nulls_first(), "_role", "_text", F.col("_fault") == "d"]
    units = units.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(units.withColumn("_id", F.monotonically_increasing_id()), "turns")


def lower_bounds(codes: str) -> tuple[list[int], list[int]]:
    """What the rows from each position on cost at least, in the first state and in the others.

    Deleting blank and duplicate rows, the price of truncation, roles that fit nowhere, and disjoint
    pairs of neighbours that cannot both stay untouched.
    """
    n = len(codes) // 2
    fixed, any_s, no_s = [0] * (n + 2), [0] * (n + 2), [0] * (n + 2)
    after = n  # the next row that may stay
    for i in range(n - 1, -1, -1):
        letter, fault = codes[2 * i], codes[2 * i + 1]
        must = fault in "bd"
        fixed[i] = fixed[i + 1] + (DELETE if must else TRUNCATED if fault == "t" else 0)
        any_s[i], no_s[i] = any_s[i + 1], no_s[i + 1]
        if must:
            continue
        more = DELETE - TRUNCATED if fault == "t" else REROLE
        if letter not in "ua":
            no_s[i] += more
            any_s[i] += more if letter != "s" else 0
        elif after < n and codes[2 * after] == letter:
            both = min(more, DELETE - TRUNCATED if codes[2 * after + 1] == "t" else REROLE)
            any_s[i] = max(any_s[i], any_s[after + 1] + both)
            no_s[i] = max(no_s[i], no_s[after + 1] + both)
        after = i
    free = [f + max(a, b - REROLE) for f, a, b in zip(fixed, any_s, no_s, strict=True)]
    return free, [f + b for f, b in zip(fixed, no_s, strict=True)]


def cheapest(codes: str, state: int, exits: tuple[int, ...] | None) -> tuple[str, int]:
    """The cheapest, then ASCII-least edits of a segment from ``state``, and the state after it.

    ``codes`` has a role's first letter and a fault for each row. ``exits`` is what each state costs after the
    segment, where another one follows that does the inserting; None at the end.
    """
    n = len(codes) // 2
    least = min(exits) if exits else 0
    bounds = lower_bounds(codes)

    def bound_at(i: int, q: int) -> int:
        return (exits or AT_END)[q] if i == n else bounds[q > 0][i] + least

    failed: dict[tuple[int, int], int] = {}
    beyond = FAR

    def walk(i: int, q: int, spent: int, most: int) -> tuple[str, int] | None:
        nonlocal beyond
        estimate = spent + bound_at(i, q)
        if estimate > most:
            beyond = min(beyond, estimate)
            return None
        if i == n and (exits or q in (0, 3)):
            return "", q
        left = most - spent
        if failed.get((i, q), -1) >= left:
            return None
        fault = codes[2 * i + 1] if i < n else ""
        stays = i < n and fault not in "bd"
        cut = TRUNCATED if fault == "t" else 0
        to = FITS.get(codes[2 * i], NOWHERE)[q] if stays else None
        steps = (
            ("D", i + 1, q, DELETE if i < n else None),
            ("I", i, AFTER[q], INSERT),
            ("K", i + 1, to, None if to is None else cut),
            ("R", i + 1, AFTER[q], REROLE + cut if stays else None),
        )
        for letter, j, r, price in steps:
            if price is not None and (found := walk(j, r, spent + price, most)):
                return letter + found[0], found[1]
        failed[i, q] = left
        return None

    most = bound_at(0, state)
    while True:
        if found := walk(0, state, 0, most):
            return found
        failed.clear()
        most, beyond = beyond, FAR


def prices(codes: str) -> list[int]:
    """The least price from each state before a segment to each state after it, row by row of a 4 x 4 table."""
    out = []
    for start in range(4):
        cost = [FAR] * 4
        cost[start] = 0
        for i in range(0, len(codes), 2):
            for q in (0, 1, 3, 2, 3, 2):  # inserted turns
                cost[AFTER[q]] = min(cost[AFTER[q]], cost[q] + INSERT)
            letter, fault = codes[i], codes[i + 1]
            new = [c + DELETE for c in cost]
            if fault not in "bd":
                cut = TRUNCATED if fault == "t" else 0
                for q, to in enumerate(FITS.get(letter, NOWHERE)):
                    new[AFTER[q]] = min(new[AFTER[q]], cost[q] + REROLE + cut)
                    if to is not None:
                        new[to] = min(new[to], cost[q] + cut)
            cost = new
        out += [min(c, FAR) for c in cost]
    return out


def _mapped(df: DataFrame, row: Callable, schema: str) -> DataFrame:
    """``row`` applied to the values of each row; it may keep values from the one before."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = row()
        for batch in batches:
            rows = [step(*values) for values in zip(*(batch[c] for c in batch.columns), strict=True)]
            yield pd.DataFrame(rows, columns=names)

    return df.mapInPandas(run, schema)


def _backwards() -> Callable:
    """What each state after a segment costs; segments come last first."""
    conversation, following = None, AT_END

    def step(c: str, seg: int, codes: str, table: list[int]) -> tuple:
        nonlocal conversation, following
        if c != conversation:
            conversation, after, following = c, None, AT_END
        else:
            after = list(following)
        following = tuple(min(int(table[4 * q + r]) + following[r] for r in range(4)) for q in range(4))
        return c, seg, codes, after

    return step


def _forwards() -> Callable:
    """The edits of each segment from the state that the one before left."""
    conversation, state = None, 0

    def step(c: str, seg: int, audits: list[str], leads: list[int]) -> tuple:
        nonlocal conversation, state
        conversation, before = c, state if c == conversation else 0
        state = int(leads[before])
        return c, seg, before, audits[before]

    return step


def _searches() -> Callable:
    def step(c: str, seg: int, codes: str, exits: list[int] | None) -> tuple:
        found = [cheapest(codes, q, None if exits is None else tuple(map(int, exits))) for q in range(4)]
        return c, seg, [audit for audit, _ in found], [q for _, q in found]

    return step


def _whole_searches() -> Callable:
    return lambda c, seg, codes: (c, seg, 0, cheapest(codes, 0, None)[0])


def segment_edits(turns: DataFrame) -> DataFrame:
    """``_c, _seg, _state, _audit``: the edits of each segment and the state that it begins in."""
    letter = F.when(F.substring("_role", 1, 1).isin("s", "u", "a"), F.substring("_role", 1, 1)).otherwise("-")
    code = F.struct("_id", F.concat(letter, "_fault").alias("code"))
    slim = turns.select("_c", F.shiftright("_id", SEGMENT_BITS).alias("_seg"), code.alias("_code"))
    segments = slim.groupBy("_c", "_seg").agg(F.array_join(F.transform(F.sort_array(F.collect_list("_code")), lambda x: x["code"]), "").alias("_codes"))
    ends = slim.groupBy("_c").agg((F.min("_seg") < F.max("_seg")).alias("_cut"))
    segments = written(segments.join(ends, "_c"), "segments")
    whole = _mapped(segments.where("not _cut").select("_c", "_seg", "_codes"), _whole_searches, "_c string, _seg long, _state int, _audit string")
    cut = segments.where("_cut").select("_c", "_seg", "_codes")
    cut = _mapped(cut, lambda: lambda c, seg, codes: (c, seg, codes, prices(codes)), "_c string, _seg long, _codes string, _prices array<long>")
    cut = cut.repartition("_c").sortWithinPartitions("_c", F.col("_seg").desc())
    cut = _mapped(cut, _backwards, "_c string, _seg long, _codes string, _exits array<long>")
    cut = _mapped(cut.repartition("_c", "_seg"), _searches, "_c string, _seg long, _audits array<string>, _leads array<int>")
    cut = cut.repartition("_c").sortWithinPartitions("_c", "_seg")
    return whole.unionByName(_mapped(cut, _forwards, "_c string, _seg long, _state int, _audit string"))


EDITED = "_c string, _id long, _step int, edit string, role string, text string, price int"


def _applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows; each segment's edits come before its turns."""
    audit, at, state = "", 0, 0
    for batch in batches:
        out: list[tuple] = []
        for c, i, edits, start, role, text, fault in zip(*(batch[x] for x in batch.columns), strict=True):
            if edits is not None:
                audit, at, state = edits, 0, int(start)
                continue
            done, step = False, 0
            while at < len(audit) and (not done or not audit[at:].strip("I")):
                letter, at = audit[at], at + 1
                role_now, state_now = ("assistant" if state == 2 else "user"), AFTER[state]
                if letter == "I":
                    out.append((c, i, step, letter, role_now, "", INSERT))
                elif letter == "D":
                    out.append((c, i, step, letter, None, None, DELETE))
                    state_now = state
                else:
                    price = TRUNCATED if fault == "t" else 0
                    if letter == "K":
                        role_now, state_now = role, FITS[role[0]][state]
                    out.append((c, i, step, letter, role_now, text, price + REROLE * (letter == "R")))
                done |= letter != "I"
                state, step = state_now, step + 1
        yield pd.DataFrame(out, columns=[x.split(" ")[0] for x in EDITED.split(", ")])


def repaired_rows(turns: DataFrame) -> DataFrame:
    """``_c, _id, _step, edit, role, text, price``: each edit in order, with the row that it leaves (null where deleted)."""
    rows = turns.select("_c", "_id", F.lit(None).cast("string").alias("_audit"), F.lit(0).alias("_state"), "_role", "_text", "_fault", F.shiftright("_id", SEGMENT_BITS).alias("_seg"))
    none = F.lit(None).cast("string")
    edits = segment_edits(turns).select("_c", F.shiftleft("_seg", SEGMENT_BITS).alias("_id"), "_audit", "_state", none.alias("_role"), none.alias("_text"), none.alias("_fault"), "_seg")
    both = rows.unionByName(edits).repartition("_c", "_seg").sortWithinPartitions("_c", "_seg", F.col("_audit").isNull(), "_id")
    return both.drop("_seg").mapInPandas(_applied, EDITED)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``_c, cost, audit, repaired_sha256`` of rows in order; only a digest and the letters are held."""
    names = ["_c", "cost", "audit", "repaired_sha256"]
    now, cost, letters, digest, lines = None, 0, [], hashlib.sha256(), 0
    for batch in batches:
        out = []
        for c, edit, role, text, price in zip(*(batch[x] for x in batch.columns), strict=True):
            if c != now:
                if now is not None:
                    out.append((now, cost, "".join(letters), digest.hexdigest()))
                now, cost, letters, digest, lines = c, 0, [], hashlib.sha256(), 0
            cost += int(price)
            letters.append(edit)
            if edit != "D":
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                lines += 1
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([(now, cost, "".join(letters), digest.hexdigest())], columns=names)


def illegal_pairs(turns: DataFrame) -> DataFrame:
    """``_c, illegal``: neighbours whose first letters are neither su, ua nor au.

    Each row meets the next one by their numbers; where a partition ended, by the ends of the partitions.
    """
    rows = turns.select("_c", "_id", F.substring("_role", 1, 1).alias("_letter"))
    part = F.shiftright("_id", 33)
    ends = rows.groupBy("_c", part.alias("_part")).agg(F.min(F.struct("_id", "_letter")).alias("_first"), F.max(F.struct("_id", "_letter")).alias("_last"))
    inside = rows.select("_c", (F.col("_id") + 1).alias("_id"), F.col("_letter").alias("_before")).join(rows, ["_c", "_id"]).select("_c", F.concat("_before", "_letter").alias("_pair"))
    later = ends.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_part", "_first", "_last"))).alias("_ends")).where(F.size("_ends") > 1)
    over = F.transform(F.sequence(F.lit(1), F.size("_ends") - 1), lambda i: F.concat(F.get("_ends", i - 1)["_last"]["_letter"], F.get("_ends", i)["_first"]["_letter"]))
    across = later.select("_c", F.explode(over).alias("_pair"))
    pairs = inside.unionByName(across)
    return pairs.where(~F.col("_pair").isin("su", "ua", "au")).groupBy("_c").agg(F.count("*").alias("illegal"))


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """A report on each conversation: its faults, and the cheapest edits that repair it.

    ``rows`` has ``_conversation, _turn, _role, _text``; ``conversations`` has ``_conversation``, and each of
    them gets a row, also without turns: zeros, empty ``audit`` and the hash of nothing. A null
    conversation is one of its own. Null roles and texts are one space, which fits nowhere and is
    blank; so is an empty role. Turns of equal number are in the order of role and text,
    repeated rows side by side. ``gaps`` counts missing turn numbers (null turns aside),
    ``illegal`` neighbours, ``cost`` the price of the edits.
    """
    turns = faulty(rows)
    count = lambda fault: F.sum((F.col("_fault") == fault).cast("long"))
    gaps = F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.countDistinct("_turn"), F.lit(0)).cast("long")
    faults = turns.groupBy("_c").agg(gaps.alias("gaps"), count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"))
    ordered = repaired_rows(turns).repartition("_c").sortWithinPartitions("_c", "_id", "_step").select("_c", "edit", "role", "text", "price")
    edits = ordered.mapInPandas(_summaries, "_c string, cost long, audit string, repaired_sha256 string")
    every = conversations.select("_conversation").distinct().withColumn("_c", _token("_conversation"))
    found = every.join(faults, "_c", "left").join(illegal_pairs(turns), "_c", "left").join(edits, "_c", "left").drop("_c")
    return found.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})


def repaired_conversations(spark, folder: str) -> DataFrame:
    """op12: every damaged conversation with its faults and cheapest repair."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report = repaired(damaged(rows), rows.select(F.col("conv_id").alias("_conversation")))
    return report.withColumnRenamed("_conversation", "conv_id")
