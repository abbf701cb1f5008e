import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from lakesearch.llm.repair import cheapest, damaged, faulty, lower_bounds, prices, repaired, repaired_conversations, repaired_rows

WS = " \t\n\v\f\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """Cheapest then least edits by uniform-cost search over whole edit strings, without a heuristic or table."""
    heap, n = [(0, "", 0, "", ())], len(rows)
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == n and LEGAL.fullmatch(roles):
            return cost, audit, out
        # a role string that no further turn completes is cut
        fits = lambda r: re.fullmatch(r"(s?(ua)*u?)?", r) is not None
        if i < n:
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] and fits(roles + role[0]):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[0], (*out, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if fits(roles + name[0]):
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, roles + name[0], (*out, f"{name}:{text}")))
        for name in ("user", "assistant"):
            if fits(roles + name[0]):
                heapq.heappush(heap, (cost + 3, audit + "I", i, roles + name[0], (*out, f"{name}:")))


def plain_report(rows, damage=True):
    """The whole contract in plain Python; ``rows`` are ``conv_id, turn, role, text``."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    report = set()
    for conv, kept in found.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, seen = [], set()
        for _, role, text in kept:
            inner = text.rstrip(WS)
            faults.append("blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, out = brute([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        report.add((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return report


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_operator(spark, rows, damage=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = damaged(df) if damage else df.toDF("_conversation", "_turn", "_role", "_text")
    found = repaired(turns, df.select(F.col("conv_id").alias("_conversation"))).withColumnRenamed("_conversation", "conv_id")
    out = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    assert len(out) == len(set(out))
    return set(out)


def codes(rng, n):
    return "".join(rng.choice("ssuuuaaa-") + rng.choice("....tbd") for _ in range(n))


FAULTS = {".": "", "t": "truncated", "b": "blank", "d": "duplicate"}


def test_search_against_every_edit_string():
    rng = random.Random(1)
    for _ in range(150):
        c = codes(rng, rng.randrange(6))
        rows = [(c[i], "x", FAULTS[c[i + 1]]) for i in range(0, len(c), 2)]
        cost, audit, _ = brute(rows)
        assert cheapest(c, 0, None)[0] == audit
        table = prices(c)
        assert cost == min(table[r] + (0, 6, 3, 0)[r] for r in range(4))
        assert lower_bounds(c)[0][0] <= cost


def test_bounds_are_never_too_high():
    rng = random.Random(2)
    for _ in range(2000):
        c = codes(rng, rng.randrange(9))
        table, (free, bound) = prices(c), lower_bounds(c)
        for q in range(4):
            assert (bound if q else free)[0] <= min(table[4 * q : 4 * q + 4])


def test_segments_join_to_the_search_of_the_whole():
    rng = random.Random(3)
    for _ in range(40):
        c = codes(rng, 30)
        whole, _ = cheapest(c, 0, None)
        cut = 2 * rng.randrange(1, 29)
        table = prices(c[cut:])
        after = tuple(min(table[4 * q + r] + (0, 6, 3, 0)[r] for r in range(4)) for q in range(4))
        first, state = cheapest(c[:cut], 0, after)
        assert first + cheapest(c[cut:], state, None)[0] == whole


def conversations(rng, n):
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(6)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "umpire", "tool", "", None])
            text = rng.choice(["Yes.", "no", "What?  ", " \t", "", None, "Fine!\n", "Same."])
            rows += [(conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def test_against_brute_force(spark):
    rows = conversations(random.Random(4), 60)
    assert by_operator(spark, rows) == plain_report(rows)
    assert by_operator(spark, rows, damage=False) == plain_report(rows, damage=False)


def test_a_conversation_in_many_segments(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]) if t % 9 else "system", rng.choice([f"{t}.", f"{t}", "again."])) for t in range(700)]
    rows += [(2, t, "user", "x.") for t in range(150)] + [(3, None, "user", "lone.")]
    turns = faulty(spark.createDataFrame(rows, "_conversation long, _turn long, _role string, _text string")).orderBy("_id").collect()
    got = {r[0]: r for r in by_operator(spark, rows, damage=False)}
    for conv in (1, 2, 3):
        mine = "".join(r["_role"][0] + r["_fault"] for r in turns if r["_c"] == f"={conv}")
        table = prices(mine)
        assert got[conv][6] == min(table[r] + (0, 6, 3, 0)[r] for r in range(4))
        assert len(got[conv][7].replace("I", "")) == len(mine) // 2


def test_repaired_rows_are_the_conversation(spark):
    rows = [(1, 1, "system", "Hi."), (1, 2, "user", "Go?"), (1, 3, "user", "Well?"), (1, 4, "assistant", "Ok.")]
    turns = faulty(spark.createDataFrame(rows, "_conversation long, _turn long, _role string, _text string"))
    out = [(r["edit"], r["role"], r["text"]) for r in repaired_rows(turns).orderBy("_c", "_id", "_step").collect()]
    assert out == [("K", "system", "Hi."), ("K", "user", "Go?"), ("I", "assistant", ""), ("K", "user", "Well?"), ("K", "assistant", "Ok.")]


def test_empty_tables(spark):
    assert by_operator(spark, []) == set()
    empty = ("", hashlib.sha256().hexdigest())
    gone = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert by_operator(spark, [(7, gone, "user", "x.")]) == {(7, 0, 0, 0, 0, 0, 0, *empty)}


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r[c] for c in COLUMNS) for r in repaired_conversations(spark, folder).collect()}
    assert got == plain_report(rows)
