"""Conversation repair against a recursive brute force, on awkward, random and long conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from strata.llm import catalog, common, repair

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_audit(kinds):
    """Least cost and ASCII-least audit; ``kinds``: (initial, must go, cut short) of each row."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def rest(i, last, inserted):
        options = [(0, "")] if i == len(kinds) and last in ("", "a") else []
        if inserted < 2:
            for to in follows[last].replace("s", ""):
                cost, audit = rest(i, to, inserted + 1)
                options.append((cost + 3, "I" + audit))
        if i < len(kinds):
            initial, gone, cut = kinds[i]
            cost, audit = rest(i + 1, last, 0)
            options.append((cost + 4, "D" + audit))
            if not gone:
                for to in follows[last]:
                    cost, audit = rest(i + 1, to, 0)
                    if to == initial:
                        options.append((cost + 3 * cut, "K" + audit))
                    if to != "s":
                        options.append((cost + 3 + 3 * cut, "R" + audit))
        return min(options, default=(10**9, ""))

    return rest(0, "", 0)


def brute(rows):
    """Of one conversation's rows (turn, role, text), all present: the row that ``repair`` gives, without conv_id."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = {t for t, _, _ in rows if t is not None}
    seen, count, kinds = set(), defaultdict(int), []
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen else "truncated" if last not in (".", "!", "?") else ""
        seen.add((role, text))
        count[fault] += 1
        kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
    cost, audit = brute_audit(tuple(kinds))
    out, left = [], list(rows)
    for edit in audit:
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((wanted, ""))
            continue
        _, role, text = left.pop(0)
        if edit != "D":
            out.append((role if edit == "K" else wanted, text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def frame(spark, rows, columns="conv_id long, turn long, role string, text string"):
    return spark.createDataFrame(rows, columns)


def by_conversation(rows):
    out = defaultdict(list)
    for c, *rest in rows:
        out[c].append(tuple(rest))
    return out


def random_rows(conversations, longest, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Hi.", "Yes!", "no", "", "  \n", None, "Why?\n ", "end. x"]
    return [(c, rng.choice([t, t, t, None, t // 2]), rng.choice(roles), rng.choice(texts + [f"Turn {t}."] * 8)) for c in range(conversations) for t in range(rng.randrange(1, longest))]


def check(spark, rows, **more):
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(frame(spark, rows), **more).collect()}
    want = {c: brute(x) for c, x in by_conversation(rows).items()}
    assert got == want


def test_random_conversations(spark):
    check(spark, random_rows(300, 14, 7))


def test_every_short_pattern(spark):
    kinds = [("s", "S."), ("user", "U."), ("assistant", "A."), ("user", "u"), ("assistant", "")]
    rows = []
    for c, pattern in enumerate(itertools.chain.from_iterable(itertools.product(kinds, repeat=n) for n in (1, 2, 3, 4))):
        rows += [(c, t, role, text and f"{t}{text}") for t, (role, text) in enumerate(pattern)]
    check(spark, rows)


def test_parts_of_long_conversations_are_read_back(spark):
    rows = random_rows(12, 90, 3)
    check(spark, rows, part=7)
    check(spark, rows, part=1)


def test_one_conversation_over_many_batches(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "tool"]), f"{t}" + rng.choice([".", ".", ""])) for t in range(12_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = repair.repair(frame(spark, rows), part=2500).first()
        again = repair.repair(frame(spark, rows)).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == again and len(got.audit.replace("I", "")) == 12_000
    assert got.cost == 4 * got.audit.count("D") + 3 * (got.audit.count("R") + got.audit.count("I")) + 3 * sum(e != "D" and not r[3].endswith(".") for e, r in zip(got.audit.replace("I", ""), rows))


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "a."), (None, 2, "assistant", "b."), (1, None, None, None), (2, 5, "user", "x" * 3_000_000 + "."), (2, 5, "user", "x" * 3_000_000 + "."),
        (3, -(2**63), "user", "."), (3, 2**63 - 1, "assistant", "!"), (4, 3, "system", "alone."), (5, 1, "ünknown", "日本。"),
    ]
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(frame(spark, rows)).collect()}
    want = {c: brute(x) for c, x in by_conversation(rows).items()}
    want[3] = (2**63 - 1, *want[3][1:])
    assert got == want


def test_extra_columns_absent_rows_and_empty_table(spark):
    rows = frame(spark, [(1, 1, "user", "Hi.", "x", True), (1, 2, "assistant", "Yo.", "y", None), (2, 1, "user", "Hi.", "z", False)], "conv_id long, turn long, role string, text string, TEXT string, present boolean")
    got = {r.conv_id: r for r in repair.repair(rows).collect()}
    assert (got[1].audit, got[1].cost) == ("KI", 3)
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair(rows.where("1 = 0")).count() == 0


def damaged(rows):
    out = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out[c] += [(t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


@pytest.mark.parametrize("rows", [None, random_rows(60, 20, 11)])
def test_damage_and_query(spark, rows, tmp_path):
    if rows is None:
        path = SF
    else:
        path = str(tmp_path)
        frame(spark, rows).write.parquet(f"{path}/conversations.parquet")
    given = [tuple(r) for r in common.table(path, "conversations", spark).select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in catalog.QUERIES["op12_repair"](spark, path).collect()}
    assert got == {c: brute(x) for c, x in damaged(given).items()}


def test_machine_stays_small():
    """Relative costs are bounded, so long conversations meet few states."""
    machine, rng = repair.Machine(), random.Random(9)
    states = machine.start
    for _ in range(200_000):
        states = machine.step(states, rng.randrange(4), rng.randrange(4)).after
    assert len(machine.steps) < 3000
