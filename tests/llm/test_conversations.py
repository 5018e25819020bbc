"""Conversation repair against a plain search over all repairs."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from marketloom.llm import conversations as c


def brute_audit(symbols):
    """Least (cost, audit) by plain recursion over rows and states; at most two insertions in a row can pay."""
    roles = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        out = []
        if inserted < 3:
            out += [(3 + cost, "I" + rest) for r in roles[state] if r in "ua" for cost, rest in [best(i, r, inserted + 1)]]
        if i == len(symbols):
            out += [(0, "")] if state in ("", "a") else []
            return min(out, default=(10**9, ""))
        x = symbols[i]
        cost, rest = best(i + 1, state, 0)
        out.append((4 + cost, "D" + rest))
        if x != "x":
            for r in roles[state]:
                if r == x.lower():
                    cost, rest = best(i + 1, r, 0)
                    out.append((3 * x.isupper() + cost, "K" + rest))
                if r in "ua":
                    cost, rest = best(i + 1, r, 0)
                    out.append((3 + 3 * x.isupper() + cost, "R" + rest))
        return min(out)

    for i in range(len(symbols), 0, -1):  # from the end, so that the recursion stays shallow
        for state in roles:
            best(i, state, 0)
    return best(0, "", 0)


def runs_of(symbols):
    return [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", symbols)]


def test_audit_by_all_repairs():
    rng = random.Random(3)
    for _ in range(1_500):
        symbols = "".join(rng.choice("xsuaoSUAO"[: rng.choice([4, 9])]) * rng.choice([1, 1, 2, 5]) for _ in range(rng.randrange(0, 7)))
        assert c.audit(runs_of(symbols)) == brute_audit(symbols), symbols


def test_long_runs():
    for symbols in ("u" * 700 + "a" * 300, "s" * 257 + "U" * 129 + "x" * 65 + "a" * 33, "o" * 400):
        assert c.audit(runs_of(symbols)) == brute_audit(symbols)
    cost, letters = c.audit([("u", 1_000_001), ("a", 1_000_000)])
    assert len([x for x in letters if x != "I"]) == 2_000_001 and cost <= 2_000_001 * 4


def brute(rows):
    """The contract, row by row. rows: (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            sp = lambda v: " " if v is None else str(v)
            kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
            role, text = sp(role), sp(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        turns = {r[0] for r in held if r[0] is not None}
        seen, symbols, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in held:
            body = text.strip(" \t\n\x0b\x0c\r")
            cls = role[:1] if role[:1] in "sua" and role else "o"
            if not body:
                symbols, _ = symbols + "x", counts.__setitem__("b", counts["b"] + 1)
            elif (role, text) in seen:
                symbols, _ = symbols + "x", counts.__setitem__("d", counts["d"] + 1)
            elif body[-1] not in ".!?":
                symbols, _ = symbols + cls.upper(), counts.__setitem__("t", counts["t"] + 1)
            else:
                symbols += cls
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit = brute_audit(symbols)
        lines, at, state = [], 0, ""
        for letter in audit:
            if letter == "I":
                state = "a" if state == "u" else "u"
                lines.append(("user" if state == "u" else "assistant", ""))
                continue
            _, role, text = held[at]
            at += 1
            if letter == "K":
                state = role[:1]
                lines.append((role, text))
            elif letter == "R":
                state = "a" if state == "u" else "u"
                lines.append(("user" if state == "u" else "assistant", text))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, sha, lines)
    return out


def compared(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv int, gone string") if len(rows[0]) == 6 else spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute([r[:4] for r in rows])
    got = {r[0]: tuple(r[1:]) for r in c.digests(df, damage=c.damaged).collect()}
    assert got == {k: v[:8] for k, v in want.items()}
    _, fixed = c.repair(df, damage=c.damaged)
    texts = {}
    for r in sorted(fixed.collect(), key=lambda r: r["at"]):
        texts.setdefault(r.conv, []).append((r.role, r.text))
    assert texts == {k: v[8] for k, v in want.items() if v[8]}


def test_odd_rows(spark):
    rng = random.Random(8)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "ugly"], ["Yes.", "No", " ", "", None, "So?\n", "Ünd so. ", "Ja!!"]
    rows = [(rng.choice([None, 1, 2, 3, -4, 5]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts), 7, "x") for _ in range(160)]
    compared(spark, rows + rows[:9])


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Text {t}.", f"Cut {t}"])) for t in range(600) if t % 50]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compared(spark, rows + [(8, 0, "user", "x" * 3_000_000 + ".")])
        blocks = c.faults(c.damaged(c._given(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")))
        parts = blocks.repartitionByRange(*c._ORDER).sortWithinPartitions(*c._ORDER).select("conv", "turn", "initial", "code").mapInArrow(c._stretches, c._STRETCH)
        assert parts.filter("rows > 0").count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_given_table_and_empty(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in c.op11_conversation_repair(spark, sf).collect()}
    assert got == {k: v[:8] for k, v in brute(rows).items()}
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.digests(empty).count() == 0


@pytest.mark.parametrize("letters", ["", "DD", "KK"])
def test_costs_by_letter(letters):
    symbols = {"": "", "DD": "xx", "KK": "ua"}[letters]
    assert c.audit(runs_of(symbols)) == ({"": 0, "DD": 8, "KK": 0}[letters], letters)
