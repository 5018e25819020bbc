"""Repair of a conversation's structure at the least cost, by a run-length dynamic program.

A conversation is sound if its roles' initials, in order, are nothing or `s?(ua)+`: an opening system turn, then pairs of user and
assistant. Every row is first given one symbol: x if it has to go (blank, or role and text seen earlier), else its role's class (s, u, a or o for
any other), in upper case if its text is truncated. Four states (start, after s, after u, after a) and the edits make each symbol
a 4 x 4 matrix of least costs, and a row of symbols their product in min-plus arithmetic:

1. Faults are found with windows over narrow rows (ids, role, a digest of the text, flags); no text is moved for them.
2. Narrow rows are range-partitioned and sorted by conversation and turn, so that a conversation of any length is spread over tasks; each
   task turns its stretch of a conversation into runs of equal symbols, and the stretches of one conversation (one a task at most) are
   put together.
3. Costs go backwards over runs: a run of length n is advanced through cached binary powers of its symbol's matrix. Choices are
   unrolled forwards, a run in pieces of binary lengths that are remembered by (symbol, length, state, differences of costs), into the audit.
4. Texts are sorted by conversation once, behind a row that carries the audit, and streamed: edits are applied row by row, so memory doesn't
   grow with a conversation's texts. A digest over a whole conversation is a chain by nature, so one task reads its texts in order.

The audit has a letter for each edit: D deleted, I inserted (user or assistant, empty text), K kept, R given the other role. Ties
take the audit that is least in ASCII: at each step the least letter among those that begin a cheapest repair. Every letter leads to one
state, so that is the least string.

Defined cases. A null conv_id is a conversation of its own; a null turn comes first; null roles and texts (and null ids and turns, where they are
hashed for damage) count as one space. Rows of equal turn are ordered by role, then by the MD5 of their text; rows that repeat wholly are equal, so
their order changes nothing, and all but the first are duplicates. An empty text is blank; very long texts are streamed. A conversation of which
no row is left has zeros and an empty audit. An empty table gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import BLANKS, gives_back, staged, table

#: Costs of the edits; a truncated row that stays costs TRUNCATED more.
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Where the next user or assistant turn leads, by state: start, after s, after u, after a.
_NEXT = (2, 2, 3, 2)
_KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ROLES = {2: "user", 3: "assistant"}
#: Costs of what is still missing after the last row, by state.
_ENDING = (0, 2 * INSERT, INSERT, 0)
#: Runs up to this length are unrolled from remembered pieces.
MOST_PIECE = 1024
_NEVER = 1 << 60


def _moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the ways to take one row, in order of letters."""
    out = [("D", DELETE, state)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        if (state, symbol.lower()) in _KEEPS:
            out.append(("K", KEEP + extra, _KEEPS[state, symbol.lower()]))
        out.append(("R", RENAME + extra, _NEXT[state]))
    return out


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), _NEVER) for j in range(4)) for i in range(4))


@lru_cache(maxsize=4096)
def power(symbol: str, k: int) -> tuple:
    """Least costs from state to state over 2^k rows of a symbol, insertions before each row included."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    row = [[_NEVER] * 4 for _ in range(4)]
    for state in range(4):
        at, paid = state, 0
        for _ in range(4):
            for _, cost, then in _moves(symbol, at):
                row[state][then] = min(row[state][then], paid + cost)
            at, paid = _NEXT[at], paid + INSERT
    return tuple(map(tuple, row))


def advance(symbol: str, n: int, after: tuple) -> tuple:
    """Least costs by state before n rows of a symbol, from those after them."""
    k = 0
    while n >> k:
        if n >> k & 1:
            m = power(symbol, k)
            after = tuple(min(m[i][j] + after[j] for j in range(4)) for i in range(4))
        k += 1
    return after


def _piece(symbol: str, n: int, state: int, after: tuple) -> tuple[str, int]:
    if n == 1:
        before, out = advance(symbol, 1, after), ""
        while True:
            options = [(letter, then, cost + after[then]) for letter, cost, then in _moves(symbol, state)] + [("I", _NEXT[state], INSERT + before[_NEXT[state]])]
            letter, state, _ = min(o for o in options if o[2] == before[state])
            out += letter
            if letter != "I":
                return out, state
    first = 1 << ((n - 1).bit_length() - 1)
    a, state = unrolled(symbol, first, state, advance(symbol, n - first, after))
    b, state = unrolled(symbol, n - first, state, after)
    return a + b, state


_remembered = lru_cache(maxsize=1 << 13)(_piece)


def unrolled(symbol: str, n: int, state: int, after: tuple) -> tuple[str, int]:
    """(letters, state after them) of the least audit over n rows of a symbol."""
    least = min(after)
    return (_remembered if n <= MOST_PIECE else _piece)(symbol, n, state, tuple(x - least for x in after))


def audit(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """(least cost, least audit) of a row of runs (symbol, length)."""
    costs = [_ENDING]
    for symbol, n in reversed(runs):
        costs.append(advance(symbol, n, costs[-1]))
    total, state, out = costs.pop()[0], 0, []
    for symbol, n in runs:
        letters, state = unrolled(symbol, n, state, costs.pop())
        out.append(letters)
    return total, "".join(out) + "I" * (_ENDING[state] // INSERT)


def damaged(rows: DataFrame) -> DataFrame:
    """rows (conv, turn, role, text, none of role and text null) with the damage of the contract; dropped rows stay, marked by gone."""
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), times.alias("again")).drop("again")


def plain(rows: DataFrame) -> DataFrame:
    """rows (conv, turn, role, text) as they are."""
    return rows.withColumn("gone", F.lit(False))


#: Ascending, nulls first, as Spark sorts by default.
_ORDER = ["conv", "turn", "role", "digest"]

_STRETCH = "conv long, block int, rows long, gone long, turns long, opens long, closes long, blank long, duplicate long, truncated long, illegal long, first string, last string, symbols string, lengths array<int>"
_STRETCH_ARROW = pa.schema(
    [("conv", pa.int64()), ("block", pa.int32())]
    + [(c, pa.int64()) for c in ("rows", "gone", "turns", "opens", "closes", "blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("symbols", pa.string()), ("lengths", pa.list_(pa.int32()))]
)
_SOUND = {"su", "ua", "au"}


class _Stretch:
    """What one task sees of a conversation, in order. turns: distinct ones; opens and closes: the first and the last turn that isn't null."""

    def __init__(self, conv, block):
        self.conv, self.block, self.rows, self.gone, self.turns, self.blank, self.duplicate, self.truncated, self.illegal = conv, block, 0, 0, 0, 0, 0, 0, 0
        self.opens = self.closes = self.first = self.last = None
        self.symbols, self.lengths = [], []

    def add(self, turn, initial, code):
        if code == "-":
            self.gone += 1
            return
        self.rows += 1
        if turn is not None and turn != self.closes:
            self.turns, self.closes = self.turns + 1, turn
            self.opens = turn if self.opens is None else self.opens
        if self.rows > 1:
            self.illegal += self.last + initial not in _SOUND
        else:
            self.first = initial
        self.last = initial
        self.blank += code == "b"
        self.duplicate += code == "d"
        self.truncated += code.isupper()
        symbol = "x" if code in "bd" else code
        if self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += 1
        else:
            self.symbols.append(symbol)
            self.lengths.append(1)

    def row(self):
        return (self.conv, self.block, self.rows, self.gone, self.turns, self.opens, self.closes, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, "".join(self.symbols), self.lengths)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


@gives_back
def _stretches(batches):
    from pyspark import TaskContext

    block, now, out = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for conv, turn, initial, code in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if now is None or now.conv != conv:
                if now:
                    out.append(now.row())
                now = _Stretch(conv, block)
            now.add(turn, initial, code)
        if len(out) >= 1000:
            yield _batch(out, _STRETCH_ARROW)
            out = []
    if now:
        out.append(now.row())
    yield _batch(out, _STRETCH_ARROW)


_REPORT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPORT_ARROW = pa.schema([("conv", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])


def _report(conv, parts: list[dict]) -> tuple:
    parts = [p for p in parts if p["rows"]]
    dated = [p for p in parts if p["opens"] is not None]
    turns = sum(p["turns"] for p in dated) - sum(a["closes"] == b["opens"] for a, b in zip(dated, dated[1:]))
    gaps = dated[-1]["closes"] - dated[0]["opens"] + 1 - turns if dated else 0
    total = lambda name: sum(p[name] for p in parts)
    illegal = total("illegal") + sum(a["last"] + b["first"] not in _SOUND for a, b in zip(parts, parts[1:]))
    runs: list[tuple[str, int]] = []
    for p in parts:
        for symbol, n in zip(p["symbols"], p["lengths"]):
            if runs and runs[-1][0] == symbol:
                runs[-1] = (symbol, runs[-1][1] + n)
            else:
                runs.append((symbol, n))
    cost, letters = audit(runs)
    return conv, gaps, total("blank"), total("duplicate"), total("truncated"), illegal, cost, letters


@gives_back
def _reports(batches):
    for batch in batches:
        rows = [_report(conv, parts) for conv, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield _batch(rows, _REPORT_ARROW)


def faults(rows: DataFrame) -> DataFrame:
    """Narrow rows (conv, turn, role, digest, initial, code) of rows after damage; code: - gone, b blank, d duplicate, else the role's class, in
    upper case if truncated."""
    body = F.rtrim("text", F.lit(BLANKS))
    cls = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    held = rows.select(
        "conv", "turn", "role", "gone", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("gone"), "-").when(body == "", "b").when(F.right(body, F.lit(1)).isin(".", "!", "?"), cls).otherwise(F.upper(cls)).alias("code"),
    )
    # The first of equal rows stays: null turns come first, then the least turn; of equal rows in one turn, the first by number.
    same = Window.partitionBy("conv", "role", "digest", "gone")
    counted = held.withColumn("nth", F.row_number().over(same.orderBy(F.asc_nulls_first("turn"))))
    return counted.select("conv", "turn", "role", "digest", "initial", F.when((F.col("nth") > 1) & F.col("code").isin(*"suaoSUAO"), "d").otherwise(F.col("code")).alias("code"))


def reports(rows: DataFrame) -> DataFrame:
    """One row for each conversation of rows after damage: gaps, faults, least cost and audit."""
    narrow = faults(rows)
    dealt = narrow.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select("conv", "turn", "initial", "code")
    parts = dealt.mapInArrow(_stretches, _STRETCH).withColumn("part", F.struct("block", "rows", "opens", "closes", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last", "symbols", "lengths"))
    whole = parts.groupBy("conv").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.mapInArrow(_reports, _REPORT)


_DIGESTS_ARROW = pa.schema([*_REPORT_ARROW, ("sha256", pa.string())])
_ROWS = "conv long, at long, role string, text string, edit string"
_ROWS_ARROW = pa.schema([("conv", pa.int64()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


class _Editing:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, report: dict):
        self.report, self.letters, self.at, self.state = report, report["audit"], 0, 0

    def inserted(self):
        while self.letters[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, _NEXT[self.state]
            yield _ROLES[self.state], "", "I"

    def row(self, role: str, text: str):
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = _KEEPS[self.state, role[:1]]
            yield role, text, "K"
        elif letter == "R":
            self.state = _NEXT[self.state]
            yield _ROLES[self.state], text, "R"


def _edited(batches, take, finish, schema: pa.Schema, most: int):
    """take(editing, rows) and finish(editing) give output rows for each conversation's repaired rows, as they stream by."""
    now, out, size = None, [], 0
    for batch in batches:
        kinds, roles, texts, reports_ = batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)
        for i, header in enumerate(kinds):
            if header:
                if now:
                    out += [*take(now, now.inserted()), *finish(now)]
                now = _Editing(reports_[i].as_py())
            else:
                made = list(take(now, now.row(roles[i].as_py(), texts[i].as_py())))
                out += made
                size += sum(len(r[3] or "") for r in made) if schema is _ROWS_ARROW else 0
            if len(out) >= 1000 or size > most:
                yield _batch(out, schema)
                out, size = [], 0
    if now:
        out += [*take(now, now.inserted()), *finish(now)]
    yield _batch(out, schema)


def _digest_rows(now: _Editing, rows):
    for role, text, _ in rows:
        if not hasattr(now, "sha"):
            now.sha = hashlib.sha256()
        else:
            now.sha.update(b"\n")
        now.sha.update(f"{role}:".encode())
        now.sha.update(text.encode())
    return ()


def _digest_end(now: _Editing):
    yield (*now.report.values(), (now.sha if hasattr(now, "sha") else hashlib.sha256()).hexdigest())


def _rows_taken(now: _Editing, rows):
    for role, text, edit in rows:
        now.count = getattr(now, "count", -1) + 1
        yield now.report["conv"], now.count, role, text, edit


@gives_back
def _digests(batches):
    yield from _edited(batches, _digest_rows, _digest_end, _DIGESTS_ARROW, 1 << 24)


@gives_back
def _repaired(batches):
    yield from _edited(batches, _rows_taken, lambda now: (), _ROWS_ARROW, 1 << 24)


def _behind_audits(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Rows after damage, sorted by conversation, each conversation's behind its report."""
    body = rows.filter("not gone").select("conv", F.lit(False).alias("header"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    heads = told.select("conv", F.lit(True).alias("header"), F.struct(*[f.name for f in _REPORT_ARROW]).alias("report"))
    both = heads.unionByName(body, allowMissingColumns=True).repartition("conv")
    return both.sortWithinPartitions("conv", F.desc("header"), *_ORDER[1:]).select("header", "role", "text", "report")


def _given(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return conversations.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage=plain) -> tuple[DataFrame, DataFrame]:
    """(reports, rows) of conversations: one report for each, and the repaired rows (conv, at, role, text, edit), at counting from 0.

    damage, a function of (conv, turn, role, text) rows, marks rows that are gone; the default takes the rows as they are.
    """
    rows = damage(_given(conversations, conv, turn, role, text))
    told = staged(reports(rows), "conversation-reports")
    return told, _behind_audits(rows, told).mapInArrow(_repaired, _ROWS)


def digests(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage=plain) -> DataFrame:
    """Reports with the SHA-256 of the repaired `role:text` lines."""
    rows = damage(_given(conversations, conv, turn, role, text))
    told = staged(reports(rows), "conversation-reports")
    return _behind_audits(rows, told).mapInArrow(_digests, _REPORT + ", sha256 string")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    out = digests(table(spark, sf_dir, "conversations"), damage=damaged)
    return out.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256"))
