"""Secrets in texts: rules, and a character convolutional network over every candidate and its surroundings.

Rules find assignments, access keys and long hexadecimal runs. A candidate is every run of `[A-Za-z0-9+/_.=-]` with a digit and at least
LEAST characters. The network reads windows of a candidate (WIDTH characters, overlapping, so that long candidates are read whole) with CONTEXT
characters on either side: characters are embedded, convolved, and pooled by their greatest value over what stands before, in and
after the candidate; two dense layers give a logit. A candidate's score is that of its highest window. Only numpy is used.

The network learns from labelled findings: candidates with a label, given by the caller or, by default, taken from the corpus (a candidate in a
rule's span is a secret; any other is not). Equal windows count once, and all of them are used: four fifths are learnt from, the others calibrate it; a hash of the window
tells which. Learning and calibration also see secrets in the surroundings of
other candidates, and with random characters of another alphabet as their value, so that neither the key word nor one alphabet is needed. The calibration set fits a scale and an offset of the logit
(so a score is a probability) and, for each shape of candidate (digits, hexadecimal, others), the highest threshold at which at
least RECALL of its secrets are found; a shape with fewer than ENOUGH secrets takes the threshold of all. Candidates at or over it, outside the
rules' spans, are findings of kind `net`. Without both labels in the corpus there is no network, and only rules find.

Windows are laid out in blocks of about PART of each label; the rarer label's are dealt again until every block has both. Tasks learn some epochs in their blocks, each from the same weights, and Spark sums the
weights for the mean that the next of _EPOCHS rounds starts from; a single block learns all epochs at once. The sums and thresholds of the calibration are aggregates over all its windows. The driver holds weights, never windows.

Defined cases. A null text is empty and has no finding. Very long texts are scanned whole, their windows in blocks. Repeated rows get
equal results, a null id its own row; ids are never looked at. Ties cannot occur: spans of one kind don't overlap. An empty table gives an empty
result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import gives_back, staged, table, text_or_empty

LEAST, WIDTH, CONTEXT, STRIDE = 8, 64, 24, 48
PART, RECALL, ENOUGH = 2048, 0.98, 40
KINDS = ("assign", "access", "hex", "net")
_LENGTH = WIDTH + 2 * CONTEXT
_TAPS, _DIMS, _FILTERS, _HIDDEN = 5, 8, 24, 16
_EPOCHS, _STEPS, _BATCH, _RATE = 8, 600, 64, 4e-3

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z+/_.=-]*+[0-9][A-Za-z0-9+/_.=-]*+")
_DIGITS, _HEXADECIMAL = re.compile(r"[0-9.+/_=-]+"), re.compile(r"[0-9A-Fa-f]+")


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the rules' findings, sorted."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return sorted(out + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)])


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CANDIDATE.finditer(text) if m.end() - m.start() >= LEAST]


def shape(value: str) -> int:
    """0 digits and marks, 1 hexadecimal, 2 others."""
    return 0 if _DIGITS.fullmatch(value) else 1 if _HEXADECIMAL.fullmatch(value) else 2


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """The windows of a candidate."""
    if end - start <= WIDTH:
        return [(start, end)]
    return [(at, min(at + WIDTH, end)) for at in range(start, end - WIDTH + STRIDE, STRIDE)]


def shapes_of(windows: np.ndarray) -> np.ndarray:
    """shape() of the pieces in windows."""
    own = windows[:, CONTEXT : CONTEXT + WIDTH]
    of = lambda marks: np.isin(own, [0, *_CODES[[ord(c) for c in marks]]]).all(1)
    return np.where(of("0123456789.+/_=-"), 0, np.where(of("0123456789abcdefABCDEF"), 1, 2))


#: 0 nothing, 1 to 95 printable ASCII, 96 other ASCII, 97 all else.
_CODES = np.array([c - 31 if 32 <= c < 127 else 96 for c in range(128)] + [97], dtype=np.uint8)
_SYMBOLS = 98


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _CODES[np.minimum(points, 128)]


def window(text: str, start: int, end: int) -> bytes:
    """A piece and its surroundings as _LENGTH codes: what stands before ends at CONTEXT, what follows starts at CONTEXT + WIDTH."""
    out = np.zeros(_LENGTH, dtype=np.uint8)
    before, own, after = codes(text[max(0, start - CONTEXT) : start]), codes(text[start:end]), codes(text[end : end + CONTEXT])
    out[CONTEXT - len(before) : CONTEXT] = before
    out[CONTEXT : CONTEXT + len(own)] = own
    out[CONTEXT + WIDTH : CONTEXT + WIDTH + len(after)] = after
    return out.tobytes()


class Network:
    """Embedding, one convolution, three pools, two dense layers."""

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.normal(0, 1, shape) * (2 / shape[0]) ** 0.5).astype(np.float32)
        fan = _TAPS * (_DIMS + 1)
        self.p = {"e": rng.normal(0, 0.5, (_SYMBOLS, _DIMS)).astype(np.float32), "w": normal(fan, _FILTERS), "b": np.zeros(_FILTERS, np.float32), "u": normal(3 * _FILTERS, _HIDDEN), "c": np.zeros(_HIDDEN, np.float32), "v": normal(_HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}
        self.p["e"][0] = 0
        self.scale, self.offset, self.thresholds = 1.0, 0.0, [2.0, 2.0, 2.0]

    _POOLS = ((0, CONTEXT - _TAPS + 1), (CONTEXT - _TAPS + 1, CONTEXT + WIDTH), (CONTEXT + WIDTH, _LENGTH - _TAPS + 1))

    def _columns(self, x: np.ndarray) -> np.ndarray:
        inside = np.zeros((*x.shape, 1), np.float32)
        inside[:, CONTEXT : CONTEXT + WIDTH] = (x[:, CONTEXT : CONTEXT + WIDTH, None] > 0)
        z = np.concatenate([self.p["e"][x], inside], axis=2)
        return np.lib.stride_tricks.sliding_window_view(z, _TAPS, axis=1).reshape(len(x), _LENGTH - _TAPS + 1, -1)

    def _forward(self, x: np.ndarray):
        cols = self._columns(x)
        h = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        at = np.stack([h[:, a:b].argmax(1) + a for a, b in self._POOLS], axis=1)  # window, pool, filter
        pooled = np.take_along_axis(h, at, axis=1).reshape(len(x), -1)
        hidden = np.maximum(pooled @ self.p["u"] + self.p["c"], 0)
        return cols, at, pooled, hidden, hidden @ self.p["v"] + self.p["d"]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.float32), *[self._forward(x[i : i + 256])[4] for i in range(0, len(x), 256)]])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x).astype(np.float64) + self.offset, -500, 500)))

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        cols, at, pooled, hidden, logit = self._forward(x)
        g = ((1 / (1 + np.exp(-logit))) - y).astype(np.float32) / len(x)
        out = {"v": hidden.T @ g, "d": g.sum(keepdims=True)}
        gh = np.outer(g, self.p["v"]) * (hidden > 0)
        out |= {"u": pooled.T @ gh, "c": gh.sum(0)}
        gp = ((gh @ self.p["u"].T) * (pooled > 0)).reshape(len(x), 3, _FILTERS)
        rows = np.arange(len(x))[:, None, None]
        out["w"] = np.einsum("npfc,npf->cf", cols[rows, at], gp, optimize=True)
        out["b"] = gp.sum((0, 1))
        back = (gp[..., None] * self.p["w"].T[None, None]).reshape(len(x), 3, _FILTERS, _DIMS + 1, _TAPS)
        e = np.zeros_like(self.p["e"])
        for t in range(_TAPS):
            np.add.at(e, x[rows, at + t].ravel(), back[..., :_DIMS, t].reshape(-1, _DIMS))
        e[0] = 0
        out["e"] = e
        return out

    def learn(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int = 17) -> None:
        """Adam over shuffled batches; both labels weigh alike."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        ones, zeros = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        n = max(len(ones), len(zeros))
        for _ in range(epochs):
            order = np.concatenate([rng.permutation(np.resize(rng.permutation(k), n))[:, None] for k in (ones, zeros)], axis=1).ravel()
            for i in range(0, len(order), _BATCH):
                own = order[i : i + _BATCH]
                xs = x[own].copy()
                _varied(xs, y[own], rng)
                step += 1
                for k, g in self._gradients(xs, y[own].astype(np.float32)).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - _RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def weights(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def take(self, flat: np.ndarray) -> None:
        at = np.cumsum([v.size for v in self.p.values()])
        self.p = {k: w.reshape(v.shape).astype(np.float32) for (k, v), w in zip(self.p.items(), np.split(flat, at[:-1]))}


def _varied(x: np.ndarray, y: np.ndarray, rng) -> None:
    """Secrets of a batch, in place: half get the surroundings of one that isn't a secret, half get random characters of one alphabet as their value."""
    sets = [_CODES[np.frombuffer(a.encode(), np.uint8)] for a in ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")]
    others = np.flatnonzero(y == 0)
    for i in np.flatnonzero(y == 1):
        if len(others) and rng.integers(0, 2):
            j = others[rng.integers(0, len(others))]
            x[i, :CONTEXT], x[i, CONTEXT + WIDTH :] = x[j, :CONTEXT], x[j, CONTEXT + WIDTH :]
        if rng.integers(0, 2):
            own = slice(CONTEXT, CONTEXT + int((x[i, CONTEXT : CONTEXT + WIDTH] > 0).sum()))
            x[i, own] = rng.choice(sets[rng.integers(0, len(sets))], own.stop - own.start)


_LABELLED = pa.schema([("label", pa.int32()), ("win", pa.binary())])


@gives_back
def _labelled(batches):
    for batch in batches:
        seen: set[tuple] = set()
        for value in batch.column(0):
            text = value.as_py()
            spans, k = rule_spans(text), 0
            ends = np.maximum.accumulate([e for _, _, e in spans]) if spans else []
            for start, end in candidates(text):
                while k < len(spans) and ends[k] <= start:
                    k += 1
                label = int(k < len(spans) and spans[k][0] < end)
                seen.update((label, window(text, *p)) for p in pieces(start, end))
                if len(seen) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*sorted(seen)), _LABELLED)], schema=_LABELLED)
                    seen = set()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*sorted(seen)), _LABELLED)], schema=_LABELLED)


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, win): the windows of all candidates, labelled by the rules."""
    return docs.select(text_or_empty(text).alias("text")).mapInArrow(_labelled, "label int, win binary")


#: Weights are summed as integers of this fraction, so that their mean doesn't depend on the order of tasks.
_FRACTION = 2.0**32
_LEARNT = pa.schema([("weights", pa.list_(pa.int64()))])
_JUDGED = pa.schema([("label", pa.int32()), ("shape", pa.int32()), ("logit", pa.float32())])


def blocks(windows: DataFrame, counts: list[int], part: int = PART) -> tuple[DataFrame, int]:
    """(block, win, label, h, own) of windows (win, label, h), and the number of blocks; counts are those of labels 0 and 1.

    A block has about part windows of either label, so the task that holds it is bounded. Each window is own in one block; those of the label with fewer parts are also dealt to others.
    """
    parts = [-(-n // part) for n in counts]
    n = max(parts)
    step = F.when(F.col("label") == 1, parts[1]).otherwise(parts[0])
    laid = windows.withColumn("__first", F.pmod(F.xxhash64(F.lit(13), "win"), step)).withColumn("block", F.explode(F.sequence("__first", F.lit(n - 1).cast("long"), step.cast("long"))))
    return laid.select("block", "win", "label", "h", (F.col("block") == F.col("__first")).alias("own")), n


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels and own of a block, in an order that doesn't depend on tasks: label, hash, window."""
    table = table.sort_by([("label", "ascending"), ("h", "ascending"), ("win", "ascending")])
    x = np.frombuffer(b"".join(table.column("win").to_pylist()), np.uint8).reshape(-1, _LENGTH)
    return x, table.column("label").to_numpy(), table.column("own").to_numpy()


def _learnt(key, table, net, epochs, seed):
    x, y, _ = _arrays(table)
    if len(set(y.tolist())) < 2:
        return _LEARNT.empty_table()
    own = Network()
    own.take(net.value)
    own.learn(x, y, epochs, seed + key[0].as_py())
    return pa.table([pa.array([np.rint(own.weights() * _FRACTION).astype(np.int64)], _LEARNT.field(0).type)], schema=_LEARNT)


def _judged(key, table, net):
    x, y, own = _arrays(table)
    other = x.copy()
    _varied(other, y, np.random.default_rng(19 + key[0].as_py()))
    x, y = np.concatenate([x[own], other[own & (y == 1)]]), np.concatenate([y[own], y[own & (y == 1)]])
    return pa.table([pa.array(c, f.type) for c, f in zip((y, shapes_of(x), net.value.logits(x)), _JUDGED)], schema=_JUDGED)


def learnt(windows: DataFrame, counts: list[int], part: int = PART) -> Network:
    """A network from all windows: rounds in every block, with the mean weights between them."""
    laid, n = blocks(windows, counts, part)
    net, sc = Network(), windows.sparkSession.sparkContext
    epochs = max(_EPOCHS, -(-_STEPS * _BATCH * n // (2 * max(counts))))  # at least _STEPS steps in a block
    rounds = 1 if n == 1 else _EPOCHS
    laid = staged(laid, "secret-blocks") if rounds > 1 else laid
    for i in range(rounds):
        sent = sc.broadcast(net.weights())
        made = laid.groupBy("block").applyInArrow(partial(_learnt, net=sent, epochs=-(-epochs // rounds), seed=17 + n * i), "weights array<bigint>")
        # One row a weight, however many blocks.
        sums = made.select(F.posexplode("weights").alias("at", "w")).groupBy("at").agg(F.sum(F.col("w").cast("decimal(38,0)")).alias("w"), F.count("*").alias("n")).orderBy("at").collect()
        net.take(np.array([int(r.w) / r.n / _FRACTION for r in sums]))
        sent.destroy()
    return net


def calibrate(net: Network, windows: DataFrame, counts: list[int], part: int = PART) -> None:
    """Scale and offset by Newton steps with a prior of one finding of either label, then thresholds by shape, from all windows; secrets count varied, too."""
    laid, _ = blocks(windows, counts, part)
    sent = windows.sparkSession.sparkContext.broadcast(net)
    judged = staged(laid.groupBy("block").applyInArrow(partial(_judged, net=sent), "label int, shape int, logit float"), "secret-logits")
    x = F.col("logit").cast("double")
    one = judged.agg(F.avg(x).alias("middle"), F.stddev_pop(x).alias("spread"), F.sum("label").alias("ones"), F.count("*").alias("n")).first()
    middle, spread = one.middle, max(one.spread, 1e-6)
    z = (x - middle) / spread
    soft = F.when(F.col("label") == 1, (one.ones + 1) / (one.ones + 2)).otherwise(1 / (one.n - one.ones + 2))
    at, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    rows = judged.select(z.alias("z"), soft.alias("soft"))
    for _ in range(200):
        p = 1 / (1 + F.exp(-(float(at[0]) * F.col("z") + float(at[1]))))
        r, w = p - F.col("soft"), p * (1 - p)
        s = rows.agg(F.sum(w * F.col("z") * F.col("z")), F.sum(w * F.col("z")), F.sum(w), F.sum(r * F.col("z")), F.sum(r)).first()
        hessian = np.array([[s[0], s[1]], [s[1], s[2]]]) + 0.01 * np.eye(2)
        # Short steps: far from the optimum the curvature says little.
        d = np.clip(np.linalg.solve(hessian, [s[3], s[4]] + 0.01 * (at - prior)), -0.5, 0.5)
        at = at - d
        if abs(d).max() < 1e-8:
            break
    net.scale, net.offset = (float(at[0] / spread), float(at[1] - at[0] * middle / spread)) if at[0] > 0 else (1.0, 0.0)
    secrets = judged.filter("label = 1")
    found = {r["shape"]: r["n"] for r in secrets.groupBy("shape").agg(F.count("*").alias("n")).collect()}
    score = lambda logit: float(1 / (1 + np.exp(-np.clip(net.scale * logit + net.offset, -500, 500))))
    # At least a half: whatever recall would allow, a finding is likelier a secret than not.
    floor = lambda own, n: max(0.5, score(smallest(own, "logit", int((1 - RECALL) * n))))
    whole = floor(secrets, sum(found.values()))
    net.thresholds = [floor(secrets.filter(F.col("shape") == k), found[k]) if found.get(k, 0) >= ENOUGH else whole for k in range(3)]


def smallest(rows: DataFrame, column: str, place: int, slots: int = 4096) -> float:
    """The value at a place (from 0) of a column of floats in order, exactly: slots between its bounds are counted, and that which holds the place is looked at again until it has one value."""
    x = F.col(column).cast("double")
    while True:
        low, high = rows.agg(F.min(x), F.max(x)).first()
        if low == high:
            return low
        slot = F.least(F.lit(slots - 1), F.floor((x - low) / ((high - low) / slots)))
        for r in rows.groupBy(slot.alias("slot")).count().orderBy("slot").collect():
            if place < r["count"]:
                break
            place -= r["count"]
        rows = rows.filter(slot == r.slot)


def trained(labelled: DataFrame, part: int = PART) -> Network | None:
    """A network from all labelled windows: four fifths to learn, the others to calibrate. None without both labels in either."""
    # Equal windows meet by hash; a window with both labels counts as a secret.
    one = labelled.groupBy("win").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("win"))
    one = staged(one, "secret-findings")
    fit = F.pmod("h", F.lit(5)) > 0
    found = {(r.fit, r.label): r.n for r in one.groupBy(fit.alias("fit"), "label").agg(F.count("*").alias("n")).collect()}
    if len(found) < 4:
        return None
    net = learnt(one.filter(fit), [found[True, 0], found[True, 1]], part)
    calibrate(net, one.filter(~fit), [found[False, 0], found[False, 1]], part)
    return net


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def net_spans(text: str, spans: list, net: Network) -> list[tuple[int, int, int, float]]:
    """(start, 3, end, score) of the candidates outside the rules' spans that the network finds."""
    out, k = [], 0
    ends = np.maximum.accumulate([e for _, _, e in spans]) if spans else []
    waiting: list[tuple[int, int]] = []

    def judged():
        parts = [pieces(*c) for c in waiting]
        for lot in range(0, len(parts), 512):
            own = parts[lot : lot + 512]
            flat = [p for ps in own for p in ps]
            s = np.concatenate([net.scores(np.frombuffer(b"".join(window(text, *p) for p in flat[i : i + 512]), np.uint8).reshape(-1, _LENGTH)) for i in range(0, len(flat), 512)])
            best = np.maximum.reduceat(s, np.cumsum([0, *map(len, own)])[:-1])
            out.extend((a, 3, b, float(x)) for (a, b), x in zip(waiting[lot : lot + 512], best) if x >= net.thresholds[shape(text[a:b])])

    for start, end in candidates(text):
        while k < len(spans) and ends[k] <= start:
            k += 1
        if not (k < len(spans) and spans[k][0] < end):
            waiting.append((start, end))
    if waiting:
        judged()
    return out


@gives_back
def _scanned(batches, net):
    net = net.value
    for batch in batches:
        out = []
        for value in batch.column(batch.num_columns - 1):
            text = value.as_py()
            rules = rule_spans(text)
            found = [(*r, 1.0) for r in rules] + (net_spans(text, rules, net) if net else [])
            out.append([{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in sorted(found)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(_SPAN))], names=[*batch.schema.names[:-1], "spans"])


def scan(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: all findings by start, then kind; the score of rules is 1."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(partial(_scanned, net=sent), f"doc_id long, spans {_SPANS}")


def op13_secret_scans(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs, trained(findings(docs)))
    base = F.filter("spans", lambda x: x["kind"] != "net")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
