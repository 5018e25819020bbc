"""Recommendations by a plain loop, as a batch and as a stream that restarts; late rows and counts of one read."""

import datetime as dt
import json
import random
import subprocess
import sys
from pathlib import Path

from marketloom.streaming import streams

DAY = dt.datetime(2024, 1, 2)
KIND = "date date, version int, ttl_s int, max_s int, close timestamp"


def plain(polls, ttl_s, close):
    out, until = [], {}
    for symbol, ts, price in sorted(polls):
        key = (symbol, ts.date())
        if key not in until or ts >= until[key]:
            ends = [ts + dt.timedelta(seconds=ttl_s), dt.datetime.combine(ts.date() + dt.timedelta(days=1), dt.time())]
            until[key] = min(ends + ([dt.datetime.combine(ts.date(), close)] if close else []))
            out.append((symbol, ts, price, until[key]))
    return out


def polls_of(n, symbols, seed):
    rng = random.Random(seed)
    out = [(rng.choice(symbols), DAY + dt.timedelta(seconds=rng.randrange(3 * 86_400)), rng.choice([1.0, 2.5])) for _ in range(n)]
    rng.shuffle(out)
    return out


def test_one_symbol_with_many_rows(spark):
    polls = polls_of(5_000, ["A"], 1) + polls_of(50, ["B", "C"], 2)
    params = [(DAY.date() + dt.timedelta(days=i), v, ttl, 4_000, dt.datetime.combine(DAY.date() + dt.timedelta(days=i), dt.time(16)) if v == 2 else None) for i in range(3) for v, ttl in ((1, 60), (2, 5_000))]
    got = streams.recommend(spark.createDataFrame(polls, "symbol string, ts timestamp, price double"), spark.createDataFrame(params, KIND)).collect()
    assert sorted((r.symbol, r.ts, r.price, r.expires) for r in got) == plain(polls, 4_000, dt.time(16))
    assert len({r.id for r in got}) == len({(r.symbol, r.ts) for r in got})
    none = streams.recommend(spark.createDataFrame(polls, "symbol string, ts timestamp, price double"), spark.createDataFrame([], KIND), 900).collect()
    assert sorted((r.symbol, r.ts, r.price, r.expires) for r in none) == plain(polls, 900, None)


def test_stream_with_timers_and_restart(spark, tmp_path):
    """Two runs over files in order: what is new equals the plain loop, and what the watermark has passed is expired once."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    polls = sorted((p for p in polls_of(1_500, ["A", "B"], 3) if p[1].date() == DAY.date()), key=lambda p: p[1])
    inbox, params = tmp_path / "in", spark.createDataFrame([], KIND)
    half = len(polls) // 2
    seen = []
    for part in (polls[:half], polls[half:] + [("C", DAY + dt.timedelta(days=3), 1.0)]):
        rows = spark.createDataFrame(random.Random(4).sample(part, len(part)), "symbol string, ts timestamp, price double")
        rows.coalesce(1).write.mode("append").parquet(str(inbox))
        raw = spark.readStream.schema(rows.schema).parquet(str(inbox))
        out = streams.recommend_stream(streams.with_expiry(raw, params, 1_800))
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        seen.append(spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())
    new = sorted((r.symbol, r.ts, r.price, r.expires) for r in seen[1] if r.kind == "new" and r.symbol != "C")
    want = plain(polls, 1_800, None)
    assert new == [(s, t, p, t + dt.timedelta(seconds=1_800)) for s, t, p, _ in want]
    expired = [r.id for r in seen[1] if r.kind == "expired"]
    assert len(expired) == len(set(expired)) and set(expired) == {r.id for r in seen[1] if r.kind == "new" and r.symbol != "C"}
    assert any(r.kind == "new" for r in seen[0])


def test_first_query_of_a_fresh_session():
    """The batch form needs no state store, and so no stream before it."""
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; from marketloom.session import session; s = session('local[2]', 2); print('rows', e.queries()['o235_recommendations'](s, '/root/testdata/sf0.001').count())"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[1], timeout=280)
    assert "rows " in run.stdout and int(run.stdout.split("rows ")[1].split()[0]) > 0, run.stderr[-2000:]


def test_late_rows_and_marks(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    at = lambda minute, key, version=1, rows=True: json.dumps({"schema_version": version, "source": "s", "kind": "poll", "ts_utc": f"2024-01-02T14:{minute:02d}:00Z", "feed_seq": minute, "rows": [{"symbol": "A", "price": 1.0, "volume": 2.0}] * 2 if rows else [], "_key": key})
    run = lambda: streams.split_sink(streams.parsed(spark.readStream.text(str(inbox))), str(tmp_path / "out"), str(tmp_path / "cp")).start().awaitTermination()
    (inbox / "a.txt").write_text("\n".join([at(5, "a"), at(40, "b"), "broken", at(1, "z", rows=False)]))
    run()
    (inbox / "b.txt").write_text("\n".join([at(29, "late"), at(30, "edge"), at(50, "c"), at(2, "bad", 7)]))
    run()
    rows = spark.read.parquet(str(tmp_path / "out" / "rows")).collect()
    assert sorted((r.kind, r._key) for r in rows if r.kind != "bad") == sorted([("good", k) for k in "aabbcc"] + [("good", "edge")] * 2 + [("late", "late")] * 2)
    assert sorted(r.problem for r in rows if r.kind == "bad") == ["unparseable", "version"]
    marks = {r.epoch: (r.good, r.late, r.bad, r.newest.minute) for r in spark.read.parquet(str(tmp_path / "out" / "marks")).collect()}
    assert marks == {0: (4, 0, 1, 40), 1: (4, 2, 1, 50)}
