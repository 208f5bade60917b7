"""Stateful sessions over arriving files against one pass over all rows."""

import datetime
import random

from pyspark.sql import functions as F

from tracewell.sources.tables import TableStore
from tracewell.streaming import sessions as st

START = datetime.datetime(2024, 5, 1)
GAP = 600


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(0 if rng.random() < 1 / 3 else rng.choice([None, 1, 2, 3, 4]),
             START + datetime.timedelta(seconds=rng.randint(0, 40_000), microseconds=rng.randint(0, 3)), rng.randint(-5, 50))
            for _ in range(n)]


def brute(rows):
    out = []
    for user in {u for u, _, _ in rows}:
        mine = sorted((t, v) for u, t, v in rows if u == user)
        for t, v in mine:
            if out and out[-1][0] == user and t < out[-1][2]:
                out[-1][2:] = [t + datetime.timedelta(seconds=GAP), out[-1][3] + 1, out[-1][4] + v]
            else:
                out.append([user, t, t + datetime.timedelta(seconds=GAP), 1, v])
    return sorted(out, key=repr)


class Arrivals:
    def __init__(self, spark, path):
        self.spark, self.path, self.store = spark, str(path), TableStore(spark, f"{path}/store")

    def take(self, name, rows):
        self.spark.createDataFrame(rows, "user long, ts timestamp, v int").coalesce(1).write.parquet(f"{self.path}/in/{name}")
        stream = (self.spark.readStream.schema("user long, ts timestamp, v int").option("recursiveFileLookup", "true")
                  .option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in"))
        found = st.sessions_of(stream, "ts", "20 minutes", GAP, {"user": "bigint"}, [F.col("v")])
        st.run_sessions(found, self.store, "s", f"{self.path}/checkpoint")

    def sessions(self):
        return sorted(([r.user, r.start, r.stop, r.n, r.sums[0]] for r in st.stored_sessions(self.store, "s", ["user"]).collect()),
                      key=repr)

    def kinds(self):
        return {r["kind"]: r["count"] for r in self.store.read("s").groupBy("kind").count().collect()}


def test_late_files_give_what_one_pass_gives(spark, tmp_path):
    rows = rows_of(1, 600)
    rng = random.Random(2)
    early, late = [], []
    for row in rows:
        (late if rng.random() < 0.25 else early).append(row)
    arrivals = Arrivals(spark, tmp_path)
    arrivals.take("early", early)
    assert arrivals.sessions() == brute(early)
    arrivals.take("late", late)
    assert arrivals.sessions() == brute(rows)
    kinds = arrivals.kinds()
    assert kinds["late"] > 20 and kinds["closed"] > 20
    # A run without new files changes nothing.
    arrivals.take("none", [])
    assert arrivals.sessions() == brute(rows)


def test_sessions_close_once_and_state_stays_small(spark, tmp_path):
    rows = sorted(rows_of(3, 500), key=lambda r: r[1])
    arrivals = Arrivals(spark, tmp_path)
    parts = [rows[i:i + 100] for i in range(0, 500, 100)]
    for i, part in enumerate(parts):
        arrivals.take(f"part{i}", part)
        stored = arrivals.store.read("s")
        last = stored.agg(F.max("batch")).first()[0]
        open_now = stored.filter(f"kind = 'open' AND batch = {last}").count()
        assert open_now <= 5 * 4  # no more than the sessions of five users within the watermark's delay
    assert arrivals.sessions() == brute(rows)
    closed = arrivals.store.read("s").filter("kind = 'closed'")
    assert closed.count() == closed.select("user", "start").distinct().count()
    assert "late" not in arrivals.kinds()
