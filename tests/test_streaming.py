import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from pagewright.operators import log as lg
from pagewright.streaming import cuts, windows

START = dt.datetime(2024, 1, 1)


class Folder:
    """A folder that grows, and a stream over it that is started anew each time."""

    def __init__(self, spark, schema, make):
        self.spark, self.make, self.base = spark, make, tempfile.mkdtemp(prefix="run-")
        self.schema = spark.createDataFrame([], schema).schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self):
        stream = cuts.read_folder(self.spark, f"{self.base}/in", self.schema)
        return windows.run_available(self.make(stream), f"{self.base}/out", f"{self.base}/checkpoint")

    def out(self):
        return self.spark.read.parquet(f"{self.base}/out")


LOG = "run int, seed int, page_no long, n int, ts timestamp"


def log_rows(rng, n):
    return [(rng.randrange(2), rng.randrange(3), i, rng.choice([0, 0, 0, 5]), START + dt.timedelta(minutes=i)) for i in range(n)]


def streaks(limit, **options):
    return lambda s: cuts.with_streaks(s.withColumn("empty", F.col("n") == 0), ["run", "seed"], "page_no", "empty", "ts", limit, **options)


def test_streaks_over_restarts_equal_the_batch_cut(spark):
    rows = log_rows(random.Random(1), 150)
    folder = Folder(spark, LOG, streaks(3))
    for lo, hi in ((0, 60), (60, 61), (61, 150)):
        part = rows[lo:hi]
        random.Random(lo).shuffle(part)
        folder.add(part)
        folder.run()
    out = folder.out()
    kept = lambda df: sorted(tuple(r) for r in df.select("run", "seed", "page_no").collect())
    assert kept(out.filter("kept")) == kept(lg.streak_cut(spark.createDataFrame(rows, LOG), 3))
    assert out.count() == 150 and not out.filter("late").count()
    want, state = {}, {}
    for run, seed, page, n, _ in rows:
        state[run, seed] = 0 if n else state.get((run, seed), 0) + 1
        want[page] = state[run, seed]
    assert {r.page_no: r.streak for r in out.collect()} == want


def test_rows_out_of_order_between_runs_are_marked(spark):
    folder = Folder(spark, LOG, streaks(2, delay="10 days"))
    at = lambda i: START + dt.timedelta(minutes=i)
    folder.add([(0, 0, 5, 0, at(5))])
    folder.run()
    folder.add([(0, 0, 4, 0, at(4)), (0, 0, 6, 0, at(6)), (0, 0, 7, 1, at(7))])
    folder.run()
    assert sorted((r.page_no, r.streak, r.kept, r.late) for r in folder.out().filter("page_no <> 4").collect()) == [(5, 1, True, False), (6, 2, True, False), (7, 0, False, False)]
    assert [(r.streak, r.kept, r.late) for r in folder.out().filter("page_no = 4").collect()] == [(None, False, True)]


def test_idle_keys_begin_anew(spark):
    folder = Folder(spark, LOG, streaks(9, idle_days=1.0))
    day = lambda d: START + dt.timedelta(days=d)
    for d, seed in ((0, 1), (1, 2), (3, 2), (4, 2)):
        folder.add([(0, seed, 10 * d, 0, day(d))])
        folder.run()
    folder.add([(0, 1, 50, 0, day(5)), (0, 2, 50, 0, day(4) + dt.timedelta(hours=9))])
    folder.run()
    assert {(r.seed, r.streak) for r in folder.out().filter("page_no = 50").collect()} == {(1, 1), (2, 2)}


EVENTS = "id long, kind string, ts timestamp"


def plain_windows(batches, width, slide, delay):
    """What the rules say: per batch, the watermark is the latest time of the batches before, less the delay;
    windows that end by it are final."""
    counts, late, top, mark = {}, 0, None, None
    for rows in batches:
        for _, kind, ts in rows:
            start = ts - (ts - START) % slide
            while start > ts - width:
                if mark is not None and start + width <= mark:
                    late += 1
                else:
                    counts[start, kind] = counts.get((start, kind), 0) + 1
                start -= slide
        top = max([t for _, _, t in rows] + ([top] if top else []))
        mark = top - delay
    return {(s, k, n) for (s, k), n in counts.items() if s + width <= mark}, late


def check_windows(spark, width, slide, delay):
    rng = random.Random(7)
    batches, clock = [], 0
    for k in range(5):
        clock += 3600
        batches.append([(100 * k + i, rng.choice("ab"), START + dt.timedelta(seconds=max(0, clock - int(rng.expovariate(1 / 2500))))) for i in range(60)])
    text = lambda d: f"{int(d.total_seconds())} seconds"
    folder = Folder(spark, EVENTS, lambda s: windows.windowed(s, "ts", text(width), ["kind"], text(slide), text(delay), largest=F.max("id")))
    seen = {"rows": 0, "dropped": 0}
    for rows in batches:
        folder.add(rows)
        for name, n in folder.run().items():
            seen[name] += n
    final, late = plain_windows(batches, width, slide, delay)
    got = [(r.window_start, r.kind, r.n_rows) for r in folder.out().collect()]
    assert len(got) == len(set(got)) and set(got) == final
    assert seen["rows"] == 300 and 0 < seen["dropped"] <= late


def test_tumbling_windows(spark):
    check_windows(spark, dt.timedelta(minutes=10), dt.timedelta(minutes=10), dt.timedelta(minutes=30))


def test_sliding_windows(spark):
    check_windows(spark, dt.timedelta(minutes=20), dt.timedelta(minutes=5), dt.timedelta(minutes=15))


def test_nothing_is_dropped_in_time(spark):
    folder = Folder(spark, EVENTS, lambda s: windows.windowed(s, "ts", "10 minutes", ["kind"], delay="1 hour"))
    for k in range(3):
        folder.add([(i, "a", START + dt.timedelta(minutes=30 * k + i)) for i in range(40)])
        assert folder.run() == {"rows": 40, "dropped": 0}


def test_windows_of_a_table(spark):
    rows = [(i, "a", START + dt.timedelta(minutes=i)) for i in range(30)] + [(99, "a", None)]
    got = windows.windowed(spark.createDataFrame(rows, EVENTS), "ts", "10 minutes", ["kind"])
    assert sorted(r.n_rows for r in got.collect()) == [10, 10, 10]
