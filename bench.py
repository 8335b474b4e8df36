"""Times the reports and jobs at $BENCH_SF_DIR and prints one JSON line.

Reports run over an in-layout fact table (written once, untimed), as they do
in use; each is warmed up once and the best of three runs counts. Jobs that
write are timed once, after a warm-up run into another folder.
"""

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import functions as F  # noqa: E402

from checks import fixtures as fx  # noqa: E402
from tidemark.operators import enrich, validate  # noqa: E402
from tidemark.plans import health, load, maintain, reports  # noqa: E402
from tidemark.session import build_session, work_folder  # noqa: E402
from tidemark.sources import landing  # noqa: E402
from tidemark.sources.fact import FactTable  # noqa: E402
from tidemark.streaming import transform_job  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HOURS = fx.LOOK_BACK_HOURS


def drain(frame):
    frame.write.format("noop").mode("overwrite").save()


def best_of(runs, action):
    times = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return min(times[1:])


def once(action):
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def report_runs(events):
    return {
        "events_per_minute": lambda: reports.events_per_minute(events, fx.AS_OF, HOURS),
        "top_event_types": lambda: reports.top_event_types(events, fx.AS_OF, HOURS),
        "funnel": lambda: reports.funnel(events, fx.AS_OF, fx.FUNNEL_STEPS, since="2024-01-01 00:00:00"),
        "revenue_by_hour": lambda: reports.revenue_by_hour(events, fx.AS_OF, fx.LOOK_BACK_DAYS),
        "duplicate_events": lambda: reports.duplicate_events(events, fx.AS_OF, HOURS),
        "load_latency": lambda: reports.load_latency(events, fx.AS_OF, HOURS),
        "active_users_minute": lambda: reports.active_users(events, fx.AS_OF, HOURS),
        "active_users_sliding": lambda: reports.active_users_sliding(events, fx.AS_OF, HOURS),
        "error_rate_by_page": lambda: reports.error_rate_by_page(events, fx.AS_OF, HOURS),
        "last_hour_per_minute": lambda: reports.events_per_minute(events, "2024-01-30 12:00:00", 1),
        "skew_report": lambda: maintain.skew_report(events),
    }


def main():
    spark = build_session(
        f"local[{CPUS}]",
        "bench",
        shuffle_partitions=CPUS,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = work_folder(spark, "bench")
    times = {}

    table = FactTable(spark, f"{base}/fact")
    table.commit(fx.fact(spark, SF_DIR))
    events = table.read()
    for name, make in report_runs(events).items():
        times[name] = best_of(3, lambda make=make: drain(make()))

    # The records as a stream delivers them: written out first, untimed.
    records = fx.records(spark, SF_DIR, redelivered=True, resent=True)
    records.repartition(4 * int(CPUS)).write.parquet(f"{base}/records")
    stored = spark.read.parquet(f"{base}/records")
    count = stored.count()
    times["check_and_enrich"] = best_of(
        3, lambda: drain(enrich.enrich(validate.good(validate.check(stored))).select("line"))
    )
    times["full_validation"] = best_of(3, lambda: drain(validate.summary(validate.check(stored, "full"))))
    times["shard_points"] = best_of(3, lambda: drain(health.shard_points(stored)))

    def transform(name):
        source = spark.readStream.schema(stored.schema).parquet(f"{base}/records")
        root = f"{base}/{name}"
        transform_job.start(source, root, f"{root}/checkpoint", trigger=None).awaitTermination()

    transform("warm-up")
    times["stream_transform"] = once(lambda: transform("landing"))

    target = FactTable(spark, f"{base}/target")
    lines = landing.read_lines(spark, f"{base}/landing")
    load.load(FactTable(spark, f"{base}/warm-up-target"), lines, "warm-up")
    times["load_first"] = once(lambda: load.load(target, lines, "first"))
    times["load_again"] = once(lambda: load.load(target, lines, "again"))
    one_day = landing.read_prefix(spark, f"{base}/landing/events")
    day = one_day.where(F.col("line").contains('"timestamp":"2024-01-15'))
    times["upsert_one_day"] = once(lambda: load.load(target, day, "one day"))

    report_names = list(report_runs(events))
    result = {
        "metric": "total time of reports and jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": SF_DIR.rstrip("/").split("sf")[-1],
        "slowest_report_sec": round(max(times[n] for n in report_names), 3),
        "records": count,
        "transform_events_per_sec": round(count / times["stream_transform"]),
        "check_events_per_sec": round(count / times["check_and_enrich"]),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
