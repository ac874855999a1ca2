"""Times the registered queries and the produce/consume/relay workloads; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the cores (default 8).
Every query is run once and its result written to Spark's ``noop`` sink, so all
rows and columns are produced. To warm up the JVM the event log is published
once before the clock starts; ``publish_events`` then times another publishing,
and the queries read that log as subscribers read a topic filled before.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from streamlog.operators import delivery, offsets, records  # noqa: E402
from streamlog.plans import catalogue  # noqa: E402
from streamlog.plans import fixtures as fx  # noqa: E402
from streamlog.session import drop_scratch, local_session, materialize, scratch_path  # noqa: E402
from streamlog.sinks.log import append  # noqa: E402
from streamlog.streaming import relay  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def workloads(spark):
    """Produce, consume and relay the wide log: order lines as JSON records."""
    lines = {}

    def produce():
        lines["log"] = fx.publish_lines(spark, SF_DIR)

    def consume():
        run(lines["log"].subscribe(["lines"]))

    def consume_confirmed():
        """Read batches of 500 records per partition, take each batch's positions, confirm and commit them."""
        records = lines["log"].subscribe(["lines"])
        batches = records.withColumn("batch_no", F.floor(F.col("offset") / 500))
        # Every column is read, as a receiver of the batches would.
        seen = batches.filter(F.xxhash64("key", "value", "timestamp").isNotNull())
        sent = materialize(offsets.position_changes(seen), "bench-sent")
        run(delivery.commit_confirmed(offsets.empty(spark), sent, sent))

    def appended():
        """A small append to a log of many segments."""
        log = lines["log"]
        few = log.seek({("lines", 0): 0}).filter("offset < 1000").drop("offset")
        run(append(few, log, ["timestamp", "key", "value"]))

    def relayed():
        path = scratch_path(spark, "bench-relay")
        relay.relay(
            lines["log"].stream(), lambda batch: records.to_producer_records(batch, "copy"),
            path, f"{path}/checkpoint",
        ).awaitTermination()

    return {
        "wide_produce": produce, "wide_consume": consume,
        "wide_consume_confirm": consume_confirmed, "wide_relay": relayed, "wide_append": appended,
    }


def main() -> None:
    spark = local_session(CPUS, "streamlog-bench")
    spark.sparkContext.setLogLevel("ERROR")
    n_events = fx.events(spark, SF_DIR).count()
    n_lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    run(fx.publish_events(spark, SF_DIR).records())

    jobs = {"publish_events": lambda: fx.event_log(spark, SF_DIR)}
    jobs.update({name: (lambda q=query: run(q(spark, SF_DIR))) for name, query in catalogue.QUERIES.items()})
    jobs.update(workloads(spark))
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr)

    rates = {name: int(n_lines / seconds[name]) for name in workloads(spark) if name != "wide_append"}
    rates["publish_events"] = int(n_events / seconds["publish_events"])
    print(json.dumps({
        "metric": "streamlog total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "records_per_sec": rates,
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
