"""Command line for the pipeline's jobs (what a scheduler invokes).

  python -m livepulse.cli silver  --kind streams --bronze PATH --out PATH --checkpoint PATH [--once]
  python -m livepulse.cli transitions --bronze PATH --out PATH --checkpoint PATH --state-partitions N [--once]
  python -m livepulse.cli gold    --silver PATH --games PATH --out PATH --checkpoint PATH [--gate] [--gate-batches]
  python -m livepulse.cli fold    --gold-root PATH [--vacuum]
  python -m livepulse.cli validate --layer silver --streams PATH --tags PATH --transitions PATH --games PATH
  python -m livepulse.cli compact --layer bronze --path PATH --year 2026 --month 7 [--day 9]

  python -m livepulse.cli ingest  --servers H:P --streams-topic T --games-topic T --out PATH --checkpoint PATH

The ingest needs the broker connector on the classpath. ``--format`` names the table format.
"""

from __future__ import annotations

import argparse
import functools
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="livepulse")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--kind", choices=["streams", "tags", "games"], required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="process what is there, then stop")
    t = sub.add_parser("transitions")
    t.add_argument("--bronze", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--state-partitions", type=int, required=True, help="fixed for ever by the checkpoint")
    t.add_argument("--watermark", default="1 hour")
    t.add_argument("--once", action="store_true")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--games", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--checkpoint", required=True)
    g.add_argument("--max-bytes-per-trigger", type=int, help="table formats that support it")
    g.add_argument("--max-files-per-trigger", type=int)
    g.add_argument("--gate", action="store_true", help="validate silver, load, validate gold")
    g.add_argument("--gate-batches", action="store_true", help="commit no batch that fails a column rule")
    g.add_argument("--buckets", type=int, help="of a new root's tables; fixed for ever")
    o = sub.add_parser("fold")
    o.add_argument("--gold-root", required=True)
    o.add_argument("--vacuum", action="store_true", help="also remove folders no reader needs")
    v = sub.add_parser("validate")
    v.add_argument("--layer", choices=["silver", "gold"], required=True)
    for name in ("streams", "tags", "transitions", "games", "gold-root"):
        v.add_argument(f"--{name}")
    c = sub.add_parser("compact")
    c.add_argument("--layer", choices=["bronze", "silver"], required=True)
    c.add_argument("--path", required=True, action="append")
    c.add_argument("--year", type=int)
    c.add_argument("--month", type=int)
    c.add_argument("--day", type=int)
    i = sub.add_parser("ingest")
    i.add_argument("--servers", required=True)
    i.add_argument("--streams-topic", required=True)
    i.add_argument("--games-topic", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--encoding", choices=["json", "avro"], default="json")
    i.add_argument("--source-format", default="kafka")
    for x in (s, t, g, v, c, i):
        x.add_argument("--format", default="parquet", help="table format on disk")
    return p


def _silver_checks(spark, args):
    from livepulse.operators import quality as Q
    read = lambda path: spark.read.format(args.format).load(path)
    parts = [Q.run_checks("streams", read(args.streams), Q.silver_stream_checks()),
             Q.run_checks("stream_tags", read(args.tags), Q.tag_checks()),
             Q.run_checks("stream_transitions", read(args.transitions), Q.transition_checks()),
             Q.run_checks("games", read(args.games), Q.game_checks())]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def _gold_checks(spark, root):
    from livepulse.operators import quality as Q
    from livepulse.streaming import jobs
    return Q.run_gold_checks(jobs.read_gold(spark, root))


def run(argv: list[str], spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.cmd == "compact":
        from livepulse.operators.maintenance import maintenance_args
        req = maintenance_args(args.layer, args.year, args.month, args.day)   # validate before starting Spark
    spark = spark or SparkSession.builder.appName(f"livepulse-{args.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from livepulse.streaming import jobs
    trig = "available_now" if getattr(args, "once", False) else "processing_time"
    if args.cmd == "ingest":
        from livepulse.sources.streams import await_any, broker_stream
        make = {"streams": jobs.bronze_streams_job, "games": jobs.bronze_games_job}
        for kind, topic in (("streams", args.streams_topic), ("games", args.games_topic)):
            make[kind](broker_stream(spark, args.servers, topic, fmt=args.source_format), f"{args.out}/{kind}",
                       f"{args.checkpoint}/{kind}", encoding=args.encoding, fmt=args.format)
        await_any(spark)
    elif args.cmd == "silver":
        jobs.silver_job(spark, args.kind, args.bronze, args.out, args.checkpoint, trigger=trig,
                        fmt=args.format).awaitTermination()
    elif args.cmd == "transitions":
        jobs.transitions_job(spark, args.bronze, args.out, args.checkpoint, trigger=trig, fmt=args.format,
                             watermark=args.watermark, state_partitions=args.state_partitions).awaitTermination()
    elif args.cmd == "gold":
        from livepulse.operators import quality as Q
        silver = spark.read.format(args.format).load(args.silver)
        games = spark.read.format(args.format).load(args.games)

        def load():
            jobs.gold_job(spark, args.silver, games, args.out, args.checkpoint, silver.schema, fmt=args.format,
                          max_bytes_per_trigger=args.max_bytes_per_trigger,
                          max_files_per_trigger=args.max_files_per_trigger, gate=args.gate_batches,
                          buckets=args.buckets).awaitTermination()

        if args.gate:
            failed = Q.run_gated(lambda: Q.run_checks("streams", silver, Q.silver_stream_checks()).unionByName(
                Q.run_checks("games", games, Q.game_checks())), load, lambda: _gold_checks(spark, args.out))
            _report(failed)
        else:
            load()
    elif args.cmd == "fold":
        folded = jobs.fold_gold(spark, args.gold_root)
        gone = jobs.gold_tables(spark, args.gold_root).vacuum() if args.vacuum else 0
        print(f"{'folded' if folded else 'nothing to fold'}; {gone} folders removed")
    elif args.cmd == "validate":
        from livepulse.operators import quality as Q
        silver_layer = args.layer == "silver"
        res = _silver_checks(spark, args) if silver_layer else _gold_checks(spark, args.gold_root)
        _report(Q.gate(res, halt=silver_layer))
    elif args.cmd == "compact":
        from livepulse.operators.maintenance import compact
        for path in args.path:
            names = spark.read.format(args.format).load(path).columns
            dated = args.layer == "bronze" and {"year", "month", "day"} <= set(names)   # the games table has no dates
            compact(spark, path, args.format, ("year", "month", "day") if dated else (),
                    *((req["year"], req["month"], req["day"]) if dated else (None, None, None)))
    return 0


def _report(failed: list[dict]) -> None:
    for f in failed:
        print(f"FAILED {f['table']}: {f['check']} (value {f['value']})")


def main() -> int:
    return run(sys.argv[1:])


if __name__ == "__main__":
    sys.exit(main())
