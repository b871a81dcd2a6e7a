"""Command-line entry points, one per job of the reference.

    python -m cadence generate BROKERS [--topic songs] [--rows-per-second 2] [--max-time-deviation 0]
    python -m cadence analyze  BROKERS [--topic songs] [--session-gap 20] [--trigger-interval 5]
                               [--no-discover-weekly] [--no-subsession-stats] [--no-session-stats]
                               [--dialect window|span] [--watermark-delay 0]

``analyze --dialect window`` writes the window-dialect results (session panes with
instants, run counts); ``--dialect span`` the span-dialect results (durations without
the gap, run lengths) to the three result topics.  ``--source-format``/``--sink-format``
switch Kafka for files (parquet) or the console.
"""

from __future__ import annotations

import argparse
import sys

from cadence.options import JobOptions


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m cadence")
    sub = p.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("generate", help="write synthetic events")
    g.add_argument("brokers", nargs="?", default="", help="Kafka bootstrap servers")
    g.add_argument("-t", "--topic", default="songs")
    g.add_argument("--rows-per-second", type=int, default=None,
                   help="stream rate (default: from --max-interval, mean pause max/2 ms)")
    g.add_argument("--count", type=int, default=0, help="batch mode: write this many events and stop")
    g.add_argument("-m", "--max-interval", type=int, default=1000, help="max ms between consecutive events")
    g.add_argument("--max-time-deviation", type=int, default=0, help="ms of timestamp jitter")
    g.add_argument("--sink-format", default="kafka")
    g.add_argument("--path", default=None)

    a = sub.add_parser("analyze", help="session stats, Discover-Weekly runs, listening runs")
    a.add_argument("brokers", nargs="?", default="", help="Kafka bootstrap servers")
    a.add_argument("--topic", default="songs")
    a.add_argument("--session-gap", type=int, default=20, help="seconds")
    a.add_argument("--trigger-interval", type=int, default=5, help="seconds between early panes")
    # Both spellings: --no-x and the reference's --nox.
    a.add_argument("--no-discover-weekly", "--nodiscover-weekly", dest="no_discover_weekly", action="store_true")
    a.add_argument("--no-subsession-stats", "--nosubsession-stats", dest="no_subsession_stats", action="store_true")
    a.add_argument("--no-session-stats", "--nosession-stats", dest="no_session_stats", action="store_true")
    a.add_argument("--no-early-panes", action="store_true")
    a.add_argument("--dialect", choices=("window", "span"), default="window")
    a.add_argument("--watermark-delay", type=int, default=0, help="ms")
    a.add_argument("--session-write-topic", default="session-stats")
    a.add_argument("--discover-weekly-write-topic", default="discover-weekly-stats")
    a.add_argument("--subsession-write-topic", default="subsession-stats")
    a.add_argument("--source-format", default="kafka", choices=("kafka", "parquet", "text"))
    a.add_argument("--source-path", default=None)
    a.add_argument("--sink-format", default="kafka")
    a.add_argument("--output", default=None, help="folder for file sinks")
    a.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    a.add_argument("--checkpoint", default=None, help="checkpoint folder (default: derived from the job)")
    a.add_argument("--late-events-output", default=None, help="folder for the view of late events")
    a.add_argument("--late-events-mode", choices=("punctuated", "max"), default="punctuated")
    a.add_argument("--on-error", choices=("fail", "drop"), default="fail",
                   help="invalid records: stop the job, or leave them out (with --errors-output: written there)")
    a.add_argument("--errors-output", default=None, help="folder for invalid records and their reasons")
    a.add_argument("--batch", action="store_true", help="one-shot batch run over the stored events at --source-path")
    return p


def options_from(args: argparse.Namespace) -> JobOptions:
    return JobOptions(
        topic=args.topic,
        session_gap_s=args.session_gap,
        trigger_interval_s=args.trigger_interval,
        session_stats=not args.no_session_stats,
        discover_weekly=not args.no_discover_weekly,
        subsession_stats=not args.no_subsession_stats,
        early_panes=not args.no_early_panes,
        session_write_topic=args.session_write_topic,
        discover_weekly_write_topic=args.discover_weekly_write_topic,
        subsession_write_topic=args.subsession_write_topic,
        dialect=args.dialect,
        merge_touching=True,
    )


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from cadence.plans import job
    from cadence.session import build_spark

    spark = build_spark(app=f"cadence-{args.cmd}")
    kafka = {"kafka.bootstrap.servers": args.brokers} if args.brokers else {}
    if args.cmd == "generate":
        if args.count:
            job.write_generated(
                spark, args.count, args.sink_format, path=args.path, topic=args.topic, options=kafka,
                max_interval_ms=args.max_interval, max_time_deviation_ms=args.max_time_deviation,
            )
            return 0
        rate = args.rows_per_second or max(1, round(2000 / max(args.max_interval, 1)))
        q = job.start_generator(
            spark, rate, args.sink_format, path=args.path, topic=args.topic, options=kafka,
            max_time_deviation_ms=args.max_time_deviation,
        )
        q.awaitTermination()
        return 0

    from cadence.streaming.quarantine import read_valid_events, start_quarantine
    from cadence.streaming.sources import read_event_stream, read_wire_batch, read_wire_stream

    opts = options_from(args)
    if args.batch:
        from cadence.functions import codec

        if args.source_format == "kafka":
            wire = read_wire_batch(spark, "kafka", topic=args.topic, options=kafka)
        else:
            wire = read_wire_batch(spark, args.source_format, path=args.source_path)
        if args.on_error == "fail":
            events = codec.decode(wire, on_error="fail")
        else:
            events, bad = codec.decode(wire, on_error="quarantine")
            if args.errors_output:
                bad.write.mode("overwrite").parquet(args.errors_output)
        job.write_batch_results(events, opts, args.output)
        return 0
    split = []
    if args.on_error == "drop" and args.errors_output:
        # One pass keeps invalid records apart; the analyses read the valid events it writes.
        wire = read_wire_stream(spark, args.source_format, path=args.source_path, topic=args.topic, options=kafka)
        valid = args.errors_output.rstrip("/") + "-valid-events"
        ck = (args.checkpoint or args.errors_output.rstrip("/")) + "-split"
        split = [start_quarantine(wire, valid, args.errors_output, ck, available_now=args.available_now)]
        if args.available_now:
            split.pop().awaitTermination()
        events = read_valid_events(spark, valid)
    else:
        events = read_event_stream(
            spark, args.source_format, path=args.source_path, topic=args.topic, options=kafka, on_error=args.on_error
        )
    queries = split + job.start_streaming_job(
        spark, events, opts, sink_fmt=args.sink_format, sink_options=kafka if args.sink_format == "kafka" else {},
        output_root=args.output, watermark_delay_ms=args.watermark_delay,
        available_now=args.available_now, checkpoint_dir=args.checkpoint,
        late_events_output=args.late_events_output, late_events_mode=args.late_events_mode,
    )
    for q in queries:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
