"""The analyses as a job: batch (``analyze``) and streaming (``start_streaming_job``).

Three analyses, each on by default and switchable in ``JobOptions``:

* session stats (with early cumulative panes in the window dialect),
* Discover-Weekly runs,
* listening runs ("subsessions").

Batch: one ``sessionize`` call annotates every event with its session and both
kinds of run; every result is an aggregation of that one DataFrame.  When several
results are written, ``materialize=True`` cuts the lineage with ``checkpoint()``
(the shared ``spark.checkpoint.dir``) so the event shuffle runs once.

Streaming: one stateful query serves all three closed-session analyses, written per
micro-batch with ``foreachBatch``, each result once per batch id and place
(``cadence.streaming.once``): the bounded-state
operator of ``cadence.streaming.runs`` (state: events not yet behind the watermark
plus one open session per user).  Early panes are a second stateful query.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.functions import messages as M
from cadence.functions.predicates import floor_div, is_search, not_discover_weekly
from cadence.operators.panes import early_session_panes
from cadence.operators.sessions import runs_from, session_stats_from, sessionize, song_measure
from cadence.options import JobOptions
from cadence.session import checkpoint_root
from cadence.streaming import runs as SR
from cadence.streaming.panes import stream_early_panes
from cadence.streaming.once import FILES, write_once
from cadence.streaming.sinks import start_sink

DW, LISTEN = "dw", "listen"


def annotate(events: DataFrame, options: JobOptions) -> DataFrame:
    return sessionize(
        events,
        options.gap_ms,
        delimiters={DW: not_discover_weekly(), LISTEN: is_search()},
        measures=song_measure(),
        merge_touching=options.merge_touching,
    )


def analyze(events: DataFrame, options: JobOptions = JobOptions(), *, materialize: bool = False) -> dict[str, DataFrame]:
    """Batch results of the enabled analyses, keyed by output name."""
    ann = annotate(events, options)
    if materialize:
        checkpoint_root(events.sparkSession)
        ann = ann.checkpoint(eager=True)
    out: dict[str, DataFrame] = {}
    if options.session_stats:
        out["session_stats"] = session_stats_from(ann, options.gap_ms, duration=options.dialect)
        if options.panes:
            out["session_panes"] = early_session_panes(None, options.gap_ms, options.interval_ms, annotated=ann)
    if options.discover_weekly:
        out["discover_weekly"] = runs_from(ann, DW)
    if options.subsession_stats:
        out["subsessions"] = runs_from(ann, LISTEN)
    return out


def messages(results: dict[str, DataFrame], options: JobOptions = JobOptions()) -> dict[str, DataFrame]:
    """Each result (computed with the same options) as a one-column ``value`` DataFrame of
    text messages.

    window dialect: session (or pane) messages with instants, DW runs, listening counts;
    span dialect:   session durations without the gap, runs with their lengths."""
    dialect = options.dialect
    col = F.col
    out: dict[str, DataFrame] = {}
    for name, df in results.items():
        if name in ("session_stats", "session_panes"):
            if dialect == "window":
                dur = floor_div(col("end_ms") - col("start_ms"), 1000) if name == "session_panes" else col("duration_s")
                v = M.session_message_window(col("user_id"), col("start_ms"), col("end_ms"), dur, col("songs"))
            else:
                v = M.session_message_span(col("user_id"), col("duration_s"), col("songs"))
        elif name == "discover_weekly":
            v = (M.discover_weekly_message_window if dialect == "window" else M.discover_weekly_message_span)(
                col("user_id"), col("length_s"), col("songs")
            )
        elif name == "subsessions":
            v = (
                M.listening_message_window(col("user_id"), col("songs"))
                if dialect == "window"
                else M.listening_message_span(col("user_id"), col("length_s"), col("songs"))
            )
        else:
            continue
        out[name] = df.select(v.alias("value"))
    return out


def topics(options: JobOptions) -> dict[str, str]:
    return {
        "session_stats": options.session_write_topic,
        "session_panes": options.session_write_topic,
        "discover_weekly": options.discover_weekly_write_topic,
        "subsessions": options.subsession_write_topic,
    }


def start_streaming_job(
    spark: SparkSession,
    events: DataFrame,
    options: JobOptions = JobOptions(),
    *,
    sink_fmt: str = "kafka",
    sink_options: dict[str, str] | None = None,
    output_root: str | None = None,
    checkpoint_dir: str | None = None,
    watermark_delay_ms: int = 0,
    available_now: bool = False,
    late_events_output: str | None = None,
    late_events_mode: str = "punctuated",
) -> list[StreamingQuery]:
    """Start the enabled analyses on a decoded event stream; returns the queries.

    Kafka sinks write to the option topics; file sinks write under ``output_root``
    (one sub-folder per result).  The checkpoint defaults to a folder of the shared
    checkpoint dir named after the job's identity (source plan, sinks, options), so a
    restarted job resumes and two different jobs never share one."""
    sink_options = sink_options or {}
    if checkpoint_dir is None:
        import hashlib

        identity = repr((events._jdf.queryExecution().logical().toString(), sink_fmt, sorted(sink_options.items()),
                         output_root, options, watermark_delay_ms))
        job_id = hashlib.sha256(identity.encode()).hexdigest()[:16]
    ck = checkpoint_dir or os.path.join(checkpoint_root(spark), f"cadence-job-{job_id}")
    targets = (
        topics(options)
        if sink_fmt == "kafka"
        else {k: os.path.join(output_root or ck, k) for k in ("session_stats", "session_panes", "discover_weekly", "subsessions")}
    )
    queries: list[StreamingQuery] = []
    closed_stats = options.session_stats and not options.panes
    want_closed = options.discover_weekly or options.subsession_stats or closed_stats
    if want_closed:
        delimiters = {DW: not_discover_weekly(), LISTEN: is_search()}
        sessions = SR.stream_sessions_and_runs(
            events, options.gap_ms, delimiters, watermark_delay_ms=watermark_delay_ms,
            merge_touching=options.merge_touching,
        )

        def stats_of(b: DataFrame) -> DataFrame:
            return SR.sessions_of(b, options.gap_ms, options.dialect)

        runs_of = SR.runs_of

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            # Up to three writes read this micro-batch: compute it once.
            batch = batch.persist()
            try:
                results: dict[str, DataFrame] = {}
                if closed_stats:
                    results["session_stats"] = stats_of(batch)
                if options.discover_weekly:
                    results["discover_weekly"] = runs_of(batch, DW)
                if options.subsession_stats:
                    results["subsessions"] = runs_of(batch, LISTEN)
                for name, df in messages(results, options).items():
                    write_once(df, sink_fmt, targets[name], batch_id, os.path.join(ck, "written"), sink_options)
            finally:
                batch.unpersist()

        w = sessions.writeStream.outputMode("append").option("checkpointLocation", os.path.join(ck, "sessions"))
        w = w.foreachBatch(per_batch)
        if available_now:
            w = w.trigger(availableNow=True)
        queries.append(w.start())
    if options.panes:
        panes = stream_early_panes(
            events, options.gap_ms, options.interval_ms, watermark_delay_ms=watermark_delay_ms,
            merge_touching=options.merge_touching,
        )
        msgs = messages({"session_panes": panes}, options)["session_panes"]
        target = targets["session_panes"]
        if sink_fmt in FILES:  # Spark's own file sink writes each batch once
            queries.append(start_sink(msgs, sink_fmt, os.path.join(ck, "panes"), path=target, options=sink_options, available_now=available_now))
        else:
            send = lambda b, i: write_once(b, sink_fmt, target, i, os.path.join(ck, "written-panes"), sink_options)
            w = msgs.writeStream.option("checkpointLocation", os.path.join(ck, "panes")).foreachBatch(send)
            queries.append((w.trigger(availableNow=True) if available_now else w).start())
    if late_events_output:
        from cadence.streaming.late import start_late_event_view

        queries.append(
            start_late_event_view(
                events, options.gap_ms, os.path.join(ck, "late"), late_events_output, mode=late_events_mode,
                delay_ms=watermark_delay_ms, available_now=available_now,
            )
        )
    return queries


def write_generated(
    spark: SparkSession,
    n: int,
    fmt: str,
    *,
    path: str | None = None,
    topic: str = "songs",
    options: dict[str, str] | None = None,
    max_interval_ms: int = 1000,
    max_time_deviation_ms: int = 0,
) -> None:
    """Batch generator job: ``n`` synthetic wire events to Kafka (topic) or files (path)."""
    from cadence.sources.generator import generate_events, to_wire

    wire = to_wire(
        generate_events(spark, n, max_interval_ms=max_interval_ms, max_time_deviation_ms=max_time_deviation_ms)
    )
    w = wire.write.options(**(options or {}))
    if fmt == "kafka":
        w.format("kafka").option("topic", topic).save()
    else:
        w.mode("append").format(fmt).save(path)


def start_generator(
    spark: SparkSession,
    rows_per_second: int,
    fmt: str,
    *,
    checkpoint: str | None = None,
    path: str | None = None,
    topic: str = "songs",
    options: dict[str, str] | None = None,
    max_time_deviation_ms: int = 0,
) -> StreamingQuery:
    """Streaming generator job: a ``rate`` source turned into wire events, to a sink."""
    from cadence.sources.generator import generate_event_stream, to_wire

    wire = to_wire(generate_event_stream(spark, rows_per_second, max_time_deviation_ms=max_time_deviation_ms))
    import hashlib

    job_id = hashlib.sha256(repr((fmt, path, topic, sorted((options or {}).items()))).encode()).hexdigest()[:16]
    ck = checkpoint or os.path.join(checkpoint_root(spark), f"cadence-generator-{job_id}")
    return start_sink(wire, fmt, ck, path=path, topic=topic, options=options)


def write_batch_results(
    events: DataFrame,
    options: JobOptions,
    output_root: str,
    *,
    fmt: str = "parquet",
    as_messages: bool = True,
) -> dict[str, str]:
    """Batch job: every enabled result of ``events`` written under ``output_root``.

    The annotation is cut with ``checkpoint()`` (shared checkpoint dir) so the event
    shuffle runs once for all results.  Returns result name -> folder."""
    results = analyze(events, options, materialize=True)
    frames = messages(results, options) if as_messages else results
    written = {}
    for name, df in frames.items():
        path = os.path.join(output_root, name)
        df.write.mode("overwrite").format(fmt).save(path)
        written[name] = path
    return written
