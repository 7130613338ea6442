"""Command-line jobs: ``python -m signalbox <command> ...`` (or via spark-submit).

Commands
  compact        rewrite landed message files (multi-line JSON) as nested Parquet
  batch          parse message files, print the statistics, optionally write the fact tables
  fold           rewrite the batch folders of closed days as one sorted set of files
  stream         run the feed stream into the fact tables, with optional detection per batch
  detect         detect anomalies over the fact tables and publish a new snapshot
  report         compute the dashboard frames and write each as a table
  charts         compute the chart frames and write each as a table
  window-stream  run the watermarked window aggregate over CSV event files or the feed
"""

from __future__ import annotations

import argparse
import datetime

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from signalbox.session import REQUIRED_CONF


def _session(spark: SparkSession | None) -> SparkSession:
    if spark is None:
        spark = SparkSession.builder.appName("signalbox").getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def _dimension(spark, corpus):
    from signalbox.operators.joins import row_bound
    from signalbox.sources.dimensions import load_corpus

    dim = load_corpus(spark, corpus).persist(StorageLevel.MEMORY_AND_DISK)
    return dim, row_bound(dim)


def cmd_compact(spark, a):
    from signalbox.sources.feed import compact_feed

    compact_feed(spark, a.feed, a.out, a.mode)


def cmd_batch(spark, a):
    from signalbox.plans.batch_analysis import run_batch_analysis
    from signalbox.sinks.writers import ParquetFactSink
    from signalbox.sources.feed import read_feed

    dim, _ = _dimension(spark, a.corpus)
    sink = ParquetFactSink(a.tables) if a.tables else None
    results = run_batch_analysis(read_feed(spark, a.feed), dim, sink=sink, batch_id=a.batch_id)
    for name, df in results.items():
        print(f"== {name}")
        df.show(a.show, truncate=False)
    return results


def cmd_stream(spark, a):
    from signalbox.plans.detection import run_detection
    from signalbox.sinks.writers import ParquetFactSink
    from signalbox.streaming.admission import BatchCounts
    from signalbox.streaming.detection import IncrementalDetection
    from signalbox.streaming.micro_batch import run_until_stopped, start_feed_stream

    from signalbox.streaming.clean import IncrementalClean
    from signalbox.streaming.late_windows import FeedEvents, LateWindows

    dim, dim_rows = _dimension(spark, a.corpus)
    sink = ParquetFactSink(a.tables)
    clean = IncrementalClean(spark, sink, a.clean) if a.clean else None
    after = None
    if a.detect == "incremental":
        after = IncrementalDetection(spark, sink, a.anomalies, dim_rows, clean=clean)
    elif a.detect == "full":
        def after(batch_id):
            run_detection(spark, sink, a.anomalies, dim_rows)
    if clean is not None:
        clean.then, after = after, clean
        if a.windows:
            clean.then = LateWindows(spark, FeedEvents(clean), a.windows, a.watermark, then=clean.then)
    trigger = {"availableNow": True} if a.available_now else None
    counts = BatchCounts(spark, a.counts, a.feed) if a.counts else None
    query = start_feed_stream(spark, a.feed, a.checkpoint, dim, sink, dim_rows, after, trigger, a.max_files,
                              quarantine=a.quarantine, max_bytes_per_trigger=a.max_bytes, archive=a.archive,
                              counts=counts)
    run_until_stopped(query)
    if hasattr(after, "catch_up"):
        after.catch_up()
    return query


def cmd_fold(spark, a):
    from signalbox.sinks.writers import ParquetFactSink

    ParquetFactSink(a.tables).fold_days(spark, a.before, a.through, a.grace_hours * 3600)


def cmd_detect(spark, a):
    from signalbox.plans.detection import run_detection
    from signalbox.sinks.writers import ParquetFactSink

    return run_detection(spark, ParquetFactSink(a.tables), a.anomalies)


def _anomalies(spark, a):
    from signalbox.sinks.writers import read_snapshot
    from signalbox.streaming.detection import read_incremental_anomalies

    return read_incremental_anomalies(spark, a.anomalies) if a.incremental else read_snapshot(spark, a.anomalies)


def cmd_report(spark, a):
    from signalbox.plans.report import build_report, write_report
    from signalbox.sinks.writers import ParquetFactSink
    from signalbox.sources.dimensions import load_station_coordinates

    sink = ParquetFactSink(a.tables)
    frames = build_report(sink.read_movements(spark), sink.read_cancellations(spark), _anomalies(spark, a),
                          load_station_coordinates(spark, a.coords), bucket=a.bucket, abnormal_min=a.min_abnormal)
    write_report(frames, a.out)
    return frames


def cmd_charts(spark, a):
    from signalbox.plans.report import chart_report, write_report
    from signalbox.sinks.writers import ParquetFactSink

    sink = ParquetFactSink(a.tables)
    frames = chart_report(sink.read_movements(spark), sink.read_cancellations(spark))
    write_report(frames, a.out)
    return frames


def cmd_window_stream(spark, a):
    from signalbox.sources.tables import read_window_events_stream
    from signalbox.streaming.late_windows import EventFacts, LateWindows, start_event_landing
    from signalbox.streaming.micro_batch import run_until_stopped
    from signalbox.streaming.window_stream import (
        start_feed_window_stream,
        start_window_stats_stream,
        window_events_from_csv,
    )

    trigger = {"availableNow": True} if a.available_now else None
    if a.feed:
        dim, dim_rows = _dimension(spark, a.corpus)
        query = start_feed_window_stream(spark, a.feed, dim, a.out, a.checkpoint, dim_rows, a.watermark,
                                         trigger=trigger, max_files_per_trigger=a.max_files or 10)
    else:
        events = window_events_from_csv(spark, read_window_events_stream(spark, a.input, a.max_files))
        query = start_window_stats_stream(events, a.out, a.checkpoint, a.watermark, trigger=trigger)
        if a.facts:
            facts = EventFacts(spark, a.facts)
            landing = start_event_landing(events, facts, f"{a.checkpoint.rstrip('/')}-facts",
                                          LateWindows(spark, facts, a.out, a.watermark), trigger)
            run_until_stopped(query)
            run_until_stopped(landing)
            return query
    run_until_stopped(query)
    return query


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="signalbox", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    k = sub.add_parser("compact")
    k.add_argument("--feed", required=True, help="folder of message files (*.json)")
    k.add_argument("--out", required=True, help="Parquet folder")
    k.add_argument("--mode", choices=["append", "overwrite"], default="append")
    k.set_defaults(run=cmd_compact)

    b = sub.add_parser("batch")
    b.add_argument("--feed", required=True, help="folder of message files (*.json)")
    b.add_argument("--corpus", required=True, help="location reference file")
    b.add_argument("--tables", help="write fact tables under this folder")
    b.add_argument("--batch-id", type=int, default=0)
    b.add_argument("--show", type=int, default=20)
    b.set_defaults(run=cmd_batch)

    s = sub.add_parser("stream")
    s.add_argument("--feed", required=True)
    s.add_argument("--corpus", required=True)
    s.add_argument("--tables", required=True)
    s.add_argument("--checkpoint", required=True, help="shared folder for stream progress")
    s.add_argument("--clean", help="maintain deduplicated tables here (read by incremental detection)")
    s.add_argument("--quarantine", help="keep texts that are not messages here, with their file")
    s.add_argument("--windows", help="table of a window-stream on the same feed: count windows of late rows anew "
                                     "(needs --clean)")
    s.add_argument("--watermark", default="1 hour", help="the window-stream's watermark (with --windows)")
    s.add_argument("--detect", choices=["none", "incremental", "full"], default="incremental")
    s.add_argument("--anomalies", help="anomaly table folder (needed unless --detect none)")
    s.add_argument("--max-files", type=int, default=10)
    s.add_argument("--max-bytes", type=int, help="bytes of message files per trigger, in place of --max-files")
    s.add_argument("--archive", help="move the files of committed batches here (outside the feed folder)")
    s.add_argument("--counts", help="check messages in against rows out of each batch, and keep the counts here")
    s.add_argument("--available-now", action="store_true", help="drain the folder and stop")
    s.set_defaults(run=cmd_stream)

    f = sub.add_parser("fold")
    f.add_argument("--tables", required=True)
    f.add_argument("--before", required=True, type=datetime.date.fromisoformat, help="fold the days before this one")
    f.add_argument("--through", type=int, help="last batch to fold (default: the last but one)")
    f.add_argument("--grace-hours", type=float, default=24, help="batch folders stay this long after their fold")
    f.set_defaults(run=cmd_fold)

    d = sub.add_parser("detect")
    d.add_argument("--tables", required=True)
    d.add_argument("--anomalies", required=True)
    d.set_defaults(run=cmd_detect)

    r = sub.add_parser("report")
    r.add_argument("--tables", required=True)
    r.add_argument("--anomalies", required=True)
    r.add_argument("--incremental", action="store_true", help="anomalies written by the stream's incremental step")
    r.add_argument("--coords", required=True, help="station coordinate file")
    r.add_argument("--out", required=True)
    r.add_argument("--bucket", choices=["10min", "1h", "1D"], default="1h")
    r.add_argument("--min-abnormal", type=int, default=3)
    r.set_defaults(run=cmd_report)

    c = sub.add_parser("charts")
    c.add_argument("--tables", required=True)
    c.add_argument("--out", required=True)
    c.set_defaults(run=cmd_charts)

    w = sub.add_parser("window-stream")
    src = w.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="folder of CSV event files")
    src.add_argument("--feed", help="folder of message files (*.json); needs --corpus")
    w.add_argument("--corpus", help="location reference file (with --feed)")
    w.add_argument("--out", required=True)
    w.add_argument("--facts", help="land the events here (with --input) and count windows of late rows anew")
    w.add_argument("--checkpoint", required=True)
    w.add_argument("--watermark", default="1 hour")
    w.add_argument("--max-files", type=int)
    w.add_argument("--available-now", action="store_true")
    w.set_defaults(run=cmd_window_stream)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    if getattr(args, "detect", "none") != "none" and args.command == "stream" and not args.anomalies:
        parser().error("--anomalies is required unless --detect none")
    if args.command == "stream" and args.windows and not args.clean:
        parser().error("--windows needs --clean")
    if args.command == "window-stream" and args.feed and not args.corpus:
        parser().error("--corpus is required with --feed")
    return args.run(_session(spark), args)
