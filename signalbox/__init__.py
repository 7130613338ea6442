"""signalbox: disruption analytics for operational rail event feeds on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so the same code serves batch tables and streaming micro-batches.
No Spark session is created at import time.

Main entry points
  signalbox.sources.feed        read_feed, read_feed_stream, parse_feed_text, quarantine_split, compact_feed
  signalbox.sources.dimensions  load_corpus, load_station_coordinates
  signalbox.operators           transforms, dedup, stats, timeseries, anomaly, station_map
  signalbox.streaming           start_feed_stream, IncrementalClean, IncrementalDetection, start_feed_window_stream
  signalbox.plans               batch_analysis, detection, report (jobs); catalog, oracle (query contract)
  signalbox.session             build_session (local), checkpoint_base, cluster_conf
  python -m signalbox           command-line jobs
"""

__version__ = "0.1.0"
