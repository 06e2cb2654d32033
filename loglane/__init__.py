"""loglane: log ingest and day-close analytics on Spark.

Main entry points (all DataFrame -> DataFrame unless noted):

* ``operators.access_log``: ``cid_filter``, ``login_key``, ``parse_strict``,
  ``parse_labelled``, ``split_by_length``
* ``operators.app_log``: ``parse_app_log``, ``type_app_log``, ``valid_rows``,
  ``reject_rows``
* ``operators.orders``: ``encode_orders``, ``decode_orders``
* ``operators.eod``: ``trade_lines``, ``trade_ips``, ``trade_ip_logins``,
  ``apply_flags``, ``flag_counts``, ``scan_summary``
* ``operators.offsets``: ``topic_catalog``, ``partition_offsets``,
  ``consumer_lag``, ``lag_totals``, ``key_partition``
* ``sources.files``: ``read_day_file``, ``read_lines``, ``landing_stream``
* ``streaming.ingest`` / ``streaming.produce``: streaming consumers and
  producer-side records
* ``plans.eod_job.close_day`` (a job), ``plans.batch_load``,
  ``plans.tables``
* ``session.build_session``: a session with the settings used here
"""

__version__ = "0.1.0"
