"""Developer-activity analytics expressed as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame: it describes a plan
and starts no job.  Jobs start only in ``sinks``, ``streaming`` and ``plans``.

All event times are ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so that a
comparison with a Parquet timestamp column reaches the scan as a pushed filter.
``session.build_session`` sets the session zone to UTC to match.
"""
