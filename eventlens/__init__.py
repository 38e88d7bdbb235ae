"""eventlens: profiling nested, ragged JSON event logs on Spark.

Typical use::

    from eventlens.session import get_session
    from eventlens.sources.lines import read_lines
    from eventlens.sources.json_scan import parse_events
    from eventlens.operators.normalize import normalize
    from eventlens.plans.report import report_long

    spark = get_session()
    parsed = parse_events(read_lines(spark, "hdfs:///data/github/*.json.gz"))
    report = report_long(normalize(parsed.where("valid")))

See README.md for the operator map and the command line.
"""

__version__ = "0.1.0"
