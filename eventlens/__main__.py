"""Command line: ``python -m eventlens <command> ...`` (spark-submit works too).

  profile   --input P --output D   three full rankings as JSON dirs
                                   (top_projects, top_users, languages)
  report    --input P --output D   every ranking (long form), counters,
                                   repo x type matrix, headline and the
                                   quarantined lines as JSON
  keyvalue  --input P --output D   key<TAB>value counts (U1 + A11), key order
  counts    --input P --output D   a key<TAB>value file, ours or a foreign one,
                                   decoded and summed per key, as JSON
  publish   --input P --output U   copy the dataset to a lake path (text or
                                   --format parquet for the normalized table);
                                   readers see the old version until it is whole
  schema    --input P --output D   merged schema (printed) and path
                                   profile as JSON
  preview   --input P [--n 20]     first events, normalized (P5)

``--input`` accepts files, directories, published datasets, globs and
comma-separated lists (gzip is decoded).  ``--hours DAY:H0-H1 --input BASE``
reads hourly dumps ``BASE/DAY-H.json.gz``: a damaged one gives what it can and
is noted in the printed status (and in ``OUTPUT/hours`` of a report); with
``--cap N`` hours are read in order until there are N lines or one is damaged.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from eventlens.session import clear_scratch


def _lines(spark: SparkSession, args) -> tuple[DataFrame, DataFrame | None]:
    """The input's lines, and the status of its files where it is hourly dumps."""
    from eventlens.sinks import published_path
    from eventlens.sources import hours as H
    from eventlens.sources.lines import read_lines

    if not args.hours:
        return read_lines(spark, [published_path(spark, p) for p in args.input.split(",")]), None
    day, span = args.hours.split(":")
    lo, hi = (int(x) for x in span.split("-"))
    hours = range(lo, hi + 1)
    if args.cap is not None:
        got = H.capped_ingest(spark, args.input, day, hours, args.cap)
        print(f"{got.events} events of hours {got.hours}" + ("" if got.failed is None else f"; hour {got.failed} is damaged"))
        return got.lines.select("value"), None
    status = H.status_of(H.read_hours(spark, args.input, day, hours, content="status"))
    for r in status.orderBy("day", "hour").collect():
        print(f"{r['day']}-{r['hour']}: {r['rows']} lines, {r['file_bytes']} bytes, {r['error'] or 'complete'}")
    return H.lines_of(H.read_hours(spark, args.input, day, hours)).select("value"), status


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="eventlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("profile", "report", "keyvalue", "counts", "publish", "schema", "preview"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--hours", help="DAY:H0-H1, read BASE/DAY-H.json.gz")
        s.add_argument("--cap", type=int, help="with --hours: so many lines, in order of hour")
        s.add_argument("--partitions", type=int, help="spread few input files over so many parse tasks")
        if name != "preview":
            s.add_argument("--output", required=True)
        if name == "publish":
            s.add_argument("--format", default="text", choices=["text", "parquet"])
        if name == "preview":
            s.add_argument("--n", type=int, default=20)
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)

    from eventlens.operators import aggregates as A
    from eventlens.operators.normalize import normalize, write_silver
    from eventlens.operators.ranking import full_ranking, leader_headline
    from eventlens.plans import report as R
    from eventlens.session import get_session
    from eventlens.sinks import publish, read_keyvalue, write_json_dir, write_keyvalue, write_report
    from eventlens.sources.adapter import spread
    from eventlens.sources.json_scan import parse_events

    spark = get_session(args.master)
    if args.cmd == "counts":
        write_json_dir(read_keyvalue(spark, args.input), args.output)
        return
    lines, status = _lines(spark, args)
    lines = spread(lines, args.partitions)
    parsed = parse_events(lines)
    silver = normalize(parsed.where("valid"))

    if args.cmd == "profile":
        out = args.output.rstrip("/")
        full_ranking(A.pushes_per_repo(silver)).write.mode("overwrite").json(f"{out}/top_projects")
        full_ranking(A.events_per_user(silver)).write.mode("overwrite").json(f"{out}/top_users")
        full_ranking(A.events_per_language(silver)).write.mode("overwrite").json(f"{out}/languages")
    elif args.cmd == "report":
        from eventlens.session import materialize, release
        from eventlens.sources.json_scan import quarantine

        out = args.output.rstrip("/")
        # parse once: every line normalized with its valid flag, read by all outputs
        rows = materialize(normalize(parsed, keep=["valid"]), "cli-rows")
        silver = rows.where("valid").drop("valid")
        metrics = A.report_metrics(silver)
        write_report(R.report_from_metrics(metrics), f"{out}/report")
        A.counters_from_normalized(rows).write.mode("overwrite").json(f"{out}/counters")
        A.repo_type_matrix(silver).write.mode("overwrite").json(f"{out}/repo_type_matrix")
        leader_headline(spark.read.json(f"{out}/report"), spark.read.json(f"{out}/counters")).write.mode(
            "overwrite").json(f"{out}/headline")
        release(rows)
        if status is not None:
            write_json_dir(status, f"{out}/hours")
        quarantine(lines).write.mode("overwrite").json(f"{out}/quarantine")
    elif args.cmd == "keyvalue":
        write_keyvalue(A.metrics_long(silver), args.output, sort=True)
    elif args.cmd == "publish":
        if args.format == "parquet":
            write_silver(silver, args.output)
        else:
            print(publish(lines, args.output, "text"))
    elif args.cmd == "schema":
        from eventlens.operators.schema_profile import infer_schema, schema_profile

        print(infer_schema(lines).first()["schema"])
        schema_profile(lines).orderBy("path").write.mode("overwrite").json(args.output)
    elif args.cmd == "preview":
        from eventlens.operators.quality import preview

        preview(parsed.where("valid"), args.n).show(args.n, False)


if __name__ == "__main__":
    try:
        main()
    finally:
        if session := SparkSession.getActiveSession():
            clear_scratch(session)
