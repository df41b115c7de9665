"""Command line for the three steps of the pipeline.

  python -m pitwall collect  --laps L --weather W --out DIR [--csv]
  python -m pitwall features --laps L [--sheet CSV --year Y --round R] --out DIR
  python -m pitwall train    --features DIR --target lap_time|position [--sheet CSV] [--aliases CSV]

Inputs are Parquet folders (or CSV with --csv for the collected laps); every
step runs on the session's cluster, outputs are partitioned Parquet.
"""

from __future__ import annotations

import argparse
import json


def _spark():
    from pitwall.session import get_spark

    return get_spark()


def cmd_collect(args) -> None:
    from pitwall.plans.collection import lap_records, load_report

    spark = _spark()
    laps = spark.read.parquet(args.laps)
    weather = spark.read.parquet(args.weather)
    records = lap_records(laps, weather)
    if args.csv:
        records.write.mode("overwrite").option("header", True).csv(args.out)
    else:
        records.write.mode("overwrite").partitionBy("year", "round").parquet(args.out)
    report = load_report(laps, args.start_year, args.end_year)
    print(json.dumps({"sessions_loaded": report.filter("loaded").count(), "sessions_tried": report.count()}))


def cmd_features(args) -> None:
    from pitwall.plans.features import driver_race_features
    from pitwall.sources.io import FEED_LAP_SCHEMA, read_laps_csv, read_sheet_csv, write_features

    spark = _spark()
    if args.laps_csv:
        laps, rejects = read_laps_csv(spark, args.laps, FEED_LAP_SCHEMA, args.multi_line)
        print(json.dumps({"rejected_lines": rejects.count()}))
    else:
        laps = spark.read.parquet(args.laps)
    sheet = read_sheet_csv(spark, args.sheet) if args.sheet else None
    aliases = read_sheet_csv(spark, args.aliases) if args.aliases else None
    feats = driver_race_features(
        laps, sheet=sheet, year=args.year, round_=args.round, prior_only=args.prior_only, aliases=aliases
    )
    write_features(feats, args.out)
    print(json.dumps({"columns": feats.columns}))
    if sheet is not None:
        print_unmatched(sheet, laps, aliases)


def print_unmatched(sheet, known, aliases) -> None:
    """Names of a sheet that no driver key stands for (a sheet has one row per driver)."""
    from pitwall.operators.quali import apply_driver_aliases, unmatched_drivers
    from pitwall.plans.inference import sheet_inputs

    drivers = sheet_inputs(sheet).select("driver")
    drivers = apply_driver_aliases(drivers, aliases) if aliases is not None else drivers
    missing = sorted(str(r.driver) for r in unmatched_drivers(drivers, known).collect())
    if missing:
        print(json.dumps({"drivers_without_laps": missing}))


def cmd_train(args) -> None:
    from pitwall.operators.clean import LAP_TIME_TARGET, POSITION_TARGET
    from pitwall.plans import inference, training
    from pitwall.sources.io import read_sheet_csv

    spark = _spark()
    feats = spark.read.parquet(args.features)
    target = LAP_TIME_TARGET if args.target == "lap_time" else POSITION_TARGET
    ts = training.prepare(feats, target, feature_set=args.feature_set)
    board, paths = training.leaderboard(ts)
    for row in board.orderBy("mae").collect():
        print(json.dumps(row.asDict()))
    if args.sheet:
        best = training.best_model(board)
        model, meta = training.load_model(spark, paths[best])
        sheet = read_sheet_csv(spark, args.sheet)
        aliases = read_sheet_csv(spark, args.aliases) if args.aliases else None
        print_unmatched(sheet, feats, aliases)
        if args.target == "lap_time":
            out = inference.predict_race_time(model, meta, sheet, feats, aliases).orderBy("pred_race_pos")
        else:
            out = inference.predict_position(model, meta, sheet, feats, aliases).orderBy("pred_final_position")
        out.show(truncate=False)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="pitwall")
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("collect", help="accurate laps + nearest weather -> lap records")
    c.add_argument("--laps", required=True)
    c.add_argument("--weather", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--csv", action="store_true", help="write CSV instead of Parquet")
    c.add_argument("--start-year", type=int, default=None)
    c.add_argument("--end-year", type=int, default=None)
    c.set_defaults(fn=cmd_collect)

    f = sub.add_parser("features", help="lap records -> one row per driver-race")
    f.add_argument("--laps", required=True)
    f.add_argument("--laps-csv", action="store_true", help="laps are CSV with the raw schema")
    f.add_argument("--multi-line", action="store_true", help="CSV cells may hold line ends")
    f.add_argument("--aliases", default=None, help="CSV of sheet names and driver keys (name,driver)")
    f.add_argument("--sheet", default=None, help="qualifying sheet CSV for the current race")
    f.add_argument("--year", type=int, default=None)
    f.add_argument("--round", type=int, default=None)
    f.add_argument("--prior-only", action="store_true", help="season trends from earlier rounds only")
    f.add_argument("--out", required=True)
    f.set_defaults(fn=cmd_features)

    t = sub.add_parser("train", help="fit, compare and (with --sheet) predict")
    t.add_argument("--features", required=True)
    t.add_argument("--target", choices=["lap_time", "position"], default="lap_time")
    t.add_argument("--feature-set", choices=["prerace", "all"], default="prerace")
    t.add_argument("--sheet", default=None)
    t.add_argument("--aliases", default=None, help="CSV of sheet names and driver keys (name,driver)")
    t.set_defaults(fn=cmd_train)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
