"""Command-line entry points for the flows (the job tasks of the project).

    python -m cellwise.plans.cli prepare  [--csv PATH] [--out BASE] [--run-id ID] [--config FILE --env ENV]
    python -m cellwise.plans.cli train    [--base BASE] --model-out PATH --runs-out PATH [--model NAME]
                                          [--run-id ID|latest] [--config FILE --env ENV]
    python -m cellwise.plans.cli validate --runs BASE_OF_RUN_TABLES
    python -m cellwise.plans.cli promote  --runs BASE_OF_RUN_TABLES [--events-out PATH]
    python -m cellwise.plans.cli check    --model PATH --table PATH [--signature JSON]
    python -m cellwise.plans.cli score    --model PATH --in DIR --out DIR --checkpoint DIR

Run tables are Parquet folders under one base path: training appends
``run_metrics``, ``run_params``, ``run_reports``, ``run_confusions``,
``run_lineage``, ``run_signatures``, ``model_versions`` and ``candidates``;
validation writes ``verdicts`` and ``run_tags`` and appends Challenger events
to ``alias_events``; promotion writes ``decisions`` and ``swap_status`` and
appends the swaps.  Without --csv and --out/--base, the paths are those of the
environment in the configuration file.  Results are tables; the commands print
counts and at most SHOWN rows.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

SHOWN = 20


def _spark() -> SparkSession:
    from cellwise.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName("cellwise").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _report(table: DataFrame, by: str) -> dict[str, int]:
    """Print the counts by status and a few rows; the table has them all."""
    counts = {r[by]: r["count"] for r in table.groupBy(by).count().collect()}
    for row in table.limit(SHOWN).collect():
        print(json.dumps(row.asDict(), default=str))
    print(json.dumps({"counts": counts}))
    return counts


def main(argv: list[str] | None = None) -> int:
    from cellwise.config import ProjectConfig
    from cellwise.plans import flows

    ap = argparse.ArgumentParser(prog="cellwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("--csv")
    p.add_argument("--out")
    p.add_argument("--run-id")
    p.add_argument("--config")
    p.add_argument("--env", default="dev")
    t = sub.add_parser("train")
    t.add_argument("--base")
    t.add_argument("--model", default="battery")
    t.add_argument("--model-out", required=True)
    t.add_argument("--runs-out", required=True)
    t.add_argument("--run-id")
    t.add_argument("--params", help="JSON object overriding the boosting parameters")
    t.add_argument("--config")
    t.add_argument("--env", default="dev")
    v = sub.add_parser("validate")
    v.add_argument("--runs", required=True)
    pr = sub.add_parser("promote")
    pr.add_argument("--runs", required=True)
    pr.add_argument("--events-out")
    ck = sub.add_parser("check")
    ck.add_argument("--model", required=True)
    ck.add_argument("--table", required=True)
    ck.add_argument("--signature")
    sc = sub.add_parser("score")
    sc.add_argument("--model", required=True)
    sc.add_argument("--in", dest="in_dir", required=True)
    sc.add_argument("--out", required=True)
    sc.add_argument("--checkpoint", required=True)
    args = ap.parse_args(argv)

    spark = _spark()
    cfg = (ProjectConfig.from_yaml(args.config, args.env) if getattr(args, "config", None)
           else ProjectConfig(env=getattr(args, "env", "dev")))
    root = spark.conf.get("spark.sql.warehouse.dir")
    if args.cmd == "prepare":
        source = args.csv or cfg.input_data_path
        if not source:
            raise SystemExit("no --csv, and the configuration names no input path")
        out = args.out or cfg.table_base(root)
        rid = flows.prepare_flow(spark, source, out, cfg, run_id=args.run_id)
        rejects = spark.read.parquet(f"{out}/rejects").where(f"run_id = '{rid}'").count()
        print(json.dumps({"run_id": rid, "rejected": rejects}))
    elif args.cmd == "train":
        import uuid

        from cellwise.sources.files import save_model

        params = json.loads(args.params) if args.params else None
        res = flows.train_flow(spark, args.base or cfg.table_base(root), cfg, args.run_id, params)
        save_model(res.model, args.model_out)
        model_run = uuid.uuid4().hex
        flows.register_run(spark, args.runs_out, args.model, model_run, res)
        print(json.dumps({"run_id": model_run, **res.metrics.first().asDict()}))
    elif args.cmd == "validate":
        r = args.runs
        verdicts, tags = flows.verdict_flow(spark, r)
        verdicts.write.mode("overwrite").parquet(f"{r}/verdicts")
        tags.write.mode("overwrite").parquet(f"{r}/run_tags")
        events = spark.read.parquet(f"{r}/run_tags").where("alias is not null")
        events.select("model", "alias", "version", "event_seq").write.mode("append").parquet(f"{r}/alias_events")
        return 1 if _report(spark.read.parquet(f"{r}/verdicts"), "status").get("failed") else 0
    elif args.cmd == "promote":
        from cellwise.operators import governance as G

        r = args.runs
        log = flows.read_if_any(spark, f"{r}/alias_events", flows.EVENTS_SCHEMA)
        decisions, events = flows.promotion_flow(
            spark.read.parquet(f"{r}/candidates"), spark.read.parquet(f"{r}/run_metrics"),
            spark.read.parquet(f"{r}/model_versions"), log)
        decisions.write.mode("overwrite").parquet(f"{r}/decisions")
        decided = spark.read.parquet(f"{r}/decisions")
        G.alias_swap_status(decided, log).write.mode("overwrite").parquet(f"{r}/swap_status")
        G.alias_swap_events(decided, log).write.mode("append").parquet(args.events_out or f"{r}/alias_events")
        _report(decided, "status")
    elif args.cmd == "check":
        from cellwise.config import EV_CAT_FEATURES, EV_NUM_FEATURES

        types = {**{c: "double" for c in EV_NUM_FEATURES}, "Charging_Cycles": "bigint",
                 **{c: "string" for c in EV_CAT_FEATURES}}
        found = flows.deployability_check(spark, args.model, args.table, types, args.signature)
        print(json.dumps({"scored": found.count()}))
    elif args.cmd == "score":
        from cellwise.config import EV_CAT_FEATURES, EV_NUM_FEATURES
        from cellwise.sources.files import load_model
        from cellwise.streaming.scoring import score_stream

        types = {**{c: "double" for c in EV_NUM_FEATURES}, "Charging_Cycles": "bigint",
                 **{c: "string" for c in EV_CAT_FEATURES}}
        score_stream(spark, args.in_dir, args.out, args.checkpoint, load_model(args.model), types)
    return 0


if __name__ == "__main__":
    sys.exit(main())
