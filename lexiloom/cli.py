"""Command line: python -m lexiloom.cli <stage> --config FILE --backend MODULE:NAME."""

from __future__ import annotations

import argparse
import importlib
import json

from lexiloom.operators import cost
from lexiloom.plans import stages
from lexiloom.session import session
from lexiloom.sources import config as configs
from lexiloom.sources import versions, writers


NO_MODEL = ("assemble", "review", "costs", "preview")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexiloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("translate", "judge", "correct", "recorrect", "assemble", "review", "costs", "run", "preview"):
        s = sub.add_parser(name)
        s.add_argument("--config", required=True)
        if name not in NO_MODEL:
            s.add_argument("--backend", required=True, metavar="MODULE:NAME", help="a pandas iterator function for mapInPandas, or operators.calls.Calls of single requests")
        s.add_argument("--output-root")
        s.add_argument("--mode", choices=configs.MODES)
        s.add_argument("--model")
        s.add_argument("--split", nargs="*")
        s.add_argument("--dataset-config", nargs="*")
        if name in ("translate", "run", "assemble"):
            s.add_argument("--limit", type=int, default=0)
        if name in ("judge", "correct"):
            s.add_argument("--round", type=int, default=1)
            s.add_argument("--input", help="table of records; by default that of the stage before")
        if name in ("assemble", "review"):
            s.add_argument("--input", nargs="*", help="stage folders to read, such as correct_r1; by default all")
        if name in ("assemble", "run"):
            s.add_argument("--destination", choices=("local", "huggingface"))
        if name == "run":
            s.add_argument("--rounds", type=int, default=1)
            s.add_argument("--stages", default="translate,judge,correct,assemble")
        if name == "recorrect":
            s.add_argument("--threshold", type=float, required=True)
            s.add_argument("--include-recorrected", action="store_true")
            s.add_argument("--correct-round", type=int)
            s.add_argument("--judge-round", type=int)
            s.add_argument("--skip-judge", action="store_true")
            s.add_argument("--dry-run", action="store_true")
        if name == "review":
            s.add_argument("--sample-rate", type=float)
            s.add_argument("--seed", "--sample-seed", dest="sample_seed")
            s.add_argument("--fail-threshold", type=float)
            s.add_argument("--queue-only", action="store_true")
            for flag, key in (("--csv-all", "csv_all_rows"), ("--prefer-best-translation", "prefer_best_translation"), ("--queue-regressions", "queue_regressions")):
                s.add_argument(flag, dest=key, action="store_true", default=None)
        if name == "costs":
            s.add_argument("--reprice", action="store_const", const="force", dest="policy", default="gaps")
            s.add_argument("--no-reprice", action="store_const", const="off", dest="policy")
        if name == "preview":
            s.add_argument("--stage", choices=configs.STAGES, default="translate")
    return p


def _run(args: argparse.Namespace) -> stages.Run:
    c = configs.load(args.config)
    if args.output_root:
        c.output.root = args.output_root
    for s in c.stages.values():
        s.inference.mode = args.mode or s.inference.mode
        s.model = args.model or s.model
    if getattr(args, "destination", None):
        c.output.destination = args.destination
    for key in ("sample_rate", "sample_seed", "fail_threshold", "csv_all_rows", "prefer_best_translation", "queue_regressions"):
        if getattr(args, key, None) is not None:
            setattr(c.review, key, getattr(args, key))
    configs.check(c)
    c.units = c.select_units(args.dataset_config, args.split)
    only = [(u.config, u.split) for u in c.units] if args.dataset_config or args.split else None
    if args.command in NO_MODEL:
        return stages.Run(session(), c, {}, only=only)
    module, _, name = args.backend.partition(":")
    backend = getattr(importlib.import_module(module), name)
    return stages.Run(session(), c, {m: backend for m in configs.MODES}, only=only)


def _assemble(run: stages.Run, names: list[str] | None = None, limit: int = 0) -> None:
    if run.config.output.destination != "local":
        raise configs.ConfigError("only the local destination is supported; push the final folder with a tool of the hub")
    for unit in run.config.units:
        wide, lost = stages.assemble(run, unit, names)
        writers.write_final(wide.where(f"row_index < {limit}") if limit else wide, f"{run.root}/final/{unit.label}", run.config.output.format)
        lost.write.mode("overwrite").json(f"{run.root}/missing/{unit.label}")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    run = _run(args)
    read = lambda stage, n: versions.read(run.spark, args.input) if args.input else run.table(stage, n)
    if args.command == "translate":
        stages.translate(run, limit=args.limit)
    elif args.command == "judge":
        stages.judge(run, read("correct", args.round - 1) if args.round > 1 else read("translate", 0), args.round, part=bool(args.input))
    elif args.command == "correct":
        stages.correct(run, read("judge", args.round), args.round, part=bool(args.input))
    elif args.command == "recorrect":
        print(json.dumps(stages.recorrect(run, args.threshold, args.include_recorrected, args.dry_run, args.correct_round, args.judge_round, args.skip_judge)))
    elif args.command == "assemble":
        _assemble(run, args.input, args.limit)
    elif args.command == "review":
        print(json.dumps(stages.write_review(run, args.queue_only, args.input)))
    elif args.command == "costs":
        rolled = stages.costs(run, args.policy)
        writers.write_jsonl(rolled.orderBy("level", "key"), f"{run.root}/costs", files=1)
        for line in cost.report_lines(rolled).orderBy("level", "key").toLocalIterator():
            print(line["line"])
    elif args.command == "run":
        chosen = tuple(args.stages.split(","))
        stages.chain(run, args.rounds, chosen, args.limit)
        if "assemble" in chosen:
            _assemble(run, None, args.limit)
    else:
        for unit in run.config.units:
            text, unfilled = stages.preview(run, unit, args.stage)
            print(text, "\nunfilled:", unfilled)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
