"""The whole selection-and-batching run as one Spark job (the original driver script, minus
transport): select, number into folders, write the manifest, reconcile with what landed, write
the log and the outcome summary.

    python -m slipflow.plans.job --registry /data/registry --out /data/run-2021-08-04 \\
        [--landing /data/landing] [--folder-size 300] [--inception-after 2021-07-01] ...

``--registry`` is a folder holding one Parquet dataset per registry table (see
``sources.registry.load_parquet``), or ``name=folder``; it may be given several times, and the
selections of all registries are then appended before batching. JDBC deployments build the
registries with ``sources.registry.load_jdbc`` and call ``run`` directly.

With ``--sql query.sql`` (and ``--param name=value`` for each of its markers) the job runs that SQL
text over the views of the registry instead and writes the result to ``out/result``; with several
registries their views are named ``{name}_{table}``.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE, SelectionConfig
from ..operators import manifest, reconcile, selection
from ..operators.priority import registry_row_bound
from ..session import ensure_checkpoint_dir
from ..sources.inventory import landed_inventory
from ..sources.listing import list_landed
from ..sources.registry import Registry, load_parquet
from ..sources.views import parse_param, register_views, run_sql
from .publish import run_and_publish, write_departments


def run(spark: SparkSession, reg: Registry | list[Registry], cfg: SelectionConfig, out_dir: str, *,
        landing_root: str | None = None, run_time: _dt.datetime | None = None,
        listing: str = "tasks") -> dict[str, DataFrame]:
    """Run every step, for one registry or the appended selections of several, and write the
    outputs under ``out_dir``:

    - ``selected/``: the selected documents (24 columns, and ``Source`` with several registries),
      in the original result order;
    - ``manifest/``: the batch manifest, partitioned by the department's key, clustered by folder;
    - ``status/`` and ``summary/`` (with ``landing_root``): OK / FILE NOT FOUND per document and
      counts per department; without a landing root every document is reported as not found;
    - ``" {stamp}.txt"``: the run log as text (part files in order), named by the run stamp;
    - ``rejected/``: rows that need a look, with a reason.

    ``listing``: files below the landing root are listed in tasks (``sources.listing``), or by
    Spark's file index ("index"), for stores that only Spark's readers reach.

    Returns the written outputs read back as DataFrames.
    """
    ensure_checkpoint_dir(spark)
    run_time = run_time or _dt.datetime.now()
    base = out_dir.rstrip("/")

    regs = reg if isinstance(reg, list) else [reg]
    selections = [selection.selected_documents(r, cfg, ordered=False) for r in regs]
    picked = selections[0] if len(regs) == 1 else selection.registry_union(selections, [r.source for r in regs])
    picked.orderBy(*selection.result_order()).write.mode("overwrite").parquet(f"{base}/selected")
    selected = spark.read.schema(picked.schema).parquet(f"{base}/selected")

    man = manifest.batch_manifest(selected, cfg.folder_size,
                                  max_rows=sum(registry_row_bound(r, cfg) for r in regs))
    laid = manifest.sink_layout(man)
    write_departments(laid, f"{base}/manifest")
    man = spark.read.schema(laid.schema).parquet(f"{base}/manifest")

    if landing_root:
        inventory = (list_landed if listing == "tasks" else landed_inventory)(spark, landing_root)
    else:
        inventory = man.select("landing_path").where(F.lit(False))
    status = reconcile.fetch_status(man, inventory)
    plan = status.drop("department_key")
    plan.write.mode("overwrite").parquet(f"{base}/status")
    status = spark.read.schema(plan.schema).parquet(f"{base}/status")
    reconcile.fetch_summary(status).write.mode("overwrite").parquet(f"{base}/summary")

    log = reconcile.run_log_lines(status, run_time)
    log_path = f"{base}/ {run_time.strftime('%d-%m-%y %H%p')}.txt"
    reconcile.write_run_log(log, log_path)
    manifest.rejected_rows(man).write.mode("overwrite").parquet(f"{base}/rejected")

    return {"selected": selected, "manifest": man, "status": status} | {
        name: spark.read.parquet(f"{base}/{name}") for name in ("summary", "rejected")} | {
        "log": spark.read.text(log_path)}


# The outputs of ``run`` that a publication needs whole, and the one it has with a landing root or not.
OUTPUTS = ["selected", "manifest", "status", "summary", "rejected"]


def run_published(spark: SparkSession, reg: Registry | list[Registry], cfg: SelectionConfig, base: str,
                  run_id: str, **options) -> str:
    """``run`` into a folder of its own below ``base``, published by the pointer there when every
    output is complete (``plans.publish``). Returns the folder."""
    def write(folder: str) -> list[str]:
        run(spark, reg, cfg, folder, **options)
        return OUTPUTS
    return run_and_publish(spark, base, run_id, write)


def _date(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--registry", required=True, action="append",
                    help="folder with one Parquet dataset per table, or name=folder; may be repeated")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--run-id", help="write below out/runs/ID and publish the run by out/CURRENT")
    ap.add_argument("--landing", help="landing root to reconcile against (optional)")
    ap.add_argument("--listing", choices=["tasks", "index"], default="tasks",
                    help="how landed files are listed: in tasks, or by Spark's file index")
    ap.add_argument("--folder-size", type=int, default=REFERENCE.folder_size)
    ap.add_argument("--inception-after", type=_date, default=REFERENCE.inception_after)
    ap.add_argument("--created-before", type=_dt.datetime.fromisoformat, default=REFERENCE.created_before)
    ap.add_argument("--path-separator", default=REFERENCE.path_separator)
    ap.add_argument("--case-sensitive", action="store_true")
    ap.add_argument("--match-policy-refs", action="store_true")
    ap.add_argument("--sql", help="file with SQL text to run over the registry's views instead")
    ap.add_argument("--param", action="append", default=[], help="name=value of a marker of the SQL text")
    args = ap.parse_args(argv)
    cfg = REFERENCE.with_(folder_size=args.folder_size, inception_after=args.inception_after,
                          created_before=args.created_before, path_separator=args.path_separator,
                          case_sensitive=args.case_sensitive, match_policy_refs=args.match_policy_refs)
    spark = SparkSession.builder.appName("slipflow-job").getOrCreate()
    named = [r.split("=", 1) if "=" in r else (f"registry_{i}", r) for i, r in enumerate(args.registry)]
    regs = [load_parquet(spark, folder, source=name) for name, folder in named]
    if args.sql:
        for reg in regs:
            register_views(reg, "" if len(regs) == 1 else f"{reg.source}_")
        text = spark.read.text(args.sql, wholetext=True).first()[0]
        run_sql(spark, text, dict(map(parse_param, args.param))).write.mode("overwrite").parquet(
            f"{args.out.rstrip('/')}/result")
        return
    if args.run_id:
        run_published(spark, regs, cfg, args.out, args.run_id, landing_root=args.landing, listing=args.listing)
    else:
        run(spark, regs, cfg, args.out, landing_root=args.landing, listing=args.listing)


if __name__ == "__main__":
    main()
