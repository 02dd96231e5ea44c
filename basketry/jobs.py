"""Command-line jobs: segment customers, sweep k, train and score a horizon model, report how early a segment shows.

With the repository installed or zipped (``zip -r basketry.zip basketry``):

    spark-submit --py-files basketry.zip basketry/jobs.py segment --lines L --out O
    python -m basketry.jobs sweep          --customers O/customers --out O/sweep
    python -m basketry.jobs profile        --customers O/customers --out O/profile
    python -m basketry.jobs prepare        --lines O/lines --customers O/customers --out O/prepared
    python -m basketry.jobs first-purchase --lines O/lines --customers O/customers --out F
    python -m basketry.jobs baselines      --lines O/lines --customers O/customers --out B
    python -m basketry.jobs horizons       --lines O/lines --customers O/customers --ref 2011-12-09 --out H
    python -m basketry.jobs train          --lines O/lines --customers O/customers --ref 2011-12-09 --models M
    python -m basketry.jobs score          --lines O/lines --customers O/customers --ref 2011-12-09 --models M --out S

``--format csv`` reads the raw lines as CSV; all tables written are parquet.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from basketry.materialize import checkpointed
from basketry.operators.baskets import prepare_lines
from basketry.operators.classifiers import KNN_GRID, save_bundle
from basketry.operators.cleaning import HOME_COUNTRY
from basketry.operators.clustering import k_sweep, segment_means, segment_population, segment_sums
from basketry.operators.features import assemble_features, first_basket_features
from basketry.plans.prediction import compare_baselines, first_purchase_model, horizon_model, horizon_sweep
from basketry.plans.scoring import batch_score
from basketry.plans.segmentation import segment_customers
from basketry.schema import (
    CLEAN_LINES, CUSTOMER_NUMERIC, CUSTOMERS, FIRST_BASKET_COLUMNS, HORIZON_COLUMNS, LINES, MONTH_COLUMNS, PREPARED_LINES, SEED,
)
from basketry.sources.files import read_table, write_table

JOBS = ("segment", "sweep", "profile", "prepare", "first-purchase", "baselines", "horizons", "train", "score")


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in JOBS:
        job = jobs.add_parser(name)
        job.add_argument("--seed", type=int, default=SEED)
        if name not in ("sweep", "profile"):
            job.add_argument("--lines", required=True)
        if name != "segment":
            job.add_argument("--customers", required=True)
        if name != "train":
            job.add_argument("--out", required=True)
        if name in ("segment", "horizons", "train", "score"):
            job.add_argument("--ref", type=date.fromisoformat, required=name != "segment")
        if name in ("train", "score"):
            job.add_argument("--models", required=True)
            job.add_argument("--horizon", type=int, default=180)
        if name in ("horizons", "score"):
            job.add_argument("--classes", type=int, default=5)
        if name == "segment":
            job.add_argument("--format", default="parquet")
            job.add_argument("--home", default=HOME_COUNTRY)
            job.add_argument("--k", type=int, default=5)
            job.add_argument("--restarts", type=int, default=300)
        if name == "sweep":
            job.add_argument("--most", type=int, default=24)
            job.add_argument("--restarts", type=int, default=20)
        if name == "score":
            job.add_argument("--sample", type=int)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace, grids=None, knn_grid=tuple(KNN_GRID)) -> None:
    if args.job == "segment":
        raw = read_table(spark, args.lines, LINES, args.format)
        done = segment_customers(raw, args.ref, args.home, args.k, args.restarts, args.seed)
        write_table(done.lines, f"{args.out}/lines", partition_by="Year_Month")
        write_table(done.customers, f"{args.out}/customers")
        return
    customers = read_table(spark, args.customers, CUSTOMERS)
    if args.job == "sweep":
        write_table(k_sweep(customers, range(2, args.most + 1), restarts=args.restarts, seed=args.seed), args.out)
        return
    if args.job == "profile":
        write_table(segment_population(customers), f"{args.out}/population")
        write_table(segment_sums(customers, CUSTOMER_NUMERIC), f"{args.out}/sums")
        write_table(segment_means(customers, CUSTOMER_NUMERIC), f"{args.out}/means")
        return
    lines = read_table(spark, args.lines, CLEAN_LINES)
    if args.job == "prepare":
        prepared = prepare_lines(lines, customers).select(*[f.name for f in PREPARED_LINES.fields])
        write_table(prepared, args.out, partition_by="Year_Month")
        return
    options = {"grids": grids, "seed": args.seed}
    if args.job == "first-purchase":
        write_table(first_purchase_model(lines, customers, **options).predictions, args.out)
    elif args.job == "baselines":
        features = checkpointed(assemble_features(first_basket_features(lines), customers.select("CustomerID", "Label")))
        write_table(compare_baselines(features, FIRST_BASKET_COLUMNS, knn_grid, seed=args.seed), args.out)
    elif args.job == "horizons":
        write_table(horizon_sweep(lines, customers, args.ref, range(args.classes), **options), args.out)
    elif args.job == "train":
        model = horizon_model(lines, customers, args.ref, args.horizon, **options)
        scores = model.grid_scores.collect()  # one row per grid point
        save_bundle(spark, args.models, args.horizon, model.scaler, model.vote, [*HORIZON_COLUMNS, *MONTH_COLUMNS], scores)
    else:
        report = batch_score(
            lines, customers, args.ref, args.models, range(args.classes), args.horizon, args.sample, args.seed
        )
        for name in ("predictions", "accuracy", "confusion", "metrics"):
            write_table(getattr(report, name), f"{args.out}/{name}")


if __name__ == "__main__":
    run(SparkSession.builder.appName("basketry").getOrCreate(), arguments())
