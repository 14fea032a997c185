"""Print the physical plans of the library's key operators (for review).

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from terrace import sinks, sources  # noqa: E402
from terrace import session as S  # noqa: E402
from terrace.operators import quality as Q  # noqa: E402
from terrace.plans import orders  # noqa: E402
from terrace.queries import _land_orders, _orders_as_text, _run, table  # noqa: E402


def show(title, df):
    print(f"\n### {title}\n")
    print("```")
    df.explain("formatted")
    print("```")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = S.build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    root = S.scratch_path(spark, "plans")
    run = _run()

    landing = _land_orders(spark, sf_dir, root)
    silver = orders.to_silver(orders.read_bronze(spark, landing), run)
    show("Silver transform over the landing CSV (one scan, projection only)", silver)

    rules = Q.compile_rules(orders.SILVER, silver.columns, run)
    show("Gate, scalar rules: one aggregate for all rules", Q._scalar_report(silver, rules, 0))
    show("Gate, key rule: groupBy on the key column only", Q.duplicate_key_groups(silver, orders.SILVER.primary_key))

    gold_df = orders.to_gold(orders.to_silver(_orders_as_text(spark, sf_dir), run), run)
    sinks.overwrite_partitions(gold_df, f"{root}/gold", ("year", "month", "day"))
    gold = sources.read_partitioned(spark, f"{root}/gold")
    show("BI snapshot input: partition filters prune to one day", orders.to_bi(gold, run))

    history = orders.to_gold_history(orders.to_silver(_orders_as_text(spark, sf_dir), run), run)
    show("History write input: rebalance by partition columns (AQE splits hot days)", history.hint("rebalance", "year", "month", "day"))

    li = table(spark, sf_dir, "lineitem")
    show("Column pruning + pushed filter on a registered source", li.where(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity"))


if __name__ == "__main__":
    main()
