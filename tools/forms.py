"""Times the distributed forms against the literal ones: python tools/forms.py [folder]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from functools import reduce  # noqa: E402

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.operators import ordering, reshape  # noqa: E402
from millrace.operators.joins import anti  # noqa: E402
from millrace.plans.mart import feature_mart  # noqa: E402
from millrace.session import build_session, load_table  # noqa: E402
from workload import preparation as prep  # noqa: E402


def literal_mart(df: DataFrame) -> DataFrame:
    """The mart as whole-table windows, which put all rows in one task."""
    everything = Window.partitionBy()
    made = []
    for c in prep.NUMERIC:
        x = F.col(c)
        low, high = F.min(c).over(everything), F.max(c).over(everything)
        p = F.percentile(c, [0.25, 0.5, 0.75]).over(everything)
        made += [
            F.ntile(5).over(Window.orderBy(c, *prep.LINE_KEY[:5])).alias(f"{c}_q"),
            (F.floor((x - low) / ((high - low) / 4)) + 1).alias(f"{c}_u"), ((x - p[1]) / (p[2] - p[0])).alias(f"{c}_r"),
            (x / F.max(F.abs(c)).over(everything)).alias(f"{c}_a"), ((x - low) / (high - low)).alias(f"{c}_m"),
            F.when(x > 0, F.log(10.0, x)).alias(f"{c}_l"), F.when(x >= p[1], 1).otherwise(0).alias(f"{c}_b"),
            ((x - F.avg(c).over(everything)) / F.stddev_samp(c).over(everything)).alias(f"{c}_s"),
        ]
    made.append((F.dense_rank().over(Window.orderBy(prep.LABEL)) - 1).alias("code"))
    return df.select(*prep.NUMERIC, prep.LABEL, *made)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("forms", "local[8]", spark__sql__shuffle__partitions="32", spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    lines = prep.lines(spark, folder)
    raw, orders, part = (load_table(spark, folder, t) for t in ("lineitem", "orders", "part"))
    by_price = ["l_extendedprice", *prep.LINE_KEY[:4]]
    attributes = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    forms = {
        "feature_mart": (
            lambda: literal_mart(lines), lambda: feature_mart(lines, prep.NUMERIC, prep.LABEL, prep.LINE_KEY)),
        "ntile(5) of all rows": (
            lambda: lines.select("l_orderkey", F.ntile(5).over(Window.orderBy(*by_price)).alias("tile")),
            lambda: ordering.global_ntile(lines.select(*by_price), 5, by_price).select("l_orderkey", "tile")),
        "lag over all rows": (
            lambda: lines.select("l_orderkey", F.lag("l_extendedprice").over(Window.orderBy(*by_price)).alias("before")),
            lambda: ordering.neighbour(lines.select(*by_price), [], by_price, "l_extendedprice", "before").select("l_orderkey", "before")),
        "exact percentiles of 2 columns": (
            lambda: lines.agg(F.percentile("l_extendedprice", [0.1, 0.5, 0.9]), F.percentile("l_quantity", [0.1, 0.5, 0.9])),
            lambda: spark.createDataFrame([(str(ordering.percentiles(lines, {"l_extendedprice": [0.1, 0.5, 0.9], "l_quantity": [0.1, 0.5, 0.9]})),)])),
        "unpivot of 5 columns": (
            lambda: reduce(DataFrame.unionAll, [part.select("p_partkey", F.lit(c), F.col(c).cast("string")) for c in attributes]),
            lambda: reshape.unpivot(part, exclude=["p_partkey"])),
        "orders without lines": (
            lambda: orders.join(raw, F.col("o_orderkey") == F.col("l_orderkey"), "left").where("l_orderkey is null").select("o_orderkey"),
            lambda: anti(orders.select("o_orderkey"), raw.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")),
    }
    for name, pair in forms.items():
        seconds = []
        for form in pair:
            for _ in range(2):
                start = time.perf_counter()
                form().write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - start
            seconds.append(took)
        print(f"| {name} | {seconds[0]:.2f} | {seconds[1]:.2f} |", flush=True)


if __name__ == "__main__":
    main()
