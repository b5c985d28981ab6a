"""The feature transforms and the feature mart on the whole tables, with the literal windows as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import features as ft
from millrace.plans import mart as mart_plan
from millrace.plans import training
from millrace.session import load_table as load
from millrace.session import new_folder

QUERIES: dict[str, tuple] = {}

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABEL = "l_returnflag"
# Ties between bins are split by these columns. Lines equal in all of them have equal features.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", *NUMERIC, LABEL]


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with -0.0 written as 0.0."""
    source = load(spark, folder, "lineitem")
    return mart_plan.staging_view(source, {c: c for c in LINE_KEY}).withColumns(
        {c: F.col(c) + F.lit(0.0) for c in NUMERIC}
    )


LINES_SQL = f"""
WITH lines AS (SELECT * REPLACE ({', '.join(f'{c} + 0.0 AS {c}' for c in NUMERIC)}) FROM lineitem)
"""


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, since two engines add in different orders; ``six[...]`` is the same in SQL."""
    six = lambda c: F.rint(F.col(c) * 1e6) / 1e6 + 0.0
    return df.select(*[six(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def expanded(sql: str) -> str:
    return sql.replace("six[", "(round_even((").replace("]", ") * 1e6::DOUBLE, 0) / 1e6::DOUBLE + 0.0::DOUBLE)")


def _on_lines(made: dict[str, ft.Feature], sql: str):
    def run(spark, folder):
        keep = ["l_orderkey", "l_linenumber"]
        return rounded(ft.fit_transform(lines(spark, folder), made, LINE_KEY, keep))

    return run, expanded(f"{LINES_SQL} SELECT l_orderkey, l_linenumber, {sql} FROM lines")


def _scalar(expression: str) -> str:
    return f"(SELECT {expression} FROM lines)"


def _percentile(column: str, p: float) -> str:
    return _scalar(f"percentile_cont({p}) WITHIN GROUP (ORDER BY {column})")


def robust_sql(c: str, iqr: float = 0.5) -> str:
    low, mid, high = (_percentile(c, p) for p in (0.5 - iqr / 2, 0.5, 0.5 + iqr / 2))
    return f"six[({c} - {mid}) / nullif({high} - {low}, 0)]"


def uniform_sql(c: str, k: int) -> str:
    width = f"({_scalar(f'max({c})')} - {_scalar(f'min({c})')}) / {k - 1}.0::DOUBLE"
    return f"CAST(floor(({c} - {_scalar(f'min({c})')}) / ({width})) + 1 AS BIGINT)"


def tile_sql(c: str, k: int) -> str:
    return f"ntile({k}) OVER (ORDER BY {c}, {', '.join(LINE_KEY)})"


def min_max_sql(c: str, low: float = 0, high: float = 1) -> str:
    least, most = _scalar(f"min({c})"), _scalar(f"max({c})")
    return f"six[({c} - {least}) / ({most} - {least}) * ({high} - {low}) + {low}]"


def log_sql(c: str, offset: float = 0) -> str:
    return f"CASE WHEN {c} + {offset} > 0 THEN six[ln({c} + {offset}) / ln(10::DOUBLE)] END"


def standard_sql(c: str, mean: float = 0, spread: float = 1) -> str:
    return f"six[({c} - {_scalar(f'avg({c})')}) / {_scalar(f'stddev_samp({c})')} * {spread} + {mean}]"


LINE_FEATURES = {
    "feat_exponentiate": (
        {"e": ft.exponentiate("l_tax"), "two": ft.exponentiate("l_quantity", 2)},
        "six[exp(l_tax)] AS e, six[pow(2, l_quantity)] AS two"),
    "feat_interact": (
        {"product": ft.interact("l_quantity", "l_tax"), "total": ft.interact("l_quantity", "l_tax", "additive"),
         "power": ft.interact("l_quantity", "l_tax", "exponential")},
        "six[l_quantity * l_tax] AS product, six[l_quantity + l_tax] AS total, six[pow(l_quantity, l_tax)] AS power"),
    "feat_k_bins_quantile": (
        {"price_bin": ft.k_bins_discretize("l_extendedprice", 7), "quantity_bin": ft.k_bins_discretize("l_quantity", 10)},
        f"{tile_sql('l_extendedprice', 7)} AS price_bin, {tile_sql('l_quantity', 10)} AS quantity_bin"),
    "feat_k_bins_uniform": (
        {"price_bin": ft.k_bins_discretize("l_extendedprice", 7, "uniform")},
        f"{uniform_sql('l_extendedprice', 7)} AS price_bin"),
    "feat_label_encode": (
        {"flag": ft.label_encode("l_returnflag"), "day": ft.label_encode("l_shipdate")},
        "dense_rank() OVER (ORDER BY l_returnflag) - 1 AS flag, dense_rank() OVER (ORDER BY l_shipdate) - 1 AS day"),
    "feat_log_transform": (
        {"plain": ft.log_transform("l_tax"), "shifted": ft.log_transform("l_tax", offset=0.01)},
        f"{log_sql('l_tax')} AS plain, {log_sql('l_tax', 0.01)} AS shifted"),
    "feat_max_absolute_scale": (
        {"scaled": ft.max_absolute_scale("l_extendedprice")},
        f"six[l_extendedprice / {_scalar('max(abs(l_extendedprice))')}] AS scaled"),
    "feat_min_max_scale": (
        {"unit": ft.min_max_scale("l_quantity"), "wide": ft.min_max_scale("l_extendedprice", -1, 3)},
        f"{min_max_sql('l_quantity')} AS unit, {min_max_sql('l_extendedprice', -1, 3)} AS wide"),
    "feat_numerical_binarize": (
        {"dear": ft.numerical_binarize("l_extendedprice", 0.8, direction=">"),
         "many": ft.numerical_binarize("l_quantity", 25, "value")},
        f"CASE WHEN l_extendedprice > {_percentile('l_extendedprice', 0.8)} THEN 1 ELSE 0 END AS dear, "
        "CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS many"),
    "feat_one_hot_encode": (
        {"flag": ft.one_hot_encode("l_returnflag")},
        ", ".join(f"CASE WHEN l_returnflag = '{v}' THEN 1 ELSE 0 END AS is_l_returnflag__{v.lower()}" for v in "ANR")
        + ", CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END AS is_l_returnflag__"),
    "feat_poly_transform": (
        {"cube": ft.poly_transform("l_quantity", 3), "root": ft.poly_transform("l_extendedprice", 0.5)},
        "six[pow(l_quantity, 3)] AS cube, six[pow(l_extendedprice, 0.5)] AS root"),
    "feat_robust_scale": (
        {"price": ft.robust_scale("l_extendedprice"), "quantity": ft.robust_scale("l_quantity", 0.8)},
        f"{robust_sql('l_extendedprice')} AS price, {robust_sql('l_quantity', 0.8)} AS quantity"),
    "feat_standardize": (
        {"price": ft.standardize("l_extendedprice"), "quantity": ft.standardize("l_quantity", 10, 2)},
        f"{standard_sql('l_extendedprice')} AS price, {standard_sql('l_quantity', 10, 2)} AS quantity"),
}
QUERIES.update({name: _on_lines(made, sql) for name, (made, sql) in LINE_FEATURES.items()})


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return register


def _gappy_parts(spark, folder):
    """Parts without their price when it is above 1500 and without their type when small."""
    return load(spark, folder, "part").select(
        "p_partkey", "p_brand",
        F.when(F.col("p_retailprice") <= 1500, F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_size") > 4, F.col("p_type")).alias("type"), (F.col("p_size") > 25).alias("big"),
        F.when(F.col("p_size") > 10, F.col("p_size") > 40).alias("huge"),
    )


GAPPY_SQL = """
WITH parts AS (SELECT p_partkey, p_brand, CASE WHEN p_retailprice <= 1500 THEN p_retailprice END AS price,
                      CASE WHEN p_size > 4 THEN p_type END AS type, p_size > 25 AS big,
                      CASE WHEN p_size > 10 THEN p_size > 40 END AS huge FROM part)
"""


def _on_parts(made: dict[str, ft.Feature], sql: str):
    def run(spark, folder):
        return rounded(ft.fit_transform(_gappy_parts(spark, folder), made, ["p_partkey"], ["p_partkey"]))

    return run, expanded(f"{GAPPY_SQL} SELECT p_partkey, {sql} FROM parts")


PART_FEATURES = {
    "feat_bool_one_hot": (
        {"flags": ft.bool_to_one_hot(["big", "huge"]), "ones": ft.bool_to_one_hot(["huge"], null_as_one=True, prefix="one_")},
        "CAST(big AS INTEGER) AS is_big, coalesce(CAST(huge AS INTEGER), 0) AS is_huge, coalesce(CAST(huge AS INTEGER), 1) AS one_huge"),
    "feat_categorical_impute": (
        {"type": ft.categorical_impute("type")},
        "coalesce(type, (SELECT mode() WITHIN GROUP (ORDER BY type) FROM parts)) AS type"),
    "feat_numerical_impute": (
        {"mean": ft.numerical_impute("price"), "median": ft.numerical_impute("price", "median"),
         "low": ft.numerical_impute("price", "percentile", 0.1)},
        "six[coalesce(price, (SELECT avg(price) FROM parts))] AS mean, "
        "six[coalesce(price, (SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY price) FROM parts))] AS median, "
        "six[coalesce(price, (SELECT percentile_cont(0.1) WITHIN GROUP (ORDER BY price) FROM parts))] AS low"),
    "feat_rare_category_encode": (
        {"brand": ft.rare_category_encode("p_brand", 0.04)},
        "CASE WHEN count(*) OVER (PARTITION BY p_brand) / (count(*) OVER ())::DOUBLE < 0.04 THEN 'Other' ELSE p_brand END AS brand"),
    "feat_label_encode_nulls": (
        {"type_code": ft.label_encode("type"), "brand_code": ft.label_encode("p_brand")},
        "dense_rank() OVER (ORDER BY type NULLS LAST) - 1 AS type_code, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_code"),
    "feat_quantile_bins_nulls": (
        {"price_bin": ft.k_bins_discretize("price", 6)},
        "ntile(6) OVER (ORDER BY price NULLS LAST, p_partkey) AS price_bin"),
}
QUERIES.update({name: _on_parts(made, sql) for name, (made, sql) in PART_FEATURES.items()})


@query("""
SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey + 9007199254740992) AS wide_bin,
       ntile(5) OVER (ORDER BY o_custkey + 9007199254740992, o_orderkey) AS tied_bin
FROM orders""")
def feat_quantile_bins_wide_integers(spark, folder):
    """Bins of integers that a double can't tell apart."""
    first = F.lit(1 << 53)
    orders = load(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_orderkey") + first).alias("wide"), (F.col("o_custkey") + first).alias("tied"))
    bins = {"wide_bin": ft.k_bins_discretize("wide", 7), "tied_bin": ft.k_bins_discretize("tied", 5)}
    return ft.fit_transform(orders, bins, key=["o_orderkey"], keep=["o_orderkey"])


@query("""
WITH gappy AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN o_custkey END AS customer FROM orders)
SELECT o_orderkey, customer, dense_rank() OVER (ORDER BY customer NULLS LAST) - 1 AS is_customer_at,
       (SELECT count(DISTINCT customer) + 1 FROM gappy) AS is_customer_of FROM gappy""")
def feat_one_hot_positions(spark, folder):
    """A column of more values than one-hot columns are made for."""
    orders = load(spark, folder, "orders")
    gappy = orders.select("o_orderkey", F.when(F.col("o_custkey") % 7 > 0, F.col("o_custkey")).alias("customer"))
    return ft.one_hot_positions(gappy, "customer")


@query("""
SELECT o_orderkey, ntile(1000) OVER (ORDER BY o_totalprice, o_orderkey) AS price_bin,
       ntile(1000) OVER (ORDER BY o_custkey, o_orderkey) AS customer_bin
FROM orders""")
def feat_quantile_bins_thousand(spark, folder):
    """Many bins, of values that hardly repeat and of values that all do."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    bins = {"price_bin": ft.k_bins_discretize("o_totalprice", 1000), "customer_bin": ft.k_bins_discretize("o_custkey", 1000)}
    return ft.fit_transform(orders, bins, key=["o_orderkey"], keep=["o_orderkey"])


@query(GAPPY_SQL + """
SELECT how, count(*) AS rows, CAST(0 AS BIGINT) AS still_null, count(*) AS from_pool, count(price) AS unchanged
FROM parts, (VALUES ('observed'), ('distinct')) AS ways(how) GROUP BY how""")
def feat_random_impute(spark, folder):
    """What every random imputation has to keep: no NULL left, every value from the pool, known values unchanged."""
    parts = _gappy_parts(spark, folder).select("p_partkey", "price")
    pool = parts.where(F.col("price").isNotNull()).select(F.col("price").alias("filled")).distinct()
    reports = []
    for how, observed in (("observed", True), ("distinct", False)):
        imputed = ft.random_impute(parts, "price", ["p_partkey"], consider_distribution=observed)
        filled = imputed.select("p_partkey", F.col("price").alias("filled"))
        known = filled.join(pool.withColumn("known", F.lit(True)), "filled", "left").join(parts, "p_partkey")
        reports.append(known.agg(
            F.lit(how).alias("how"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("filled").isNull()).alias("still_null"),
            F.count("known").alias("from_pool"), F.count_if(F.col("filled") == F.col("price")).alias("unchanged"),
        ))
    return reports[0].unionAll(reports[1])


@query(GAPPY_SQL + """, pool AS (
  SELECT price, count(*) AS n FROM parts WHERE price IS NOT NULL GROUP BY price
), ways AS (
  SELECT 'observed' AS how, price, n AS length FROM pool UNION ALL SELECT 'distinct', price, 1 FROM pool
), intervals AS (
  SELECT how, price, sum(length) OVER (PARTITION BY how ORDER BY price) AS upto, length, sum(length) OVER (PARTITION BY how) AS total FROM ways
), draws AS (
  SELECT how, p_partkey, CAST('0x' || substr(md5(concat('42|', p_partkey)), 1, 15) AS BIGINT) % total AS place
  FROM parts, (SELECT DISTINCT how, total FROM intervals) WHERE price IS NULL
)
SELECT d.how, p_partkey, price FROM draws d JOIN intervals i ON i.how = d.how AND place < upto AND place >= upto - length
UNION ALL SELECT how, p_partkey, price FROM parts, (VALUES ('observed'), ('distinct')) AS every(how) WHERE price IS NOT NULL""")
def feat_random_impute_draws(spark, folder):
    """Every value that both ways of drawing give."""
    parts = _gappy_parts(spark, folder).select("p_partkey", "price")
    drawn = lambda how, observed: ft.random_impute(parts, "price", ["p_partkey"], consider_distribution=observed).withColumn("how", F.lit(how))
    return drawn("observed", True).unionAll(drawn("distinct", False))


def _mart_sql() -> str:
    made = []
    for c in NUMERIC:
        made += [f"{tile_sql(c, 5)} AS {c}_quantile_bin", f"{uniform_sql(c, 5)} AS {c}_uniform_bin",
                 f"{robust_sql(c)} AS {c}_robust_scaled", f"six[{c} / {_scalar(f'max(abs({c}))')}] AS {c}_max_absolute_scaled",
                 f"{min_max_sql(c)} AS {c}_max_min_max_scaled", f"{log_sql(c)} AS {c}_logged",
                 f"CASE WHEN {c} >= {_percentile(c, 0.5)} THEN 1 ELSE 0 END AS {c}_binarized", f"{standard_sql(c)} AS {c}_standardized"]
    for i, a in enumerate(NUMERIC):
        for b in NUMERIC[i + 1:]:
            made += [f"six[{a} * {b}] AS {a}_x_{b}_interaction", f"six[{a} + {b}] AS {a}_plus_{b}_interaction"]
    made.append(f"dense_rank() OVER (ORDER BY {LABEL}) - 1 AS {LABEL}_label_encoded")
    made.append(LINE_FEATURES["feat_one_hot_encode"][1])
    numeric = ", ".join(f"six[{c}] AS {c}" for c in NUMERIC)
    return expanded(f"{LINES_SQL} SELECT {numeric}, {LABEL}, {', '.join(made)} FROM lines")


@query(_mart_sql())
def feature_mart(spark, folder):
    return rounded(mart_plan.feature_mart(lines(spark, folder), NUMERIC, LABEL, LINE_KEY))


_SCALED = [f"{c}_{kind}" for c in NUMERIC for kind in (
    "quantile_bin", "uniform_bin", "robust_scaled", "max_absolute_scaled", "max_min_max_scaled", "logged", "binarized", "standardized")]


@query(f"""{LINES_SQL}, split AS (
  SELECT CAST('0x' || substr(md5(concat_ws('|', '42', l_orderkey, l_linenumber)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.7 AS training FROM lines
), sizes AS (
  SELECT count(*) FILTER (training) AS train_rows, count(*) FILTER (NOT training) AS test_rows FROM split
), gaps AS (
  SELECT {' + '.join(f"CAST(bool_or({c} <= 0) AS INTEGER)" for c in NUMERIC)} AS n FROM lines
)
SELECT run, model_type, CAST(CASE WHEN model_type = 'full_model' THEN {len(NUMERIC) + len(_SCALED) + len(NUMERIC) * (len(NUMERIC) - 1)} + n ELSE 5 END AS INTEGER) AS features_count,
       train_rows, test_rows, true AS scored, true AS sums_to_one
FROM sizes, gaps, (VALUES ('full_model'), ('top5_features_model')) AS models(model_type), (VALUES ('2024-01-01'), ('2024-01-02')) AS runs(run)""")
def train_forest_metrics(spark, folder):
    """A forest on the whole mart and one on its best five features; the results of two runs, appended and read back.

    Scores differ between engines, and the flags of these lines hardly depend on their numbers: a score is
    reported as lying between 0.25, a bad guess among three classes, and 1.
    """
    mart = mart_plan.feature_mart(lines(spark, folder), NUMERIC, LABEL, LINE_KEY, keep_key=True)
    metrics, importances = training.train_model(mart, LABEL, LINE_KEY[:2], trees=20, depth=5, ignore=LINE_KEY[:5])
    tables = {what: (f"forest_{what}_{uuid.uuid4().hex[:12]}", new_folder(spark)) for what in ("metrics", "importance")}
    for run in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
        training.save_results(metrics, importances, run, tables["metrics"][0], tables["importance"][0], tables["metrics"][1], tables["importance"][1])
    for name, _ in tables.values():
        spark.sql(f"DROP TABLE {name}")
    run = F.date_format("run_timestamp", "yyyy-MM-dd").alias("run")
    shares = spark.read.parquet(tables["importance"][1]).groupBy(run).agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))
    scores = spark.read.parquet(tables["metrics"][1]).select("*", run)
    between = lambda c: F.col(c).between(0.25, 1.0)
    return scores.join(shares, "run").select(
        "run", "model_type", "features_count", "train_rows", "test_rows", (between("train_accuracy") & between("test_accuracy")).alias("scored"), "sums_to_one")
