"""Queries on column statistics, outliers, histograms and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from formline.operators import correlation, profile, ranking, reshape
from formline.operators.layout import stored
from formline.plans import eda
from formline.suite.registry import Tables, publish, query, rounded, whole, with_ctes

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def per_column(select: str, columns=COLUMNS, source: str = "lineitem") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.replace('@', c)} FROM {source}" for c in columns)


@query("describe_columns", per_column(", ".join([
    "count(@) AS count", f"{rounded('avg(@)')} AS mean", f"{rounded('stddev_samp(@)')} AS std",
    f"{rounded('min(@)')} AS min", f"{rounded('max(@)')} AS max",
    *[f"{rounded(f'quantile_cont(@, {q / 100})')} AS q{q}" for q in (25, 50, 75)],
])))
def describe_columns(t: Tables):
    return publish(profile.describe_columns(t.lineitem, COLUMNS))


def fences_sql(select: str) -> str:
    parts = []
    for c in COLUMNS:
        parts.append(f"""SELECT '{c}' AS "column", {select} FROM (
  SELECT {c} AS v, quantile_cont({c}, 0.25) OVER () AS q25, quantile_cont({c}, 0.5) OVER () AS q50,
    quantile_cont({c}, 0.75) OVER () AS q75 FROM lineitem)""")
    return " UNION ALL ".join(parts)


OUTSIDE = "v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)"


@query("outlier_summary", fences_sql(
    f"count(*) FILTER ({OUTSIDE}) AS outlier_count, {rounded(f'count(*) FILTER ({OUTSIDE}) / count(*)', 8)} AS outlier_pct"))
def outlier_summary(t: Tables):
    return publish(profile.outlier_summary(t.lineitem, COLUMNS), 8)


@query("box_stats", fences_sql(f"""{rounded('min(q25)')} AS q25, {rounded('min(q50)')} AS q50,
  {rounded('min(q75)')} AS q75, {rounded(f'min(v) FILTER (NOT ({OUTSIDE}))')} AS whisker_low,
  {rounded(f'max(v) FILTER (NOT ({OUTSIDE}))')} AS whisker_high, count(*) FILTER ({OUTSIDE}) AS outlier_count"""))
def box_stats(t: Tables):
    return publish(profile.box_stats(t.lineitem, COLUMNS))


def histogram_sql(column: str, source: str, bins: int) -> str:
    return f"""WITH bounds AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {source}),
counted AS (SELECT {whole(f'least(floor(({column} - lo) / w), {bins - 1})')} AS bin, count(*) AS rows
  FROM {source}, bounds GROUP BY 1),
bins AS (SELECT CAST(unnest(range({bins})) AS BIGINT) AS bin)
SELECT bin, coalesce(rows, 0) AS rows, {rounded('lo + bin * w', 3)} AS bin_start, {rounded('lo + (bin + 1) * w', 3)} AS bin_end
FROM bins LEFT JOIN counted USING (bin), bounds"""


@query("histogram", histogram_sql("o_totalprice", "orders", 50))
def histogram(t: Tables):
    return publish(profile.histogram(t.orders, "o_totalprice", 50), 3)


@query("feature_histogram", histogram_sql("c_acctbal", "customer", 40))
def feature_histogram(t: Tables):
    return publish(profile.histogram(t.customer, "c_acctbal", 40), 3)


@query("grouped_histogram", f"""
WITH bounds AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 60 AS w FROM lineitem),
counted AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / w), 59) AS BIGINT) AS bin, min(w) AS w,
  count(*) AS rows FROM lineitem, bounds GROUP BY 1, 2),
listed AS (SELECT DISTINCT l_returnflag, CAST(unnest(range(60)) AS BIGINT) AS bin FROM lineitem)
SELECT l_returnflag, bin, coalesce(rows, 0) AS rows,
  {rounded('coalesce(rows, 0) / (sum(rows) OVER (PARTITION BY l_returnflag) * bounds.w)', 10)} AS density
FROM listed LEFT JOIN counted USING (l_returnflag, bin), bounds""")
def grouped_histogram(t: Tables):
    result = profile.histogram(t.lineitem, "l_extendedprice", 60, by=["l_returnflag"])
    return publish(result.select("l_returnflag", "bin", "rows", "density"), 10)


@query("density_curve", f"""
WITH bounds AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 50 AS w FROM orders),
counted AS (SELECT least(floor((o_totalprice - lo) / w), 49) AS bin, count(*) AS rows FROM orders, bounds GROUP BY 1),
bins AS (SELECT bin, coalesce(rows, 0) AS rows, (lo + bin * w + lo + (bin + 1) * w) / 2 AS center
  FROM (SELECT unnest(range(50)) AS bin) LEFT JOIN counted USING (bin), bounds)
SELECT {whole('a.bin')} AS bin, {rounded('min(a.center)', 3)} AS center,
  {rounded('sum(b.rows * exp(-pow((a.center - b.center) / 5000, 2) / 2)) / (sum(b.rows) * 5000 * sqrt(2 * pi()))', 12)} AS density
FROM bins a, bins b GROUP BY a.bin""")
def density_curve(t: Tables):
    bins = profile.histogram(t.orders, "o_totalprice", 50)
    return publish(profile.density_curve(bins, 5000.0), center=3, density=12)


WIDE = [*COLUMNS, "net", "gross", "flat", "sparse"]


def correlated(t: Tables):
    """The price again with discount and with tax, a constant, and a column with gaps."""
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        *COLUMNS,
        (price * (1 - F.col("l_discount"))).alias("net"),
        (price * (1 + F.col("l_tax"))).alias("gross"),
        F.lit(1.0).alias("flat"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity") * 2 + F.col("l_linenumber")).alias("sparse"),
    )


WIDE_SQL = """wide AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 - l_discount) AS net,
    l_extendedprice * (1 + l_tax) AS gross, 1.0::DOUBLE AS flat,
    CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity * 2 + l_linenumber END AS sparse FROM lineitem)"""


def corr_sql(a: str, b: str) -> str:
    """NULL where the engine gives NaN or fails on a constant."""
    if "flat" in (a, b):
        return "CAST(NULL AS DOUBLE)"
    return f"corr({a}, {b})"


def pairs_sql(pairs, first: str = "feature_1", second: str = "feature_2", also_abs: bool = False) -> str:
    extra = ", abs(correlation) AS abs_correlation" if also_abs else ""
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS {first}, '{b}' AS {second}, {rounded(corr_sql(a, b), 8)} AS correlation FROM wide"
        for a, b in pairs)
    return f"SELECT DISTINCT *{extra} FROM ({rows})"


@query("correlation_pairs", with_ctes([WIDE_SQL], pairs_sql(combinations(WIDE, 2))))
def correlation_pairs(t: Tables):
    return publish(correlation.correlation_pairs(correlated(t), WIDE), 8)


TARGETS = ["l_extendedprice", "l_quantity"]
FEATURES = [c for c in WIDE if c not in TARGETS]
TARGET_PAIRS = [(f, t) for f in FEATURES for t in TARGETS]


@query("target_correlations", with_ctes([WIDE_SQL], pairs_sql(TARGET_PAIRS, "feature", "target", also_abs=True)
       + " WHERE correlation IS NOT NULL"))
def target_correlations(t: Tables):
    return publish(correlation.target_correlations(correlated(t), TARGETS, FEATURES), 8)


@query("top_target_correlations", with_ctes([WIDE_SQL], pairs_sql(TARGET_PAIRS, "feature", "target", also_abs=True)
       + " WHERE correlation IS NOT NULL ORDER BY abs_correlation DESC, feature, target LIMIT 5"))
def top_target_correlations(t: Tables):
    return publish(correlation.top_pairs(correlation.target_correlations(correlated(t), TARGETS, FEATURES), 5), 8)


@query("collinear_pairs", with_ctes([WIDE_SQL], pairs_sql(combinations(WIDE, 2), also_abs=True)
       + " WHERE abs(correlation) >= 0.95"))
def collinear_pairs(t: Tables):
    return publish(correlation.collinear_pairs(correlated(t), WIDE), 8)


EDA = ["l_discount", "l_tax", "sparse"]


def value_rows(name: str, label: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS report, {label} AS name, {value} AS value FROM ({source})"


@query("eda_profile", with_ctes([WIDE_SQL], " UNION ALL ".join([
    value_rows("target_summary", '"column"', "mean", per_column(f"{rounded('avg(@)', 6)} AS mean", TARGETS, "wide")),
    value_rows("feature_summary", '"column"', "mean", per_column(f"{rounded('avg(@)', 6)} AS mean", EDA, "wide")),
    "SELECT 'top_missing', 'sparse', " + rounded("count(*) FILTER (sparse IS NULL) / count(*)", 6) + " FROM wide",
    value_rows("top_target_correlations", "feature || '/' || target", rounded("abs_correlation", 6),
               "SELECT * FROM (" + pairs_sql([(f, t) for f in FEATURES for t in TARGETS], "feature", "target", also_abs=True)
               + ") WHERE correlation IS NOT NULL ORDER BY abs_correlation DESC, feature, target LIMIT 30"),
    "SELECT 'histogram', 'rows', CAST(count(*) AS DOUBLE) FROM wide",
])))
def eda_profile(t: Tables):
    """Entries of the exploratory profile, and how many rows its first histogram holds."""
    wide = stored(correlated(t).select(*WIDE, F.lit(0).alias("PLAYER_ID"), F.lit("s").alias("SEASON"),
                                       F.lit("2000-01-01").cast("date").alias("GAME_DATE")), "wide")
    tables = eda.eda_profile(wide, TARGETS, EDA)
    named = lambda key, name, value: tables[key].select(
        F.lit(key).alias("report"), name.alias("name"), value.cast("double").alias("value"))
    parts = [named("target_summary", F.col("column"), F.col("mean")), named("feature_summary", F.col("column"), F.col("mean")),
             named("top_missing", F.col("column"), F.col("missing_pct")),
             named("top_target_correlations", F.concat_ws("/", "feature", "target"), F.col("abs_correlation")),
             tables["histogram_l_extendedprice"].agg(F.sum("rows").cast("double").alias("value")).select(
                 F.lit("histogram").alias("report"), F.lit("rows").alias("name"), "value")]
    return publish(reshape.union_all(parts), 6)


MATRIX = ["l_quantity", "l_extendedprice", "net"]


@query("corr_submatrix", with_ctes([WIDE_SQL], " UNION ALL ".join(
    f"SELECT '{row}' AS feature, " + ", ".join(f"{rounded(corr_sql(row, c), 8)} AS {c}" for c in MATRIX) + " FROM wide"
    for row in [*MATRIX, "sparse"])))
def corr_submatrix(t: Tables):
    return publish(correlation.correlation_matrix(correlated(t), [*MATRIX, "sparse"], MATRIX), 8)


@query("first_n_distinct", with_ctes([WIDE_SQL], "SELECT feature, CAST(min(place) AS BIGINT) AS first_rank FROM ("
       "SELECT feature, row_number() OVER (ORDER BY abs_correlation DESC, feature, target) AS place FROM ("
       + pairs_sql(TARGET_PAIRS, "feature", "target", also_abs=True) + " WHERE correlation IS NOT NULL)) "
       "GROUP BY feature ORDER BY first_rank LIMIT 3"))
def first_n_distinct(t: Tables):
    """Features in the order of their strongest correlation (a table of one row per pair is ranked)."""
    long = correlation.target_correlations(correlated(t), TARGETS, FEATURES).withColumn("all", F.lit(1))
    rounded_long = long.withColumn("gain", F.round("abs_correlation", 8))
    placed = ranking.rank_features(
        rounded_long.withColumn("name", F.concat_ws("/", "feature", "target")), ["all"], "gain", "name")
    return publish(ranking.first_n_distinct(placed, "feature", "rank", 3))


@query("dataset_shapes", """
SELECT 'orders' AS dataset, count(*) AS rows, CAST(6 AS BIGINT) AS columns FROM orders
UNION ALL SELECT 'customer', count(*), 5 FROM customer UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem""")
def dataset_shapes(t: Tables):
    return publish(reshape.dataset_shapes({"orders": t.orders, "customer": t.customer, "lineitem": t.lineitem}))
