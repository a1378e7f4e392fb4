"""Queries on the chronological split, baselines, metrics, model comparison, training and importance."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators import boosting, evaluate, importance, reshape, split, training
from formline.operators import series as S
from formline.operators.boosting import Boosting
from formline.operators.layout import scratch_path, stored
from formline.plans import modelling
from formline.suite.adapters import CUTOFF_SQL, LOGS_SQL, order_logs
from formline.suite.registry import Tables, day_text, publish, query, rounded, rounded_column, whole, with_ctes
from formline.suite.series import ENTITY

KEYS = '"PLAYER_ID", "GAME_ID"'


@query("cutoff_date", with_ctes([CUTOFF_SQL], f"SELECT {day_text('cutoff')} AS cutoff, count(*) AS test_rows "
       "FROM cut JOIN orders ON CAST(o_orderdate AS DATE) >= cutoff GROUP BY cutoff"))
def cutoff_date(t: Tables):
    logs = order_logs(t)
    cutoff = split.cutoff_date(logs)
    return publish(logs.filter(F.col("GAME_DATE") >= F.lit(cutoff)).agg(
        F.max(F.lit(cutoff)).alias("cutoff"), F.count(F.lit(1)).alias("test_rows")))


@query("time_split", with_ctes([LOGS_SQL, CUTOFF_SQL], f"""
SELECT {KEYS}, CASE WHEN "GAME_DATE" < cutoff THEN 'train' ELSE 'test' END AS split FROM logs, cut"""))
def time_split(t: Tables):
    return publish(split.label_split(order_logs(t)).select("PLAYER_ID", "GAME_ID", "split"))


LABELLED_SQL = """labelled AS (
  SELECT logs.*, CASE WHEN "GAME_DATE" < cutoff THEN 'train' ELSE 'test' END AS split FROM logs, cut)"""


@query("split_dates", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL], f"""
SELECT split, count(*) AS rows, {day_text('min("GAME_DATE")')} AS start_date, {day_text('max("GAME_DATE")')} AS end_date
FROM labelled GROUP BY split"""))
def split_dates(t: Tables):
    return publish(split.split_dates(split.label_split(order_logs(t))))


def modelling_features(t: Tables):
    logs = S.add_features(
        order_logs(t),
        S.rolling_features(["PTS"], [5, 20]) + S.min_max_features(["PTS"]) + S.lag_features(["PTS"]),
    )
    return logs.withColumn("season_start_year", C.season_start_year("SEASON"))


FEATURE_NAMES = [
    "pts_rolling_5g_avg", "pts_rolling_5g_std", "pts_rolling_20g_avg", "pts_rolling_20g_std", "pts_season_min",
    "pts_season_max", "pts_career_min", "pts_career_max", "pts_lag_1", "season_start_year",
]


@query("split_metadata", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL], f"""
SELECT 0.2::DOUBLE AS test_size_requested, count(*) FILTER (split = 'train') AS train_rows,
  count(*) FILTER (split = 'test') AS test_rows, CAST({len(FEATURE_NAMES)} AS BIGINT) AS feature_count,
  'PTS' AS target_columns, '{','.join(FEATURE_NAMES)}' AS feature_columns,
  {day_text('''min("GAME_DATE") FILTER (split = 'train')''')} AS train_start_date,
  {day_text('''max("GAME_DATE") FILTER (split = 'train')''')} AS train_end_date,
  {day_text('''min("GAME_DATE") FILTER (split = 'test')''')} AS test_start_date,
  {day_text('''max("GAME_DATE") FILTER (split = 'test')''')} AS test_end_date FROM labelled"""))
def split_metadata(t: Tables):
    _, metadata = modelling.prepare_modelling_data(modelling_features(t), targets=["PTS"])
    return publish(metadata.withColumns({
        name: F.array_join(name, ",") for name in ("target_columns", "feature_columns")}))


@query("target_means", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL], f"""
SELECT 'PTS' AS target, {rounded('avg("PTS")', 3)} AS mean FROM labelled WHERE split = 'train'"""))
def target_means(t: Tables):
    train, _ = split.time_split(order_logs(t))
    means = evaluate.target_means(train, ["PTS"])  # one number per target
    return publish(t.spark.createDataFrame(list(means.items()), "target string, mean double"), 3)


BASELINE_SQL = """baseline AS (
  SELECT l."PLAYER_ID", l."GAME_ID", l."PTS" AS actual, m.mean AS predicted FROM labelled l,
    (SELECT avg("PTS") AS mean FROM labelled WHERE split = 'train') m WHERE l.split = 'test')"""


def baseline(t: Tables):
    train, test = split.time_split(order_logs(t))
    return evaluate.baseline_predictions(test, evaluate.target_means(train, ["PTS"]))


@query("baseline_predictions", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL, BASELINE_SQL], f"""
SELECT {KEYS}, 'PTS' AS target, {rounded('actual', 2)} AS actual, {rounded('predicted', 2)} AS baseline_prediction
FROM baseline"""))
def baseline_predictions(t: Tables):
    return publish(baseline(t), 2)


def metric_sql(actual: str, predicted: str, prefix: str, digits: int = 3) -> str:
    error = f"({predicted} - {actual})"
    return f"""{rounded(f'avg(abs({error}))', digits)} AS {prefix}_mae,
  {rounded(f'sqrt(avg({error} * {error}))', digits)} AS {prefix}_rmse,
  {rounded(f'CASE WHEN min({actual}) = max({actual}) THEN 0.0 ELSE 1 - sum({error} * {error}) / (var_pop({actual}) * count({actual})) END', 6)} AS {prefix}_r2"""


@query("regression_metrics", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL, BASELINE_SQL], f"""
SELECT 'PTS' AS target, {metric_sql('actual', 'predicted', 'baseline')} FROM baseline"""))
def regression_metrics(t: Tables):
    return publish(evaluate.regression_metrics(baseline(t), {"baseline": "baseline_prediction"}), 3, baseline_r2=6)


# Two simple predictors stand in for models: the previous value, and the average of five.
MODELS = {"last": "Last value", "recent": "Recent average"}


def predictor_table(t: Tables):
    """All test rows; the target is named by the priority of the order. Without history, the baseline predicts."""
    priority = t.orders.select(F.col("o_orderkey").alias("GAME_ID"), F.col("o_orderpriority").alias("target"))
    logs = order_logs(t)
    cutoff = F.lit(split.cutoff_date(logs))
    train = logs.filter(F.col("GAME_DATE") < cutoff).join(priority, "GAME_ID")
    means = train.groupBy("target").agg(F.avg("PTS").alias("baseline_prediction"))
    history = S.add_features(logs, S.lag_features(["PTS"]) + S.rolling_features(["PTS"], [5]))
    test = history.filter(F.col("GAME_DATE") >= cutoff).join(priority, "GAME_ID")
    known = lambda name: F.coalesce(name, "baseline_prediction")
    return test.join(means, "target").select(
        "PLAYER_ID", "GAME_ID", "target", F.col("PTS").alias("actual"), "baseline_prediction",
        known("pts_lag_1").alias("last_prediction"), known("pts_rolling_5g_avg").alias("recent_prediction"))


PREDICTORS_SQL = f"""history AS (
  SELECT logs.*, o_orderpriority AS target, lag("PTS") OVER ({ENTITY}) AS last_prediction,
    avg("PTS") OVER ({ENTITY} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent_prediction
  FROM logs JOIN orders ON o_orderkey = "GAME_ID"),
means AS (
  SELECT target, avg("PTS") AS baseline_prediction FROM history, cut WHERE "GAME_DATE" < cutoff GROUP BY target),
predictions AS (
  SELECT {KEYS}, h.target, "PTS" AS actual, baseline_prediction, coalesce(last_prediction, baseline_prediction) AS last_prediction,
    coalesce(recent_prediction, baseline_prediction) AS recent_prediction
  FROM history h JOIN means ON means.target = h.target, cut WHERE "GAME_DATE" >= cutoff)"""


def metrics_sql(digits: int) -> str:
    return "metrics AS (" + " UNION ALL ".join(
        f"""SELECT '{label}' AS model, target, {metric_sql('actual', 'baseline_prediction', 'baseline', digits)},
  {metric_sql('actual', f'{name}_prediction', 'model', digits)} FROM predictions GROUP BY target"""
        for name, label in MODELS.items()) + ")"


METRICS_SQL = metrics_sql(3)
PREDICTOR_CTES = [LOGS_SQL, CUTOFF_SQL, PREDICTORS_SQL]
METRIC_CTES = [*PREDICTOR_CTES, METRICS_SQL]
DIGITS = {"baseline_r2": 6, "model_r2": 6}


def predictor_metrics(t: Tables):
    """One row per model and target, under common names."""
    metrics = evaluate.regression_metrics(
        predictor_table(t),
        {"baseline": "baseline_prediction", **{name: f"{name}_prediction" for name in MODELS}})
    return evaluate.stack_models(metrics, MODELS)


@query("prediction_error", with_ctes(PREDICTOR_CTES, f"""
SELECT {KEYS}, target, {rounded('last_prediction - actual', 2)} AS error,
  {rounded('abs(last_prediction - actual)', 2)} AS absolute_error FROM predictions"""))
def prediction_error(t: Tables):
    errors = evaluate.prediction_error(predictor_table(t), "last_prediction")
    return publish(errors.select("PLAYER_ID", "GAME_ID", "target", "error", "absolute_error"), 2)


PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("metric_comparison", with_ctes(METRIC_CTES, f"""
SELECT *, CAST(list_position({PRIORITIES}, target) AS BIGINT) AS target_order FROM metrics"""))
def metric_comparison(t: Tables):
    return publish(evaluate.metric_comparison([predictor_metrics(t)], PRIORITIES, digits=None), 3, **DIGITS)


@query("round_metrics", with_ctes([*PREDICTOR_CTES, metrics_sql(2)], f"""
SELECT model, target, baseline_mae, baseline_rmse, model_mae, model_rmse,
  {', '.join(f'{rounded(name, 2)} AS {name}' for name in ('baseline_r2', 'model_r2'))} FROM metrics"""))
def round_metrics(t: Tables):
    table = evaluate.metric_comparison([predictor_metrics(t)], PRIORITIES, digits=2)
    names = [f"{prefix}_{name}" for prefix in ("baseline", "model") for name in evaluate.METRICS]
    return publish(table.select("model", "target", *names), 2)


@query("improvement_tiers", with_ctes(METRIC_CTES, f"""
SELECT model, target, {rounded('baseline_mae - model_mae', 2)} AS mae_improvement,
  {rounded('baseline_rmse - model_rmse', 2)} AS rmse_improvement, {rounded('model_r2 - baseline_r2', 5)} AS r2_improvement,
  CASE WHEN model_r2 >= 0.4 THEN 'well' WHEN model_r2 >= 0.2 THEN 'moderate' ELSE 'poor' END AS tier FROM metrics"""))
def improvement_tiers(t: Tables):
    metrics = predictor_metrics(t)
    names = [c for c in metrics.columns if c.endswith(("_mae", "_rmse"))]
    shown = metrics.withColumns({c: F.round(c, 3) for c in names} | {c: F.round(c, 6) for c in DIGITS})
    judged = evaluate.quality_tiers(evaluate.evaluation_improvement(shown))
    return publish(judged.select(
        "model", "target", "mae_improvement", "rmse_improvement", "r2_improvement", "tier"), 2, r2_improvement=5)


@query("metrics_melt", with_ctes(METRIC_CTES, """
SELECT model, target, 'Baseline' AS metric_type, baseline_mae AS mae FROM metrics
UNION ALL SELECT model, target, 'Model', model_mae FROM metrics"""))
def metrics_melt(t: Tables):
    metrics = predictor_metrics(t)
    long = reshape.melt(metrics, ["model", "target"], ["baseline_mae", "model_mae"], "metric_type", "mae")
    labels = {"baseline_mae": "Baseline", "model_mae": "Model"}
    return publish(long.withColumn("metric_type", C.recode("metric_type", labels)), 3)


@query("series_long", with_ctes(METRIC_CTES, """
SELECT DISTINCT 'Baseline' AS series, target, baseline_rmse AS rmse FROM metrics
UNION ALL SELECT model, target, model_rmse FROM metrics"""))
def series_long(t: Tables):
    metrics = predictor_metrics(t)
    return publish(reshape.series_long(metrics, "rmse").select("series", "target", "rmse"), 3)


# ------------------------------------------------------------------------------ importance
GAIN_FEATURE_SQL = """CASE n % 4 WHEN 0 THEN 'pts_rolling_' || n || 'g_avg' WHEN 1 THEN 'opponent_' || n
    WHEN 2 THEN 'position_' || n ELSE 'brand_' || n END"""
SCORES_SQL = f"""scores AS (
  SELECT p_type AS target, {GAIN_FEATURE_SQL} AS feature, n, sum(l_extendedprice) AS gain
  FROM (SELECT *, CAST(substr(p_brand, 7) AS BIGINT) AS n FROM part) JOIN lineitem ON l_partkey = p_partkey
  GROUP BY ALL)"""
FAMILY_SQL = """CASE WHEN contains(feature, '_rolling_') THEN 'time_series'
    WHEN feature LIKE 'opponent\\_%' ESCAPE '\\' THEN 'contextual'
    WHEN feature LIKE 'position\\_%' ESCAPE '\\' THEN 'player_specific' ELSE 'other' END"""
IMPORTANCE_SQL = f"""features AS (
  SELECT DISTINCT {GAIN_FEATURE_SQL} AS feature, n FROM (
    SELECT CAST(substr(p_brand, 7) AS BIGINT) AS n FROM part) UNION SELECT 'never_used', 1000000),
totals AS (SELECT target, sum(gain) AS total FROM scores GROUP BY target),
importance AS (
  SELECT 'gbt' AS model, totals.target, features.feature, coalesce(gain, 0) AS gain, coalesce(gain, 0) / total AS gain_share,
    row_number() OVER (PARTITION BY totals.target ORDER BY coalesce(gain, 0) DESC, features.n) AS rank
  FROM totals CROSS JOIN features LEFT JOIN scores ON scores.target = totals.target AND scores.feature = features.feature),
families AS (
  SELECT model, target, {FAMILY_SQL} AS feature_family, sum(gain_share) AS gain_share FROM importance GROUP BY ALL)"""
IMPORTANCE_CTES = [SCORES_SQL, IMPORTANCE_SQL]


def gain_feature(n):
    text = n.cast("string")
    return (
        F.when(n % 4 == 0, F.concat(F.lit("pts_rolling_"), text, F.lit("g_avg")))
        .when(n % 4 == 1, F.concat(F.lit("opponent_"), text))
        .when(n % 4 == 2, F.concat(F.lit("position_"), text))
        .otherwise(F.concat(F.lit("brand_"), text))
    )


def brand_number():
    return F.substring("p_brand", 7, 10).cast("long")


def gain_table(t: Tables):
    """Revenue per part type and brand, as the gain of a feature for a target."""
    revenue = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("revenue"))
    return (
        t.part.join(revenue, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("target"), gain_feature(brand_number()).alias("feature"))
        .agg(F.sum("revenue").alias("gain"))
    )


def importance_rows(t: Tables):
    # The feature list of a model: as many names as there are brands.
    brands = t.part.select(brand_number().alias("n")).distinct()
    names = [row["feature"] for row in brands.orderBy("n").select(gain_feature(F.col("n")).alias("feature")).collect()]
    return importance.importance_table(gain_table(t), [*names, "never_used"], "gbt")


@query("importance_table", with_ctes(IMPORTANCE_CTES, f"""
SELECT model, target, feature, {FAMILY_SQL} AS feature_family, {rounded('gain', 2)} AS gain,
  {rounded('gain_share', 8)} AS gain_share, {whole('rank')} AS rank FROM importance"""))
def importance_table(t: Tables):
    return publish(importance_rows(t), 8, gain=2)


@query("gain_share", with_ctes([SCORES_SQL], f"""
SELECT target, feature, {rounded('gain', 2)} AS gain, {rounded('sum(gain) OVER (PARTITION BY target)', 2)} AS total_gain,
  {rounded('gain / sum(gain) OVER (PARTITION BY target)', 8)} AS gain_share FROM scores"""))
def gain_share(t: Tables):
    return publish(importance.gain_share(gain_table(t)), 8, gain=2, total_gain=2)


@query("rank_features", with_ctes(IMPORTANCE_CTES, f"SELECT target, feature, {whole('rank')} AS rank FROM importance"))
def rank_features(t: Tables):
    return publish(importance_rows(t).select("target", "feature", "rank"))


@query("top_features", with_ctes(IMPORTANCE_CTES, f"""
SELECT target, feature, {whole('rank')} AS rank FROM importance WHERE target = 'PROMO' AND rank <= 20"""))
def top_features(t: Tables):
    return publish(importance.top_features(importance_rows(t), "PROMO", 20).select("target", "feature", "rank"))


@query("family_summary", with_ctes(IMPORTANCE_CTES, f"""
SELECT model, target, feature_family, {rounded('gain_share', 8)} AS gain_share FROM families"""))
def family_summary(t: Tables):
    return publish(importance.sorted_family_summary(importance_rows(t)), 8)


PIVOT_SQL = "pivoted AS (SELECT target, " + ", ".join(
    f"coalesce(sum(gain_share) FILTER (feature_family = '{family}'), 0) AS {family}" for family in fv.FAMILIES
) + " FROM families GROUP BY target)"


@query("family_pivot", with_ctes([*IMPORTANCE_CTES, PIVOT_SQL], "SELECT target, " + ", ".join(
    f"{rounded(family, 8)} AS {family}" for family in fv.FAMILIES) + " FROM pivoted"))
def family_pivot(t: Tables):
    return publish(reshape.pivot_family(importance.family_summary(importance_rows(t))), 8)


@query("family_extremes", with_ctes([*IMPORTANCE_CTES, PIVOT_SQL], f"""
SELECT count(*) FILTER (time_series > 0.5) AS majority_targets, count(*) AS targets,
  arg_max(target, time_series) AS strongest_target, {rounded('max(time_series)', 8)} AS strongest_share,
  arg_min(target, time_series) AS weakest_target, {rounded('min(time_series)', 8)} AS weakest_share FROM pivoted"""))
def family_extremes(t: Tables):
    pivoted = reshape.pivot_family(importance.family_summary(importance_rows(t)))
    return publish(importance.family_extremes(pivoted), 8)


@query("importance_analysis", with_ctes(IMPORTANCE_CTES, f"""
SELECT 'top' AS report, target, feature AS name, {rounded('gain_share', 8)} AS value FROM importance WHERE target = 'PROMO' AND rank <= 20
UNION ALL SELECT 'family', target, feature_family, {rounded('gain_share', 8)} FROM families
UNION ALL SELECT 'rows', target, 'features', CAST(count(*) AS DOUBLE) FROM importance GROUP BY target"""))
def importance_analysis(t: Tables):
    """The reports of one importance table, stacked."""
    brands = t.part.select(brand_number().alias("n")).distinct()
    names = [row["feature"] for row in brands.orderBy("n").select(gain_feature(F.col("n")).alias("feature")).collect()]
    reports = modelling.importance_analysis(gain_table(t), [*names, "never_used"], "gbt")
    row = lambda df, name, label, value: df.select(
        F.lit(name).alias("report"), "target", label.alias("name"), value.cast("double").alias("value"))
    top = importance.top_features(reports["importance"], "PROMO", 20)
    sizes = reports["importance"].groupBy("target").agg(F.count(F.lit(1)).alias("rows"))
    return publish(reshape.union_all([
        row(top, "top", F.col("feature"), F.col("gain_share")),
        row(reports["family_summary"], "family", F.col("feature_family"), F.col("gain_share")),
        row(sizes, "rows", F.lit("features"), F.col("rows"))]), 8)


# ------------------------------------------------------------------------------ training
# The eight targets as statistics of an order and its lines.
TARGET_AGGREGATES = {
    "FANTASY_PTS": ("sum", "l_extendedprice"), "REB": ("sum", "l_quantity"), "AST": ("count", "l_quantity"), "STL": ("sum", "l_discount"),
    "BLK": ("sum", "l_tax"), "TOV": ("max", "l_quantity"), "3PM": ("min", "l_quantity")}
GAMES8_SQL = "games8 AS (SELECT logs.*, " + ", ".join(
    f'{how}({column}) AS "{name}"' for name, (how, column) in TARGET_AGGREGATES.items()
) + ' FROM logs JOIN lineitem ON l_orderkey = "GAME_ID" GROUP BY ALL)'
CUT8_SQL = """day_counts AS (SELECT "GAME_DATE" AS d, count(*) AS c FROM games8 GROUP BY 1),
cut AS (
  SELECT min(d) AS cutoff FROM (SELECT d, sum(c) OVER (ORDER BY d) AS reached FROM day_counts)
  WHERE reached > (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM games8))"""
SHIPPED = training.GRADUAL


def eight_targets(t: Tables):
    """Earlier values of the customer as features, from one window pass; the split is written before it is learned from."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("GAME_ID")).agg(
        *[getattr(F, how)(column).alias(name) for name, (how, column) in TARGET_AGGREGATES.items()])
    features = S.rolling_features(fv.TARGETS, [5]) + S.lag_features(fv.TARGETS)
    logs = S.add_features(order_logs(t).join(lines, "GAME_ID"), features).withColumn("season_start_year", C.season_start_year("SEASON"))
    data, _ = modelling.prepare_modelling_data(logs)
    return replace(data, data=stored(data.data, "split"))


@query("train_metrics")
def train_metrics(t: Tables):
    """All targets trained with the shipped parameters. SQL cannot train a hundred rounds: the tests replay the trees."""
    metrics, _, _ = modelling.train_and_evaluate(eight_targets(t), SHIPPED)
    return publish(metrics, 3, baseline_r2=6, **{f"{SHIPPED.name}_r2": 6})


# A run small enough to be trained by SQL as well: two rounds of two levels on three targets, eight bins.
SMALL = training.ParameterSet("gbt_small", "Small trees", Boosting(rounds=2, depth=2, rate=0.5, bins=8, least_rows=20))
SMALL_TARGETS = ["REB", "AST", "3PM"]
SMALL_FEATURES = [f"{name.lower()}_{kind}" for name in ("PTS", *SMALL_TARGETS) for kind in ("rolling_5g_avg", "lag_1")]


def small_data(t: Tables):
    """Averages and last values of earlier orders, to four digits: missing at a customer's first order."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("GAME_ID")).agg(
        *[getattr(F, TARGET_AGGREGATES[name][0])(TARGET_AGGREGATES[name][1]).alias(name) for name in SMALL_TARGETS])
    chosen = ["PTS", *SMALL_TARGETS]
    logs = S.add_features(order_logs(t).join(lines, "GAME_ID"), S.rolling_features(chosen, [5]) + S.lag_features(chosen))
    logs = logs.withColumns({name: rounded_column(F.col(name).cast("double"), 4) for name in SMALL_FEATURES})
    data = split.feature_target_table(split.label_split(logs), SMALL_TARGETS, features=SMALL_FEATURES)
    return replace(data, data=stored(data.data, "split"))


def train_sql() -> list[str]:
    """The same training in SQL: trees_<n> has the nodes of a round, scored_<n> the predictions after it."""
    p = SMALL.boosting
    history = {"rolling_5g_avg": 'avg("{0}") OVER ({1} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)', "lag_1": 'lag("{0}") OVER ({1})'}
    columns = [f"{rounded(how.format(name, ENTITY), 4)} AS f{2 * i + j}"
               for i, name in enumerate(("PTS", *SMALL_TARGETS)) for j, how in enumerate(history.values())]
    long_x = " UNION ALL ".join(f"SELECT {KEYS}, {i} AS f, f{i} AS x FROM featured" for i in range(len(SMALL_FEATURES)))
    long_y = " UNION ALL ".join(f"""SELECT {KEYS}, '{name}' AS target, CAST("{name}" AS DOUBLE) AS actual, "GAME_DATE" < cutoff AS train FROM featured, cut"""
                                for name in SMALL_TARGETS)
    ctes = [LOGS_SQL, GAMES8_SQL, CUT8_SQL,
            f"featured AS MATERIALIZED (SELECT *, {', '.join(columns)} FROM games8)",
            f"x AS MATERIALIZED ({long_x})", f"y AS MATERIALIZED ({long_y})",
            """ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS k, count(*) OVER (PARTITION BY f) AS n
  FROM x JOIN (SELECT DISTINCT "PLAYER_ID", "GAME_ID" FROM y WHERE train) USING ("PLAYER_ID", "GAME_ID") WHERE x IS NOT NULL)""",
            f"""edges AS MATERIALIZED (SELECT f, x AS edge, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS e
  FROM (SELECT DISTINCT f, x FROM ranked WHERE k * {p.bins} // n > (k - 1) * {p.bins} // n))""",
            f"""codes AS MATERIALIZED (SELECT {KEYS}, x.f, CASE WHEN any_value(x) IS NULL THEN -1 ELSE count(edge) END AS code
  FROM x LEFT JOIN edges ON edges.f = x.f AND edge < x GROUP BY ALL)""",
            "base AS (SELECT target, avg(actual) AS mean FROM y WHERE train GROUP BY target)",
            "scored_0 AS MATERIALIZED (SELECT y.*, mean AS predicted, actual - mean AS r, 0 AS node FROM y JOIN base USING (target))"]
    for tree in range(p.rounds):
        ctes.append(f"at_{tree}_0 AS (SELECT * FROM scored_{tree})")
        for level in range(p.depth):
            at = f"{tree}_{level}"
            ctes += [
                f"""total_{at} AS MATERIALIZED (SELECT target, node, count(*) AS n, sum(r) AS s, sum(r * r) AS q FROM at_{at}
  WHERE train AND node >= {2 ** level - 1} GROUP BY ALL)""",
                f"""cells_{at} AS MATERIALIZED (SELECT target, node, f, code, count(*) AS n, sum(r) AS s FROM at_{at} JOIN codes USING ("PLAYER_ID", "GAME_ID")
  WHERE train GROUP BY ALL)""",
                f"""sides_{at} AS (SELECT t.*, e.f, e.e, e.edge, ways.missing_left,
    coalesce(sum(c.n) FILTER (c.code >= 0 OR missing_left), 0) AS nl, coalesce(sum(c.s) FILTER (c.code >= 0 OR missing_left), 0) AS sl
  FROM total_{at} t CROSS JOIN edges e CROSS JOIN (VALUES (true), (false)) ways(missing_left)
  LEFT JOIN cells_{at} c ON c.target = t.target AND c.node = t.node AND c.f = e.f AND c.code <= e.e GROUP BY ALL)""",
                f"""gains_{at} AS (SELECT *, sl * sl / (nl + {p.l2}) + (s - sl) * (s - sl) / (n - nl + {p.l2}) - s * s / (n + {p.l2}) AS gain
  FROM sides_{at} WHERE nl >= {p.least_rows} AND n - nl >= {p.least_rows} AND q > 0)""",
                f"""best_{at} AS MATERIALIZED (SELECT * FROM gains_{at} WHERE floor(gain / q * {boosting.STEPS} + 0.5) >= 1
  QUALIFY row_number() OVER (PARTITION BY target, node ORDER BY floor(gain / q * {boosting.STEPS} + 0.5) DESC, f, e, missing_left DESC) = 1)""",
                f"""at_{tree}_{level + 1} AS MATERIALIZED (SELECT a.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN a.node
    WHEN CASE WHEN code = -1 THEN missing_left ELSE code <= b.e END THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM at_{at} a LEFT JOIN best_{at} b ON b.target = a.target AND b.node = a.node
  LEFT JOIN codes c ON c."PLAYER_ID" = a."PLAYER_ID" AND c."GAME_ID" = a."GAME_ID" AND c.f = b.f)"""]
        ctes += [
            f"""leaves_{tree} AS MATERIALIZED (SELECT target, node, count(*) AS n, {p.rate} * sum(r) / (count(*) + {p.l2}) AS value
  FROM at_{tree}_{p.depth} WHERE train GROUP BY ALL)""",
            f"trees_{tree} AS (" + " UNION ALL ".join(
                f"SELECT target, {tree} AS tree, node, f, edge, missing_left, n, gain, NULL::DOUBLE AS value FROM best_{tree}_{level}" for level in range(p.depth)
            ) + f" UNION ALL SELECT target, {tree}, node, NULL, NULL, NULL, n, NULL, value FROM leaves_{tree})",
            f"""scored_{tree + 1} AS MATERIALIZED (SELECT a.* EXCLUDE (node, predicted, r), predicted + value AS predicted, r - value AS r, 0 AS node
  FROM at_{tree}_{p.depth} a JOIN leaves_{tree} USING (target, node))"""]
    listed = ", ".join(f"'{name}'" for name in SMALL_FEATURES)
    ctes.append("trees AS MATERIALIZED (SELECT target, -1 AS tree, 0 AS node, NULL AS feature, NULL AS edge, NULL AS missing_left, NULL AS n, NULL AS gain, mean AS value FROM base"
                + "".join(f" UNION ALL SELECT target, tree, node, [{listed}][f + 1], edge, missing_left, n, gain, value FROM trees_{i}" for i in range(p.rounds)) + ")")
    return ctes


SMALL_CTES = train_sql()
SCORED_SQL = f"""scored AS (SELECT {KEYS}, target, actual, mean AS baseline_prediction, predicted FROM scored_{SMALL.boosting.rounds}
  JOIN base USING (target) WHERE NOT train)"""


def loaded_models(t: Tables):
    """The small run, written and read back: (split, models)."""
    data = small_data(t)
    path = scratch_path(t.spark, "models")
    training.train_models(data, SMALL).save(t.spark, path)
    return data, training.load_models(t.spark, path, SMALL, data.features, data.targets)


@query("train_trees", with_ctes(SMALL_CTES, f"""
SELECT target, {whole('tree')} AS tree, {whole('node')} AS node, feature, {rounded('edge', 4)} AS threshold, {whole('missing_left')} AS missing_left,
  {whole('n')} AS rows, {rounded('gain', 4)} AS gain, {rounded('value', 6)} AS value FROM trees"""))
def train_trees(t: Tables):
    """Every node of the small run's trees."""
    return publish(training.train_models(small_data(t), SMALL).table(t.spark), 4, value=6)


@query("train_predictions", with_ctes([*SMALL_CTES, SCORED_SQL], f"""
SELECT {KEYS}, target, {rounded('actual', 3)} AS actual, {rounded('baseline_prediction', 6)} AS baseline_prediction,
  {rounded('predicted', 6)} AS gbt_small_prediction FROM scored"""))
def train_predictions(t: Tables):
    """The test rows as the loaded models of the small run predict them."""
    data, models = loaded_models(t)
    predictions = training.test_predictions(data, models)
    return publish(predictions.select("PLAYER_ID", "GAME_ID", "target", "actual", "baseline_prediction", SMALL.prediction_column), 6, actual=3)


@query("trained_metrics", with_ctes([*SMALL_CTES, SCORED_SQL], f"""
SELECT target, {metric_sql('actual', 'baseline_prediction', 'baseline')}, {metric_sql('actual', 'predicted', 'gbt_small')} FROM scored GROUP BY target"""))
def trained_metrics(t: Tables):
    """Metrics of the small run and of the baseline."""
    metrics, _, _ = modelling.train_and_evaluate(small_data(t), SMALL)
    return publish(metrics, 3, baseline_r2=6, gbt_small_r2=6)


@query("gain_importance", with_ctes(SMALL_CTES, f"""
SELECT target, feature, {rounded('gain', 4)} AS gain, {rounded('gain / total', 8)} AS gain_share, {rounded('average', 4)} AS average_gain,
  row_number() OVER (PARTITION BY target ORDER BY gain DESC, ordinal) AS rank
FROM (SELECT base.target, l.feature, l.ordinal, coalesce(g.gain, 0) AS gain, coalesce(g.average, 0) AS average, sum(coalesce(g.gain, 0)) OVER (PARTITION BY base.target) AS total
  FROM base CROSS JOIN (SELECT unnest({SMALL_FEATURES}) AS feature, unnest(range({len(SMALL_FEATURES)})) AS ordinal) l
  LEFT JOIN (SELECT target, feature, sum(gain) AS gain, avg(gain) AS average FROM trees WHERE feature IS NOT NULL GROUP BY ALL) g
    ON g.target = base.target AND g.feature = l.feature)"""))
def gain_importance(t: Tables):
    """Total and average gain of every feature in the trees of the small run."""
    trees = stored(training.train_models(small_data(t), SMALL).table(t.spark), "trees")
    table = importance.importance_table(training.gain_scores(trees), SMALL_FEATURES, SMALL.name)
    average = training.gain_scores(trees, average=True).withColumnRenamed("gain", "average_gain")
    joined = table.join(average, ["target", "feature"], "left").withColumn("average_gain", F.coalesce("average_gain", F.lit(0.0)))
    return publish(joined.select("target", "feature", "gain", "gain_share", "average_gain", "rank"), 4, gain_share=8)
