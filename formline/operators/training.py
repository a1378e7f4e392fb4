"""Boosted trees per target: parameter sets, training, saved models, predictions, gains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import names as N
from formline.operators import boosting, evaluate
from formline.operators.boosting import Boosting
from formline.operators.split import ModellingData


@dataclass(frozen=True)
class ParameterSet:
    """Boosting parameters under the name that predictions, metrics and files carry."""

    name: str
    label: str
    boosting: Boosting

    @property
    def prediction_column(self) -> str:
        return f"{self.name}_prediction"


DEEP = ParameterSet("gbt_deep", "Deep trees", Boosting(rounds=100, depth=6, rate=0.3))
GRADUAL = ParameterSet("gbt_gradual", "Gradual trees", Boosting(rounds=100, depth=5, rate=0.1))
PARAMETER_SETS = {one.name: one for one in (DEEP, GRADUAL)}


def parameter_set(name: str) -> ParameterSet:
    try:
        return PARAMETER_SETS[name]
    except KeyError:
        raise ValueError(f"There is no parameter set {name!r}; known ones are {sorted(PARAMETER_SETS)}.") from None


@dataclass
class TrainedModels:
    """The trees of all targets. ``trees`` are rows of ``boosting.TREES``; they grow with the parameters, not with the data."""

    parameters: ParameterSet
    features: list[str]
    targets: list[str]
    trees: list[dict]

    def table(self, spark: SparkSession) -> DataFrame:
        columns = [part.split()[0] for part in boosting.TREES.split(", ")]
        return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in self.trees], boosting.TREES)

    def predict(self, df: DataFrame, prefix: str = "_prediction_") -> DataFrame:
        """``df`` with a column per target."""
        return df.withColumns({f"{prefix}{target}": boosting.prediction(self.trees, target, self.features) for target in self.targets})

    def save(self, spark: SparkSession, path: str) -> None:
        """One folder per target with its trees as a Parquet table."""
        table = self.table(spark)
        for target in self.targets:
            table.filter(F.col("target") == target).coalesce(1).write.mode("overwrite").parquet(f"{path}/{N.target_file_name(self.parameters.name, target)}")


def saved_trees(spark: SparkSession, path: str, model: str, target: str) -> DataFrame:
    """The table of a saved model; a missing one raises ``FileNotFoundError``."""
    full = f"{path}/{N.target_file_name(model, target)}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(full)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise FileNotFoundError(f"There is no saved {model} model of {target} at {full}.")
    return spark.read.schema(boosting.TREES).parquet(full)


def load_models(spark: SparkSession, path: str, parameters: ParameterSet, features: Sequence[str], targets: Sequence[str]) -> TrainedModels:
    """Models written by ``save``; as many rows as their trees have nodes."""
    trees = [row.asDict() for target in targets for row in saved_trees(spark, path, parameters.name, target).orderBy("tree", "node").collect()]
    return TrainedModels(parameters, list(features), list(targets), trees)


def train_models(modelling: ModellingData, parameters: ParameterSet, targets: Sequence[str] | None = None) -> TrainedModels:
    """All targets together, the primary one first. Pass a written table (``write_split``): it is read a few times."""
    chosen = sorted(targets or modelling.targets, key=lambda target: target != fv.PRIMARY_TARGET)
    trees = boosting.boost(modelling.train, modelling.features, chosen, parameters.boosting)
    return TrainedModels(parameters, list(modelling.features), chosen, trees)


def test_predictions(modelling: ModellingData, trained: TrainedModels) -> DataFrame:
    """Long (keys, target, actual, baseline and model prediction) for the test rows, from one pass over them."""
    means = {row["target"]: row["value"] for row in trained.trees if row["tree"] < 0}
    scored = trained.predict(modelling.test)
    rows = F.array(*[
        F.struct(
            F.lit(target).alias("target"),
            F.col(target).cast("double").alias("actual"),
            F.lit(means[target]).cast("double").alias("baseline_prediction"),
            F.col(f"_prediction_{target}").alias(trained.parameters.prediction_column),
        )
        for target in trained.targets
    ])
    return scored.select(*modelling.keys, F.inline(rows))


test_predictions.__test__ = False


def train_all_targets(
    modelling: ModellingData, parameters: ParameterSet, models_path: str | None = None,
    targets: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, TrainedModels]:
    """(metrics per target, long predictions, models); the models are saved when a path is given."""
    trained = train_models(modelling, parameters, targets)
    if models_path:
        trained.save(modelling.data.sparkSession, models_path)
    predictions = test_predictions(modelling, trained)
    metrics = evaluate.regression_metrics(
        predictions, {"baseline": "baseline_prediction", parameters.name: parameters.prediction_column}
    )
    if models_path:
        file_name = F.concat(F.lit(f"{models_path}/{parameters.name}_"), F.lower("target"))
        metrics = metrics.withColumn("model_path", file_name)
    return metrics, predictions, trained


def gain_scores(trees: DataFrame, average: bool = False) -> DataFrame:
    """(target, feature, gain): the gains of a feature's splits, added up or on average per split.

    Features that no tree splits on do not appear; ``importance_table`` gives them gain 0.
    """
    total = (F.avg if average else F.sum)("gain")
    return trees.filter("feature is not null").groupBy("target", "feature").agg(total.alias("gain"))


def saved_gain_scores(spark: SparkSession, path: str, model: str, targets: Sequence[str], average: bool = False) -> DataFrame:
    """The same from saved models."""
    found = gain_scores(saved_trees(spark, path, model, targets[0]), average)
    for target in targets[1:]:
        found = found.unionByName(gain_scores(saved_trees(spark, path, model, target), average))
    return found
