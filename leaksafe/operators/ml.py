"""Models on Spark ML: feature registry, derived features, split, boosted trees, scoring, reports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import progress
from leaksafe.operators import evaluate, scenario

# The game model's columns.
TEAM_MEASURES = (
    "epa_pp_blended", "def_epa_pp_blended", "epa_pp_std", "pass_epa_std", "rush_epa_std", "def_epa_pp_std",
    "def_pass_epa_std", "def_rush_epa_std", "success_rate_std", "def_success_rate_allowed_std",
    "explosive_pass_rate_std", "pass_rate_std", "turnovers_pg_std", "def_to_forced_std", "rz_td_rate_std",
    "pts_for_std", "pts_against_std", "sacks_allowed_std", "def_sacks_std", "epa_pp_l5", "epa_pp_l3",
    "games_played", "rest_days", "bye_prior", "short_week", "injury_burden", "qb_out", "wr_burden",
)
GAME_MEASURES = (
    "rest_days_advantage_home", "div_game", "conf_game", "primetime_flag", "opening_spread", "opening_total",
    "opening_home_win_prob",
)
DIFFERENCES = {
    "epa_diff": "epa_pp_blended",
    "def_epa_diff": "def_epa_pp_blended",
    "pass_epa_diff": "pass_epa_std",
    "rush_epa_diff": "rush_epa_std",
    "success_rate_diff": "success_rate_std",
    "injury_burden_diff": "injury_burden",
    "pts_diff": "pts_for_std",
    "epa_l5_diff": "epa_pp_l5",
    "epa_l3_diff": "epa_pp_l3",
}
FLAGS = (
    "div_game", "conf_game", "primetime_flag", "home_bye_prior", "away_bye_prior", "home_short_week",
    "away_short_week", "home_qb_out", "away_qb_out",
)
WEEKS_AFTER_FIRST = 17
IDENTIFIERS = (
    "game_id", "season", "week", "game_date", "home_team", "away_team", "cv_split", "game_completed_flag", "season_type",
)
TARGETS = (
    "home_margin", "total_points", "home_win_flag", "home_score", "away_score", "home_covered_close", "over_close_flag",
)
GAME_MODELS = {
    "margin": ("home_margin", "regression"),
    "total": ("total_points", "regression"),
    "win_prob": ("home_win_flag", "classification"),
}


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns identify, which are predicted, which predict."""

    identifiers: Sequence[str] = IDENTIFIERS
    targets: Sequence[str] = TARGETS
    features: Sequence[str] = field(default_factory=lambda: game_features())

    def available(self, df: DataFrame) -> list[str]:
        return [c for c in self.features if c in df.columns]

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.features if c not in df.columns]


def game_features() -> tuple[str, ...]:
    sides = [f"{side}_{m}" for m in TEAM_MEASURES for side in ("home", "away")]
    return (*sides, *GAME_MEASURES, *DIFFERENCES, "net_epa_diff", "home_field", "week_normalized")


def engineer(df: DataFrame) -> DataFrame:
    """Home-minus-away differences, season progress and 0/1 flags without NULL."""
    added = {out: F.col(f"home_{m}") - F.col(f"away_{m}") for out, m in DIFFERENCES.items()}
    df = df.withColumns(added).withColumn("net_epa_diff", F.col("epa_diff") - F.col("def_epa_diff"))
    flags = {c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in FLAGS}
    return df.withColumns({"home_field": F.lit(1), "week_normalized": progress("week", WEEKS_AFTER_FIRST), **flags})


def split(df: DataFrame, label: str = "cv_split") -> dict[str, DataFrame]:
    return {name: df.filter(F.col(label) == name) for name in ("train", "validation", "test")}


def split_counts(df: DataFrame, label: str = "cv_split") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({f"f_{c}": F.col(c).cast("double") for c in names})


def assemble(names: Sequence[str]) -> list:
    """Stages that fill missing values with the median and build the feature vector."""
    raw, filled = [f"f_{c}" for c in names], [f"i_{c}" for c in names]
    return [
        Imputer(inputCols=raw, outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep"),
    ]


@dataclass
class Model:
    name: str
    target: str
    kind: str
    features: list[str]
    pipeline: PipelineModel

    def importance(self) -> list[tuple[str, float]]:
        weights = self.pipeline.stages[-1].featureImportances.toArray()
        return sorted(zip(self.features, map(float, weights)), key=lambda p: -p[1])


def train(
    train_df: DataFrame,
    validation_df: DataFrame,
    spec: FeatureSpec,
    models: Mapping[str, tuple[str, str]] = GAME_MODELS,
    *,
    max_iter: int = 100,
    max_depth: int = 4,
    step: float = 0.05,
    seed: int = 42,
) -> dict[str, Model]:
    """Boosted trees per target; training stops early on the validation rows.

    Features without any value in the training rows are left out.
    """
    names = spec.available(train_df)
    both = train_df.withColumn("__val", F.lit(False)).unionByName(validation_df.withColumn("__val", F.lit(True)))
    seen = train_df.agg(*[F.count(c).alias(c) for c in names]).first()
    names = [c for c in names if seen[c] > 0]
    both = _numeric(both, names)
    out = {}
    for name, (target, kind) in models.items():
        rows = both.filter(F.col(target).isNotNull()).withColumn("__label", F.col(target).cast("double"))
        settings = {
            "featuresCol": "features", "labelCol": "__label", "validationIndicatorCol": "__val", "maxIter": max_iter,
            "maxDepth": max_depth, "stepSize": step, "subsamplingRate": 0.8, "minInstancesPerNode": 10, "seed": seed,
        }
        learner = GBTClassifier(**settings) if kind == "classification" else GBTRegressor(**settings)
        fitted = Pipeline(stages=[*assemble(names), learner]).fit(rows)
        out[name] = Model(name, target, kind, names, fitted)
    return out


def score(df: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Add `pred_{name}` per model: a value, or the probability of 1."""
    for name, model in models.items():
        rows = _numeric(df, model.features)
        scored = model.pipeline.transform(rows)
        pred = vector_to_array("probability")[1] if model.kind == "classification" else F.col("prediction")
        df = scored.select(*df.columns, pred.alias(f"pred_{name}"))
    return df


def save(models: Mapping[str, Model], path: str, **facts) -> None:
    """Write every fitted model, its importances and one line of metadata."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    for name, model in models.items():
        model.pipeline.write().overwrite().save(f"{path}/{name}")
        spark.createDataFrame(model.importance(), "feature string, importance double").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/{name}_importance")
    meta = {"models": {m.name: [m.target, m.kind, m.features] for m in models.values()}, **facts}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark, path: str) -> dict[str, Model]:
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return {
        name: Model(name, target, kind, features, PipelineModel.load(f"{path}/{name}"))
        for name, (target, kind, features) in meta["models"].items()
    }


def predict(df: DataFrame, models: Mapping[str, Model], *, id: str, n: int = scenario.N_DRAWS, **sds) -> DataFrame:
    """Score rows, simulate each and add expected values. `id` is an integer key for the draws."""
    scored = score(df, models)
    lines = [F.col(c) if c in df.columns else None for c in ("opening_spread", "opening_total")]
    simulated = scenario.summarise(scored, id, "pred_margin", "pred_total", *lines, n=n, **sds)
    market = "opening_home_win_prob" if "opening_home_win_prob" in df.columns else None
    return scenario.with_ev(simulated, win_prob="pred_win_prob", market_prob=market)


def validate(scored: DataFrame, label: str = "cv_split", only: str = "test") -> dict[str, DataFrame]:
    """All reports over one split (or all rows) of scored games with outcomes."""
    rows = scored if only == "all" else scored.filter(F.col(label) == only)
    return evaluate.report(
        rows,
        regressions={"spread": ("home_margin", "pred_margin"), "total": ("total_points", "pred_total")},
        classifications={"winprob": ("home_win_flag", "pred_win_prob")},
        segments={
            "season_type": "season_type",
            "cv_split": label,
            "division": F.when(F.col("div_game") == 1, "div_game").when(F.col("div_game") == 0, "non_div_game"),
            "primetime": F.when(F.col("primetime_flag") == 1, "primetime").when(F.col("primetime_flag") == 0, "non_primetime"),
        },
        period="season",
        line="opening_spread" if "opening_spread" in rows.columns else None,
        spread=("home_margin", "opening_spread", "p_home_cover", "p_away_cover"),
        total=("total_points", "opening_total", "p_over", "p_under"),
        lines=("pred_margin", "opening_spread", "closing_spread") if "closing_spread" in rows.columns else None,
        tie=["game_id"],
    )


def run(backtest: DataFrame, upcoming: DataFrame | None, *, id: str, spec: FeatureSpec | None = None, **settings):
    """Train on the backtest mart, report on its test split, and predict upcoming rows.

    Returns the models, the reports and the predictions (None without upcoming rows).
    """
    spec = spec or FeatureSpec()
    rows = engineer(backtest)
    parts = split(rows)
    models = train(parts["train"], parts["validation"], spec, **settings)
    reports = validate(predict(rows, models, id=id))
    predictions = None if upcoming is None else predict(engineer(upcoming), models, id=id)
    return models, reports, predictions
