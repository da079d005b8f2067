"""JOB-EVAL: predictions scored against stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions.text import field_text, is_valid_json
from newsquake.operators.ranking import running_totals, sample_per_group, top_k

UNPARSEABLE = "UNPARSEABLE"


def score(rows: DataFrame, predictions: DataFrame) -> DataFrame:
    """Rows joined to each model's text, with the parsed prediction and its checks.

    A reaction row is scored by its label, an analysis row by its recommendation; any other task
    raises. Both sides hold a row once, so the join key is unique on the left.
    """
    text = F.col("text")
    unknown = F.raise_error(F.concat(F.lit("unknown task: "), F.coalesce(F.col("task"), F.lit("null")))).cast("string")

    def by_task(reaction, analysis):
        return F.when(F.col("task") == "reaction", reaction).when(F.col("task") == "analysis", analysis)

    def filled(pattern: str):
        return F.coalesce(F.trim(field_text(text, pattern)) != "", F.lit(False))

    expected = by_task(F.col("news_reaction"), F.col("recommendation")).otherwise(unknown)
    predicted = by_task(field_text(text, K.REACTION_FIELD_PATTERN), field_text(text, K.RECOMMENDATION_FIELD_PATTERN))
    nonempty = by_task(F.lit(None).cast("boolean"), filled(K.ANSWER_FIELD_PATTERN) & filled(K.REASONING_FIELD_PATTERN))
    return (
        rows.join(predictions, "row_id")
        .withColumns({"expected": expected, "predicted": predicted, "json_ok": is_valid_json(text), "nonempty": nonempty})
        .withColumn("correct", F.coalesce(F.col("predicted") == F.col("expected"), F.lit(False)))
    )


def accuracy(scored: DataFrame) -> DataFrame:
    """Counts and rates per task and model, by source and, with a null source, overall."""
    return (
        scored.groupingSets(
            [["task", "model", "source"], ["task", "model"]], "task", "model", "source"
        )
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("correct").alias("correct"),
            F.count_if("json_ok").alias("json_ok"),
            F.count_if("nonempty").alias("nonempty"),
        )
        .select(
            "task", "model", "source", "total", "correct", "json_ok", "nonempty",
            (F.col("correct") / F.col("total")).alias("accuracy"),
            (F.col("json_ok") / F.col("total")).alias("json_rate"),
            (F.col("nonempty") / F.col("total")).alias("nonempty_rate"),
        )
    )


def confusion(scored: DataFrame) -> DataFrame:
    """Counts per (task, model, source, expected, predicted); text without a prediction is kept as null."""
    return scored.groupBy("task", "model", "source", "expected", "predicted").agg(F.count(F.lit(1)).alias("n"))


def confusion_report(scored: DataFrame) -> DataFrame:
    """Confusion in reading order, a missing prediction first and named."""
    ordered = confusion(scored).orderBy("task", "model", "source", "expected", F.col("predicted").asc_nulls_first())
    return ordered.withColumn("predicted", F.coalesce("predicted", F.lit(UNPARSEABLE)))


def class_recall(scored: DataFrame) -> DataFrame:
    """Recall per reaction class over all sources, with the fixed class position."""
    position = F.array_position(F.array(*[F.lit(r) for r in K.REACTIONS]), F.col("expected")).cast("int")
    return (
        scored.where(F.col("task") == "reaction")
        .groupBy("model", "expected")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("correct").alias("correct"))
        .withColumns({"recall": F.col("correct") / F.col("total"), "position": position})
    )


def cell_accuracy(scored: DataFrame) -> DataFrame:
    """Agreement per (reaction, bucket); a missing bucket is 'unknown'."""
    bucket = F.coalesce(F.nullif(F.col("valuation_bucket"), F.lit("")), F.lit("unknown"))
    return (
        scored.where(F.col("task") == "analysis")
        .groupBy("model", "news_reaction", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("correct").alias("correct"))
        .withColumn("accuracy", F.col("correct") / F.col("total"))
    )


def ship_gate(scored: DataFrame, gate: float = K.SHIP_GATE) -> DataFrame:
    """Overall agreement per model, the weakest cell, and whether the gate is met."""
    # At most 5 x 5 cells per model.
    return (
        cell_accuracy(scored)
        .groupBy("model")
        .agg(
            F.sum("total").alias("total"),
            F.sum("correct").alias("correct"),
            F.count(F.lit(1)).alias("cells"),
            F.min("accuracy").alias("worst_cell"),
        )
        .withColumn("agreement", F.col("correct") / F.col("total"))
        .withColumn("ships", F.col("agreement") >= gate)
    )


def running_accuracy(scored: DataFrame, task: str = "reaction", step: int = K.PROGRESS_STEP) -> DataFrame:
    """(model, i, accuracy so far) after every step-th row in row order."""
    rows = scored.where(F.col("task") == task).select("model", "row_id", F.col("correct").cast("int").alias("hit"))
    running = running_totals(rows, ["model"], "row_id", ["hit"])
    return running.where(F.col("running_n") % step == 0).select(
        "model",
        F.col("running_n").alias("i"),
        (F.col("running_hit") / F.col("running_n")).alias("accuracy"),
    )


def compare_models(scored: DataFrame, tuned: str, base: str) -> DataFrame:
    """Accuracy of two models side by side, by source and overall."""

    def share(model: str):
        return F.try_divide(
            F.count_if((F.col("model") == model) & F.col("correct")), F.count_if(F.col("model") == model)
        )

    return (
        scored.groupingSets([["task", "source"], ["task"]], "task", "source")
        .agg(share(tuned).alias("tuned"), share(base).alias("base"))
        .select("task", "source", "tuned", "base", (F.col("tuned") - F.col("base")).alias("delta"))
    )


def misclassified_samples(scored: DataFrame, per_pair: int = K.SAMPLES_PER_PAIR) -> DataFrame:
    """The first few wrong reaction rows per (model, source, expected, predicted), in row order."""
    wrong = scored.where((F.col("task") == "reaction") & ~F.col("correct"))
    return top_k(wrong, ["model", "source", "expected", "predicted"], [F.col("row_id")], per_pair)


def mismatches(scored: DataFrame, model: str, limit: int = K.MISMATCH_LIMIT) -> DataFrame:
    """The first wrong recommendations of one model, in row order; a top-k report."""
    wrong = scored.where((F.col("task") == "analysis") & (F.col("model") == model) & ~F.col("correct"))
    return wrong.orderBy("row_id").limit(limit)


def eval_sample(rows: DataFrame, per_group: int = 100, ids: Sequence[str] = ("row_id",), seed: str = "eval") -> DataFrame:
    """A fixed-size sample per task and source; smaller groups are taken whole."""
    keyed = rows.withColumn("_group", F.concat_ws("|", "task", "source"))
    targets = keyed.select("_group").distinct().withColumn("target", F.lit(per_group).cast("long"))
    return sample_per_group(keyed, "_group", targets, ids, seed).drop("_group")
