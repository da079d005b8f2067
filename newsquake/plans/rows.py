"""JOB-ROWS and JOB-BALANCE: reaction and analysis rows, splits and class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions import render
from newsquake.functions.numeric import draw_bits
from newsquake.functions.text import parse_generated_text
from newsquake.operators.ranking import sample_per_group
from newsquake.schemas import ROW_FIELDS


def reaction_row() -> Column:
    """The 12-field row that carries only the label."""
    filled = {
        "task": F.lit("reaction"),
        "ticker": F.col("ticker"),
        "price_context": F.col("price_context"),
        "news": F.col("news"),
        "news_reaction": F.col("news_reaction"),
        "output": F.to_json(F.struct(F.col("news_reaction"))),
    }
    return F.struct(*[filled.get(name, F.lit("")).alias(name) for name in ROW_FIELDS])


def analysis_row() -> Column:
    """The 12-field row with fundamentals, recommendation and prose."""
    output = F.to_json(F.struct("recommendation", "reasoning", "answer"))
    filled = {"task": F.lit("analysis"), "output": output}
    return F.struct(*[filled.get(name, F.col(name)).alias(name) for name in ROW_FIELDS])


def explode_rows(df: DataFrame, keys: Sequence[str], analysis: bool = True) -> DataFrame:
    """One or two stored rows per input row, beside its key columns."""
    structs = [reaction_row(), analysis_row()] if analysis else [reaction_row()]
    return df.select(*keys, F.explode(F.array(*structs)).alias("r")).select(*keys, "r.*")


def finished_rows(
    fused: DataFrame,
    today: Column,
    holdout: Sequence[str] = (),
    responses: DataFrame | None = None,
    analysis: bool = True,
    key: str = "feed_pos",
) -> DataFrame:
    """Rows of kept headlines: (feed_pos, split, 12 fields).

    fused carries labels, valuation and recommendation per headline. responses, when given, has
    generated texts by (feed_pos, text); a missing or rejected part falls back on its own.
    """
    usable = fused.where(F.col("news_reaction").isNotNull())
    if responses is not None:
        usable = usable.join(responses.select(key, F.col("text").alias("_text")), key, "left")
    else:
        usable = usable.withColumn("_text", F.lit(None).cast("string"))
    line = render.headline_line(F.col("as_of"), F.col("title"), F.col("publisher"))
    kind, question = render.user_query(F.col("ticker"), F.col(key))
    text = render.price_context(render.blocks(usable)).withColumns(
        {
            "news": render.news_block(F.array(line), F.col(key), today),
            "_kind": kind,
            "user_query": question,
            "_parsed": parse_generated_text(F.col("_text")),
            "split": split_of(F.col("ticker"), holdout),
        }
    )
    prose = text.withColumns(
        {
            "reasoning": F.coalesce(
                "_parsed.reasoning",
                render.fallback_reasoning(F.col("ticker"), F.col("news_reaction"), F.col("recommendation")),
            ),
            "answer": F.coalesce(
                "_parsed.answer", render.answer(F.col("_kind"), F.col("recommendation"), F.col("ticker"))
            ),
        }
    )
    return explode_rows(prose, [key, "split"], analysis)


def split_of(ticker: Column, holdout: Sequence[str], template_held_out: Column | None = None) -> Column:
    held = ticker.isin(*holdout) if holdout else F.lit(False)
    if template_held_out is not None:
        held = held | template_held_out
    return F.when(held, "val").otherwise("train")


def pending(entities: DataFrame, done: DataFrame, on: Sequence[str] = ("ticker",)) -> DataFrame:
    """Entities, or combinations of `on`, without any stored row."""
    return entities.join(done.select(*on).distinct(), list(on), "left_anti")


def class_targets(rows: DataFrame, floor: int = K.REBALANCE_FLOOR) -> DataFrame:
    """(news_reaction, n, target): the larger of the floor and the two overreaction classes together."""
    counts = rows.where(F.col("task") == "reaction").groupBy("news_reaction").agg(F.count(F.lit(1)).alias("n"))
    # One row per class, five at most.
    rare = F.sum(F.when(F.col("news_reaction").startswith("overreaction_"), F.col("n")).otherwise(0)).over(
        Window.partitionBy(F.lit(0))
    )
    return counts.withColumn("target", F.greatest(F.lit(floor), rare))


def rebalance(rows: DataFrame, ids: Sequence[str], seed: str = "rebalance") -> DataFrame:
    """All overreaction rows and other tasks, and at most the target of each remaining class."""
    ordinary = (F.col("task") == "reaction") & ~F.col("news_reaction").startswith("overreaction_")
    targets = class_targets(rows).select("news_reaction", "target")
    sampled = sample_per_group(rows.where(ordinary), "news_reaction", targets, ids, seed)
    return rows.where(~F.coalesce(ordinary, F.lit(False))).unionByName(sampled.select(*rows.columns))


def shuffled(rows: DataFrame, ids: Sequence[str], seed: str = "order") -> DataFrame:
    """Rows in hash order, the same order on every run."""
    return rows.orderBy(draw_bits(*[F.col(c) for c in ids], seed), *ids)
