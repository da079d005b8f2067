"""JOB-TEMPLATE: rows built from template pools, entities and real valuations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions import render
from newsquake.functions.numeric import draw, draw_index, fill, weighted_choice
from newsquake.functions.reaction import fuse, text_gap
from newsquake.operators.lookup import computed_once, skew_safe_join
from newsquake.operators.ranking import running_totals
from newsquake.plans.rows import explode_rows, split_of


def pool_of(direction: Column, tier: Column) -> Column:
    """Where a template goes: flat tiers to neutral, BUY to good, everything else to bad."""
    return F.when(tier.isin("extreme_alone", "moderate_alone"), "neutral").when(direction == "BUY", "good").otherwise("bad")


def merge_pools(*pools: DataFrame) -> DataFrame:
    """Union of (pool, order_key, headlines, reasonings) tables, numbered from 0 within each pool; order keys differ within a pool."""
    merged = pools[0]
    for pool in pools[1:]:
        merged = merged.unionByName(pool)
    numbered = running_totals(merged, ["pool"], "order_key", [])  # no pool is ordered in one task
    return numbered.withColumn("idx", F.col("running_n").cast("int") - 1).drop("running_n")


def holdout_indices(pools: DataFrame, fraction: float = K.HOLDOUT_FRACTION) -> DataFrame:
    """(pool, idx) of the evenly spaced held-out templates, at the middle of each stride."""
    sizes = pools.groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    k = F.greatest(F.lit(1), F.floor(F.col("n") * fraction).cast("int"))
    place = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    return (
        sizes.withColumn("k", k)
        .withColumn("i", place)
        .select("pool", F.floor((F.col("i") + 0.5) * (F.col("n") / F.col("k"))).cast("int").alias("idx"))
    )


def mark_holdout(pools: DataFrame) -> DataFrame:
    held = holdout_indices(pools).withColumn("held_out", F.lit(True))
    return pools.join(held, ["pool", "idx"], "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


def draws(keys: DataFrame, key: str, entity_count: Column | int, weights=K.REACTION_WEIGHTS) -> DataFrame:
    """A weighted reaction and a uniform entity number for every key."""
    drawn = {"_drawn": draw(F.col(key), "reaction"), "entity_no": draw_index(entity_count, F.col(key), "entity")}
    once = computed_once(keys, drawn)  # the share drawn is compared with each weight
    return once.select(*keys.columns, weighted_choice(weights, F.col("_drawn")).alias("news_reaction"), "entity_no")


def draws_of(keys: DataFrame, key: str, entities: DataFrame, order: str) -> DataFrame:
    """Draws over all rows of `entities`, numbered from 0 by `order`, with the fields of the entity drawn."""
    numbered = running_totals(entities.withColumn("_all", F.lit(1)), ["_all"], order, [])
    numbered = numbered.withColumn("_no", F.col("running_n").cast("int") - 1).drop("running_n", "_all", order)
    count = entities.agg(F.count(F.lit(1)).cast("int")).scalar()
    drawn = draws(keys, key, count)
    joined = skew_safe_join(drawn.withColumnRenamed("entity_no", "_no"), numbered, ["_no"], [key], "inner")
    return joined.withColumnRenamed("_no", "entity_no")


def fill_fields(template: Column, fields: Sequence[str]) -> Column:
    return fill(template, **{name: F.col(name).cast("string") for name in fields})


def rendered_days(valued: DataFrame) -> DataFrame:
    """What draws need of a valued day; the texts are built once per (ticker, as_of), not per draw."""
    return render.blocks(valued).select(
        "ticker", "as_of", "market_data", "valuation", "earnings", "operating_margin", "roe", "peg_ratio",
        text_gap(F.col("gap_pct")).alias("shown_gap_pct"),
    )


def template_rows(
    drawn: DataFrame,
    pools: DataFrame,
    sector_news: DataFrame,
    fields: Sequence[str],
    today: Column,
    holdout: Sequence[str] = (),
    key: str = "draw_id",
    days: DataFrame | None = None,
) -> DataFrame:
    """Stored rows for draws: (draw_id, split, 12 fields).

    drawn has one row per draw with news_reaction, ticker, sector, the fill fields, move_pct and
    the columns of a rendered day (see rendered_days). pools holds (pool, idx, headlines, reasonings); sector_news holds
    (sector, good_headline, bad_headline, good_reasoning, bad_reasoning) and replaces some good and bad headlines.
    Rendered days are joined by (ticker, as_of) after the templates if they are given apart, in `days`: their texts are
    the widest columns and then move once.
    """
    marked = mark_holdout(pools)
    # A pool per reaction class: few sizes, which reach every row as a map, as a join by class would move all draws to a few tasks.
    sizes = pools.where("pool is not null").groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    size_of = sizes.agg(F.map_from_entries(F.collect_list(F.struct("pool", "n")))).scalar()
    sized = drawn.drop("pool").withColumn("_size", F.try_element_at(size_of, F.col("news_reaction"))).where(F.col("_size").isNotNull())
    placed = computed_once(sized, {"idx": draw_index(F.col("_size"), F.col(key), "template")}).drop("_size")
    placed = placed.withColumnRenamed("news_reaction", "pool")
    joined = skew_safe_join(placed, marked, ["pool", "idx"], [key], "inner").withColumnRenamed("pool", "news_reaction")
    # An entity and day hold few draws, and the texts are too wide to be repeated for salts.
    joined = joined if days is None else joined.join(days, ["ticker", "as_of"])
    joined = skew_safe_join(joined, sector_news, ["sector"], [key], "left")

    directed = F.col("news_reaction").isin("good", "bad")
    swapped = directed & F.col("good_headline").isNotNull() & (draw(F.col(key), "sector-override") < K.SECTOR_OVERRIDE_RATE)
    sector_line = F.when(F.col("news_reaction") == "good", F.col("good_headline")).otherwise(F.col("bad_headline"))
    sector_text = F.when(F.col("news_reaction") == "good", F.col("good_reasoning")).otherwise(F.col("bad_reasoning"))
    own_text = F.element_at("reasonings", draw_index(F.size("reasonings"), F.col(key), "reasoning") + 1)
    chosen = joined.withColumn("_swapped", F.coalesce(swapped, F.lit(False))).withColumns(
        {
            "_headlines": F.when(F.col("_swapped"), F.array(sector_line)).otherwise(F.col("headlines")),
            "_reasoning": F.when(F.col("_swapped"), sector_text).otherwise(own_text),
            "held_out": F.col("held_out") & ~F.col("_swapped"),
        }
    )

    def line(headline: Column, place: Column) -> Column:
        """Each line of a draw has an age, a date and a publisher of its own."""
        at = (F.col(key), place)
        stale = draw(*at, "stale") < K.STALE_HEADLINE_RATE
        back = F.when(stale, draw_index(K.STALE_DAYS + 1, *at, "age")).otherwise(draw_index(K.RECENT_DAYS + 1, *at, "age"))
        publishers = F.array(*[F.lit(p) for p in K.NOISE_PUBLISHERS])
        publisher = F.element_at(publishers, draw_index(len(K.NOISE_PUBLISHERS), *at, "publisher") + 1)
        return render.headline_line(F.date_sub(today, back), fill_fields(headline, fields), publisher)

    lines = F.transform("_headlines", line)
    kind, question = render.user_query(F.col("ticker"), F.col(key))
    shown = render.price_context(
        render.drop_blocks(chosen, key).withColumn("_fraction", F.col("move_pct") / 100), "_fraction"
    )
    read_gap = F.when(F.col("valuation") != K.UNAVAILABLE, F.col("shown_gap_pct"))
    fused = fuse(shown.withColumn("fused_gap_pct", read_gap), "news_reaction", "fused_gap_pct")
    commentary = F.when(
        (F.col("market_data") != K.UNAVAILABLE) & (draw(F.col(key), "commentary") < K.COMMENTARY_RATE),
        render.value_commentary(F.col("operating_margin"), F.col("roe"), F.col("peg_ratio"), F.col(key)),
    )
    clause = render.fusion_clause(
        F.col("ticker"), F.col("news_reaction"), F.col("valuation_bucket"), F.col("recommendation"),
        F.col("fused_gap_pct"), F.col(key),
    )
    prose = fused.withColumn("_lines", lines).withColumns(
        {
            "news": render.news_block(F.col("_lines"), F.col(key), today),
            "user_query": question,
            "reasoning": F.concat_ws(" ", fill_fields(F.col("_reasoning"), fields), commentary, clause),
            "answer": render.answer(kind, F.col("recommendation"), F.col("ticker")),
            "split": split_of(F.col("ticker"), holdout, F.col("held_out")),
        }
    )
    return explode_rows(prose, [key, "split"])


def revenue_ranges(quarterly: DataFrame) -> DataFrame:
    """Lowest and highest quarterly revenue per entity, in billions."""
    revenue = quarterly.where(F.col("metric").isin(*K.REVENUE_METRICS) & F.col("value").isNotNull())
    billions = F.col("value") / 1e9
    return revenue.groupBy("ticker").agg(F.min(billions).alias("low"), F.max(billions).alias("high"))
