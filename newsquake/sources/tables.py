"""The sample star schema read as the domain tables of the jobs.

Every function derives a domain table from the given Parquet tables with plain DataFrame code.
Amounts are summed as integer cents so that the result does not depend on the order of rows.
"""

from __future__ import annotations

from functools import cached_property
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsquake import constants as K
from newsquake.functions.text import sector_pattern, split_feed_title
from newsquake.operators.ranking import running_totals
from newsquake.plans.select import window_index
from newsquake.plans.template import draws_of

# The sector each region stands for.
REGION_SECTORS = ("Energy", "Technology", "Real Estate", "Financial Services", "Industrials")
FEED_END = "2001-12-31"
FEED_WEEKS = 400
_SCHEMAS: dict[str, StructType] = {}


def with_formal_sector(df: DataFrame, informal: str = "informal_sector", sector: str = "sector") -> DataFrame:
    """The formal sector an informal name belongs to, in any case and around blanks; null for unknown names.

    The names are a fixed list, so the lookup is one constant map and rows stay where they are.
    """
    known = F.create_map(*[F.lit(x) for pair in K.INFORMAL_SECTORS.items() for x in pair])
    return df.withColumn(sector, F.element_at(known, F.lower(F.trim(F.col(informal)))))


def sector_table(spark: SparkSession) -> DataFrame:
    """One row per known sector: median P/E, asset-heavy and REIT flags, keyword pattern."""
    names = sorted({*K.SECTOR_MEDIAN_PE, *K.SECTOR_KEYWORDS, *K.ASSET_HEAVY_SECTORS, *K.REIT_SECTORS})
    rows = [
        (
            name,
            K.SECTOR_MEDIAN_PE.get(name),
            name in K.ASSET_HEAVY_SECTORS,
            name in K.REIT_SECTORS,
            sector_pattern(name) if name in K.SECTOR_KEYWORDS else None,
        )
        for name in names
    ]
    return spark.createDataFrame(
        rows, "sector string, median_pe double, asset_heavy boolean, reit boolean, keyword_pattern string"
    )


def _mapped(key: Column, values: dict[int, Column]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), v) for k, v in values.items()))[key]


class Tables:
    """Domain tables bound to one directory of sample tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def read(self, name: str) -> DataFrame:
        """A sample table; its schema is looked up once per process, not by a job per read."""
        path = f"{self.directory}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def sectors(self) -> DataFrame:
        return sector_table(self.spark)

    @cached_property
    def entities(self) -> DataFrame:
        """(entity_key, ticker, name, sector): one per nation, its region standing for the sector."""
        sector = F.element_at(F.array(*[F.lit(s) for s in REGION_SECTORS]), F.col("n_regionkey") + 1)
        return self.read("nation").select(
            F.col("n_nationkey").alias("entity_key"),
            F.col("n_name").alias("ticker"),
            F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string"), F.lit(" Holdings Inc.")).alias("name"),
            sector.alias("sector"),
        )

    @cached_property
    def _sales(self) -> DataFrame:
        """(ticker, entity_key, day, quarter_end, cents, units, profit_cents, lines) per nation and ship date."""
        quarter_end = F.last_day(F.add_months(F.trunc("day", "quarter"), 2))
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        margin = F.round(F.col("l_discount") * 100).cast("long") - 2 - F.pmod(F.col("s_nationkey"), F.lit(6))
        daily = (
            self.read("lineitem")
            .select("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
            .join(self.read("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("s_nationkey", F.to_date("l_shipdate").alias("day"))
            .agg(
                F.sum(cents).alias("cents"),
                F.sum(F.col("l_quantity").cast("long")).alias("units"),
                F.sum(cents * margin).alias("profit"),
            )
        )
        return daily.join(self.entities, F.col("s_nationkey") == F.col("entity_key")).select(
            "ticker", "entity_key", "day", quarter_end.alias("quarter_end"), "cents", "units", "profit"
        )

    @cached_property
    def prices(self) -> DataFrame:
        """(ticker, trade_date, close): volume-weighted price per ship date."""
        return self._sales.select(
            "ticker", F.col("day").alias("trade_date"), (F.col("cents") / F.lit(100.0) / F.col("units")).alias("close")
        )

    @cached_property
    def _quarters(self) -> DataFrame:
        return (
            self._sales.groupBy("ticker", "entity_key", "quarter_end")
            .agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"), F.sum("profit").alias("profit"))
            .withColumn("eps", F.col("profit") / F.lit(10000.0) / F.col("units"))
        )

    @cached_property
    def quarterly(self) -> DataFrame:
        """(ticker, metric, period_end, value); every fifth entity reports basic EPS only."""
        metric = F.when(F.col("entity_key") % 5 == 0, "Basic EPS").otherwise("Diluted EPS")
        pairs = F.explode(
            F.array(
                F.struct(metric.alias("metric"), F.col("eps").alias("value")),
                F.struct(F.lit("Total Revenue").alias("metric"), (F.col("cents") / F.lit(100.0)).alias("value")),
            )
        )
        return self._quarters.select("ticker", F.col("quarter_end").alias("period_end"), pairs.alias("p")).select(
            "ticker", "p.metric", "period_end", "p.value"
        )

    @cached_property
    def earnings(self) -> DataFrame:
        """(ticker, event_ts, eps_estimate, eps_reported): a report 20 days after each quarter, at 18:00.

        The estimate is the previous quarter's figure; the last quarter is not reported yet.
        """
        by_quarter = Window.partitionBy("ticker").orderBy("quarter_end")
        at = F.date_add("quarter_end", 20).cast("timestamp") + F.expr("interval 18 hours")
        return self._quarters.select(
            "ticker",
            at.alias("event_ts"),
            F.lag("eps").over(by_quarter).alias("eps_estimate"),
            F.when(F.lead("eps").over(by_quarter).isNotNull(), F.col("eps")).alias("eps_reported"),
        )

    @cached_property
    def fundamentals(self) -> DataFrame:
        """One snapshot per entity; amounts from customer and supplier sums, ratios by entity key, some missing."""
        key = F.col("entity_key")

        def steps(multiplier: int, modulus: int) -> Column:
            return F.pmod(key * multiplier, F.lit(modulus))

        customers = self.read("customer").groupBy("c_nationkey").agg(
            F.count(F.lit(1)).alias("customers"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("balance")
        )
        missing = F.lit(None).cast("double")
        growth = (steps(5, 17) - 4) / F.lit(100.0)
        return self.entities.join(customers, F.col("c_nationkey") == key, "left").select(
            "ticker",
            "sector",
            (F.col("customers") * 200.0).alias("shares_outstanding"),
            F.when(steps(1, 9) != 4, steps(7, 13) / F.lit(10.0)).otherwise(missing).alias("payout_ratio"),
            F.when(steps(1, 8) != 3, F.col("balance") * (steps(1, 4) - 1) / F.lit(100.0)).alias("free_cash_flow"),
            F.when(steps(1, 3) != 0, steps(3, 11) * 2.0).otherwise(missing).alias("dividend_rate"),
            F.when(steps(1, 6) != 1, growth).otherwise(missing).alias("growth_0y"),
            F.when(steps(1, 6) != 1, growth + 0.02).otherwise(missing).alias("growth_1y"),
            F.when(steps(1, 4) != 2, growth - 0.03).otherwise(missing).alias("growth_0y_low"),
            F.when(steps(1, 5) != 3, growth + 0.25).otherwise(missing).alias("growth_0y_high"),
            F.when(steps(1, 4) == 0, steps(3, 7) * 0.13).otherwise(missing).alias("eps_growth_5y"),
            F.when(steps(1, 7) != 5, 150.0 + steps(11, 23) * 40.0).otherwise(missing).alias("book_value_per_share"),
            F.when(steps(1, 10) != 9, steps(4, 9) * 0.03).otherwise(missing).alias("operating_margin"),
            F.lit("USD").alias("currency"),
            F.when(steps(1, 12) == 7, "EUR").otherwise("USD").alias("financial_currency"),
            F.when(steps(1, 5) != 0, 4.0 + steps(6, 31) * 1.5).otherwise(missing).alias("pe_forward"),
            F.when(steps(1, 3) != 0, steps(2, 9) * 0.5).otherwise(missing).alias("dividend_yield"),
            F.when(steps(1, 5) != 2, 500.0 + key * 10.0).otherwise(missing).alias("year_low"),
            F.when(steps(1, 5) != 2, 5000.0 + key * 10.0).otherwise(missing).alias("year_high"),
        )

    @cached_property
    def feed(self) -> DataFrame:
        """(ticker, feed_pos, published_at, feed_title): one raw feed item per order of the nation's customers."""
        key = F.col("o_orderkey")
        ticker, name = F.col("ticker"), F.concat(F.lit("Nation "), F.col("entity_key").cast("string"))
        tail = F.concat(F.lit(" ("), F.pmod(key, F.lit(499)).cast("string"), F.lit(")"))
        title = _mapped(
            F.pmod(key, F.lit(12)).cast("int"),
            {
                0: F.concat(name, F.lit(" signs a supply deal"), tail),
                1: F.concat(ticker, F.lit(" Stock Trades Up, Here Is Why")),
                2: F.concat(F.lit("Should You Buy "), ticker, F.lit(" Stock?")),
                3: F.concat(F.lit("OPEC agrees to cut oil output"), tail),
                4: F.concat(F.lit("New cloud software rules announced"), tail),
                5: F.concat(F.lit("Rate hike worries weigh on lenders"), tail),
                6: F.concat(F.col("o_custkey").cast("string"), F.lit(" Shares in "), ticker, F.lit(" Purchased by Trust")),
                7: F.concat(name, F.lit(" raises full-year guidance"), tail),
                8: F.concat(F.lit("Markets close mixed on light volume"), tail),
                9: F.concat(F.lit("("), ticker, F.lit(") cuts outlook after order slump"), tail),
                10: F.concat(name, F.lit(" reports record quarter"), tail, F.lit(" - analysts")),
                11: F.concat(F.lit("Factory output slows for suppliers"), tail),
            },
        )
        publisher = _mapped(
            F.pmod(F.col("o_custkey"), F.lit(8)).cast("int"),
            {
                0: F.lit(" - Reuters"), 1: F.lit(" - Bloomberg"), 2: F.lit(" - MarketBeat"), 3: F.lit(" - marketbeat.com"),
                4: F.lit(" - CNBC"), 5: F.lit(" - Tikrit Daily"), 6: F.lit(" - Zacks Investment Research"), 7: F.lit(""),
            },
        )
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
        customers = self.read("customer").select("c_custkey", "c_nationkey")
        return (
            orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.entities, F.col("c_nationkey") == F.col("entity_key"))
            .select(
                "ticker",
                key.alias("feed_pos"),
                F.col("o_orderdate").cast("timestamp").alias("published_at"),
                F.concat(title, publisher).alias("feed_title"),
                (F.col("o_orderstatus") != "P").alias("relevant"),
                (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("importance"),
                (F.col("o_totalprice") >= 20000).alias("assessed"),
            )
        )

    @cached_property
    def headlines(self) -> DataFrame:
        """(ticker, window_idx, feed_pos, title, publisher, published_at); window_idx is null outside the weeks searched."""
        title, publisher = split_feed_title(F.col("feed_title"))
        end = F.date_sub(F.to_date(F.lit(FEED_END)), K.POST_PUBLISH_DAYS)
        window = window_index(F.to_date("published_at"), end, FEED_WEEKS)
        return self.feed.where(F.col("feed_title") != "").select(
            "ticker", window.alias("window_idx"), "feed_pos", title.alias("title"), publisher.alias("publisher"), "published_at"
        )

    @cached_property
    def assessments(self) -> DataFrame:
        """(ticker, feed_pos, relevant, importance); small orders carry no assessment."""
        return self.feed.where("assessed").select("ticker", "feed_pos", "relevant", "importance")

    @cached_property
    def eval_rows(self) -> DataFrame:
        """Stored rows to score, two per document; the reaction follows the document's labels."""
        quality, toxic = F.col("quality"), F.col("toxic")
        reaction = (
            F.when((quality == 1) & (toxic == 0), "good")
            .when((quality == 0) & (toxic == 0), "bad")
            .when((quality == 0) & (toxic == 1), "overreaction_down")
            .when((quality == 1) & (toxic == 1), "overreaction_up")
            .otherwise("neutral")
        )
        buckets = F.array(*[F.lit(b) for b in ("undervalued", "near_fair", "overvalued", "no_data", "")])
        cells = [part for r in K.FUSION_ROWS for part in (F.lit(f"{r[0]}|{r[1]}"), F.lit(r[2]))]
        documents = self.read("documents").select("doc_id", "source", "lang", "n_chars")
        labelled = documents.join(self.read("labels"), "doc_id", "left").select(
            "doc_id", "source", "lang", "n_chars", reaction.alias("news_reaction"),
            F.element_at(buckets, (F.col("n_chars") % 5).cast("int") + 1).alias("bucket"),
        )
        call = F.coalesce(
            F.try_element_at(F.create_map(*cells), F.concat_ws("|", "news_reaction", "bucket")), F.lit("HOLD")
        )
        tasks = F.array(
            F.struct(
                (F.col("doc_id") * 2).alias("row_id"), F.lit("reaction").alias("task"),
                F.lit("").alias("recommendation"), F.lit("").alias("valuation_bucket"),
            ),
            F.struct(
                (F.col("doc_id") * 2 + 1).alias("row_id"), F.lit("analysis").alias("task"),
                call.alias("recommendation"), F.col("bucket").alias("valuation_bucket"),
            ),
        )
        return labelled.withColumn("t", F.explode(tasks)).select(
            "t.row_id", "t.task", "source", "news_reaction", "t.recommendation", "t.valuation_bucket"
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """(row_id, model, text): answers of two models to every row, some of them malformed."""
        documents = self.read("documents").select("doc_id", "source", "lang", "n_chars")
        model = F.explode(
            F.array(
                F.struct(F.lit("base").alias("model"), F.lit(1).alias("off")),
                F.struct(F.lit("tuned").alias("model"), F.lit(0).alias("off")),
            )
        )
        crossed = documents.withColumn("m", model).withColumn("task_no", F.explode(F.array(F.lit(0), F.lit(1))))
        shifted = F.col("n_chars") + F.col("m.off")
        reaction = F.element_at(F.array(*[F.lit(r) for r in K.REACTIONS]), (shifted % 5).cast("int") + 1)
        call = F.element_at(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("HOLD")), (shifted % 3).cast("int") + 1)
        answer = F.when(F.col("doc_id") % 5 == 0, " ").otherwise(F.col("lang"))
        fields = F.when(
            F.col("task_no") == 0, F.concat(F.lit('"news_reaction": "'), reaction, F.lit('"'))
        ).otherwise(
            F.concat(
                F.lit('"recommendation": "'), call, F.lit('", "reasoning": "'), F.col("source"),
                F.lit('", "answer": "'), answer, F.lit('"'),
            )
        )
        shape = F.col("doc_id") % 6
        text = (
            F.when(shape == 1, F.concat(F.lit("Sure: {"), fields, F.lit("} as asked")))
            .when(shape == 2, F.concat(F.lit("{"), fields, F.lit(",}")))
            .when(shape == 3, F.lit("no answer"))
            .when(shape == 4, F.concat(F.lit("{\n "), fields, F.lit("\n}")))
            .when(shape == 5, F.concat(F.lit('{"a": 1} then {'), fields, F.lit("}")))
            .otherwise(F.concat(F.lit("{"), fields, F.lit("}")))
        )
        return crossed.select((F.col("doc_id") * 2 + F.col("task_no")).alias("row_id"), F.col("m.model").alias("model"), text.alias("text"))

    @cached_property
    def template_pools(self) -> DataFrame:
        """(pool, idx, headlines, reasonings): one template per part, numbered within its pool."""
        names = ("good", "bad", "neutral", "overreaction_down", "overreaction_up")
        pool = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % 5).cast("int") + 1)
        headline = F.concat(F.lit("{name} ({ticker}) updates its "), F.col("p_name"), F.lit(" line"))
        reasoning = F.concat(F.lit("The "), F.col("p_name"), F.lit(" news bears on {ticker}."))
        parts = self.read("part").select(
            pool.alias("pool"), F.col("p_partkey").alias("order_key"),
            F.array(headline).alias("headlines"), F.array(reasoning, F.concat(reasoning, F.lit(" It may fade."))).alias("reasonings"),
        )
        return running_totals(parts, ["pool"], "order_key", []).withColumn("idx", F.col("running_n").cast("int") - 1).drop("running_n")

    @cached_property
    def tiered_templates(self) -> DataFrame:
        """(tier, direction, order_key, headlines, reasonings): templates that name no reaction, one per part."""
        tiers = F.array(*[F.lit(n) for n in ("extreme_alone", "moderate_alone", "extreme_pair")])
        headline = F.concat(F.lit("{name} ({ticker}) reviews its "), F.col("p_name"), F.lit(" line"))
        return self.read("part").select(
            F.element_at(tiers, (F.col("p_partkey") % 3).cast("int") + 1).alias("tier"),
            F.when(F.col("p_size") % 2 == 0, "BUY").otherwise("SELL").alias("direction"),
            F.col("p_partkey").alias("order_key"),
            F.array(headline).alias("headlines"), F.array(F.lit("{ticker} gave no reason.")).alias("reasonings"),
        )

    @cached_property
    def sector_news(self) -> DataFrame:
        """(sector, good_headline, bad_headline, good_reasoning, bad_reasoning) for the two sectors that have any."""
        return self.entities.where(F.col("sector").isin("Energy", "Industrials")).select("sector").distinct().select(
            "sector",
            F.concat(F.col("sector"), F.lit(" demand firms")).alias("good_headline"),
            F.concat(F.col("sector"), F.lit(" demand softens")).alias("bad_headline"),
            F.concat(F.lit("{ticker} sells more as demand across "), F.col("sector"), F.lit(" firms.")).alias("good_reasoning"),
            F.concat(F.lit("{ticker} sells less as demand across "), F.col("sector"), F.lit(" softens.")).alias("bad_reasoning"),
        )

    @cached_property
    def template_draws(self) -> DataFrame:
        """(draw_id, as_of, news_reaction, entity_no, entity fields): one draw per order over all entities."""
        keys = self.read("orders").select(F.col("o_orderkey").alias("draw_id"), F.to_date("o_orderdate").alias("as_of"))
        return draws_of(keys, "draw_id", self.entities, "entity_key")
