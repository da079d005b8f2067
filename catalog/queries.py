"""The registered queries: one per operator or job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsquake import constants as K
from newsquake.functions import render, text
from newsquake.functions.numeric import draw, fixed_text
from newsquake.functions.reaction import retraced, text_gap, valuation_bucket
from newsquake.operators.asof import AsOf, asof_lookup, distinct_days
from newsquake.operators.lookup import skew_safe_join
from newsquake.operators.ranking import nearest_rank
from newsquake.plans import calibrate, convert, evaluate, jobs, label, report, rows, select, signals, template, value
from newsquake.session import settled, work_folder
from newsquake.sources import stored
from newsquake.sources.store import RowStore
from newsquake.sources.tables import FEED_END, FEED_WEEKS, Tables, sector_table, with_formal_sector
from newsquake.streaming import feed as arriving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return build(Tables(spark, directory))

        QUERIES[name] = run
        return build

    return register


def _r(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0.0 turns -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def _text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def _count() -> Column:
    return F.count(F.lit(1))


def _days(t: Tables) -> DataFrame:
    return distinct_days(t.headlines, "ticker", "published_at")


def _feed_end() -> Column:
    return F.to_date(F.lit(FEED_END))


def _selected(t: Tables) -> DataFrame:
    return select.select_headlines(t.headlines, t.assessments, t.entities, t.sectors)


def _tried(t: Tables, selected: DataFrame | None = None) -> DataFrame:
    chosen = (selected if selected is not None else _selected(t)).where(F.col("skip_reason").isNull()).drop("skip_reason")
    return signals.fuse_headlines(chosen, t)


def _kept(t: Tables) -> DataFrame:
    return select.keep_within_caps(_tried(t))


def _values(t: Tables) -> DataFrame:
    return value.value_days(_days(t), t.prices, t.quarterly, t.earnings, t.fundamentals, t.sectors)


def _samples(t: Tables) -> DataFrame:
    return calibrate.reaction_samples(t.entities, t.prices, t.earnings, _feed_end(), FEED_WEEKS)


def _scored(t: Tables) -> DataFrame:
    return evaluate.score(t.eval_rows, t.predictions)


def _labels(t: Tables) -> DataFrame:
    return label.label_days(label.measure_days(_days(t), t.prices, t.earnings))


# --- sources ---------------------------------------------------------------


def _written(lines: DataFrame, name: str) -> str:
    path = work_folder(lines.sparkSession, name)
    lines.write.text(path)
    return path


def _document_rows(t: Tables) -> DataFrame:
    """(doc_id, lang, line): a stored row in JSON for every document, its text as the news."""
    row = F.struct(F.col("doc_id").cast("string").alias("user_query"), F.col("source").alias("ticker"), F.col("text").alias("news"))
    return t.read("documents").select("doc_id", "lang", F.to_json(row).alias("line"))


@query("src1_rows_and_rejects")
def _(t):
    """Documents as lines of stored files, four of seven damaged in some way, read back line by line."""
    line, kind = F.col("line"), F.col("doc_id") % 7
    damaged = (
        F.when(kind == 1, F.concat(F.lit("\n \n"), line))
        .when(kind == 2, F.expr("left(line, length(line) - 1)"))
        .when(kind == 3, F.concat(F.lit('{"user_query":"'), F.col("doc_id").cast("string"), F.lit('"}')))
        .when(kind == 4, F.concat(line, F.lit(" # note")))
        .when(kind == 5, F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line)
    )
    lines = stored.read_lines(t.spark, _written(_document_rows(t).select(damaged), "src1"))
    told = F.regexp_extract("line", r'"user_query":"(\d+)"', 1).cast("bigint")
    return lines.select(
        told.alias("doc_id"), F.coalesce("reject_reason", F.lit("row")).alias("outcome"), F.col("row.ticker").alias("ticker"),
        F.char_length("row.news").cast("long").alias("news_chars"), F.md5("row.news").alias("news_digest"),
    )


@query("src2_4_set1_tagged_files")
def _(t):
    """Stored files of two kinds under their tags, beside one that is not there."""
    rows_ = _document_rows(t)
    english = _written(rows_.where("lang = 'en'").select("line"), "src2")
    other = _written(rows_.where("lang <> 'en'").select("line"), "src2")
    both = stored.read_split(t.spark, [english], [other, f"{other}-none"]).select(F.lit("all").alias("tag"), "user_query", "news")
    tagged = stored.read_tagged(t.spark, {"english": english, "other": other}, "tag").select("tag", "user_query", "news")
    return both.unionByName(tagged).select("tag", F.col("user_query").cast("bigint").alias("doc_id"), F.char_length("news").cast("long").alias("news_chars"))


@query("src5_headline_feed")
def _(t):
    window = stored.window_feed(t.feed, F.to_timestamp(F.lit("1995-01-01")), F.to_timestamp(F.lit("2001-11-22")))
    title, publisher = text.split_feed_title(F.col("feed_title"))
    return window.select("ticker", "feed_pos", title.alias("title"), publisher.alias("publisher"))


@query("src6_price_range")
def _(t):
    bars = stored.price_range(t.prices, F.lit("1996-01-01").cast("date"), F.lit("2001-01-01").cast("date"))
    return bars.groupBy("ticker").agg(
        _count().alias("bars"), F.min("trade_date").cast("string").alias("first"), F.max("trade_date").cast("string").alias("last"),
        _r(F.min("close")).alias("low"), _r(F.max("close")).alias("high"),
    )


@query("src7_fundamentals_assembly")
def _(t):
    info = t.fundamentals.drop("growth_0y", "growth_1y", "growth_0y_low", "growth_0y_high", "eps_growth_5y")
    five = t.fundamentals.where(F.col("eps_growth_5y").isNotNull()).select("ticker", "eps_growth_5y")
    out = stored.assemble_fundamentals(t.entities, info, _estimates(t), five)
    return out.select(
        "ticker", "sector", _r("shares_outstanding").alias("shares_outstanding"), _r("free_cash_flow").alias("free_cash_flow"),
        _r("growth_0y").alias("growth_0y"), _r("growth_0y_low").alias("growth_0y_low"), _r("eps_growth_5y").alias("eps_growth_5y"),
    )


def _estimates(t: Tables) -> DataFrame:
    """Per entity the lowest and highest quarterly EPS around the first quarter's figure."""
    eps = value.preferred_metric(t.quarterly, K.EPS_METRICS)
    return eps.groupBy("ticker").agg(
        F.min_by("value", "period_end").alias("year_ago_eps"), F.min("value").alias("eps_low"), F.max("value").alias("eps_high"),
        F.lit(0.05).alias("growth_0y"), F.lit(0.06).alias("growth_1y"),
    )


@query("src8_consensus_range")
def _(t):
    return value.consensus_growth(_estimates(t)).select(
        "ticker", *[_r(c).alias(c) for c in ("growth_0y", "growth_1y", "growth_0y_low", "growth_0y_high")]
    )


@query("src9_cell_after_label")
def _(t):
    pages = t.read("pages")
    return pages.select("page_id", text.cell_after_label(F.col("html"), "the", "li").alias("cell"))


CELL_LABELS = ("the", "de", "in", "was", "los")


@query("src9_cells_by_label")
def _(t):
    pages = t.read("pages")
    cells = pages.select("page_id", *[text.cell_after_label(F.col("html"), label, "li").alias(f"after_{label}") for label in CELL_LABELS])
    return cells.where(F.coalesce(*[F.col(f"after_{label}") for label in CELL_LABELS]).isNotNull())


@query("join9_informal_sectors")
def _(t):
    # Each part stands for a company of which only an informal sector is known.
    names = sorted(K.INFORMAL_SECTORS)
    informal = F.element_at(F.array(*[F.lit(n) for n in [*names, "shipbuilding"]]), (F.col("p_partkey") % (len(names) + 1) + 1).cast("int"))
    parts = t.read("part").select("p_partkey", informal.alias("informal_sector"))
    known = with_formal_sector(parts).join(t.sectors, "sector", "left")
    return known.groupBy("informal_sector", "sector", "median_pe", "asset_heavy").agg(_count().alias("n"))


@query("src10_preferred_metric")
def _(t):
    eps = value.preferred_metric(t.quarterly, K.EPS_METRICS)
    return eps.select("ticker", "metric", _text("period_end"), _r("value").alias("value"))


# --- filters and projections -------------------------------------------------


@query("prj1_feed_title_split")
def _(t):
    title, publisher = text.split_feed_title(F.col("feed_title"))
    return t.feed.groupBy(publisher.alias("publisher")).agg(_count().alias("n"), F.countDistinct(title).alias("titles"))


@query("flt1_publisher_tokens")
def _(t):
    tokens = F.array_join(text.publisher_tokens(F.col("publisher")), " ")
    return t.headlines.groupBy("publisher", tokens.alias("tokens")).agg(_count().alias("n"))


@query("flt2_denied_publishers")
def _(t):
    return t.headlines.groupBy("publisher", text.is_low_quality_publisher(F.col("publisher")).alias("denied")).agg(_count().alias("n"))


@query("flt3_low_content_headlines")
def _(t):
    return t.headlines.groupBy("ticker", text.is_low_content(F.col("title")).alias("low_content")).agg(_count().alias("n"))


@query("flt3_low_content_documents")
def _(t):
    return t.read("documents").select("doc_id", text.is_low_content(F.col("text")).alias("low_content"))


@query("flt4_normalized_text")
def _(t):
    folded = text.normalize_for_match(F.col("text"))
    return t.read("documents").select("doc_id", F.char_length(folded).cast("long").alias("n"), F.md5(folded).alias("digest"))


@query("flt5_6_name_needles")
def _(t):
    names = t.read("supplier").select(F.concat(F.lit("The "), F.col("s_name"), F.lit(" Group, Inc.")).alias("name")).unionAll(
        t.entities.select("name")
    ).unionAll(t.read("part").select(F.concat_ws(" ", F.element_at(F.split("p_name", " "), 2), F.lit("Corp.")).alias("name")))
    return names.groupBy("name", text.brand_core(F.col("name")).alias("core"), text.name_needle(F.col("name")).alias("needle")).agg(
        _count().alias("n")
    )


@query("flt7_8_relevance")
def _(t):
    unseen = select.first_seen(t.headlines)
    patterns = select.entity_patterns(t.entities, t.sectors)
    joined = skew_safe_join(unseen, patterns, ["ticker"], ["feed_pos"], "inner")
    hit = text.is_relevant(F.col("title"), F.col("needle_pattern"), F.col("ticker_pattern"), F.col("keyword_pattern"))
    return joined.groupBy("ticker", hit.alias("relevant")).agg(_count().alias("n"))


@query("flt9_10_screen_coverage")
def _(t):
    pool = select.screened_pool(select.first_seen(t.headlines), t.assessments)
    importance = F.least(F.lit(5), F.greatest(F.lit(1), F.col("importance")))
    return pool.groupBy("ticker", "covered").agg(
        _count().alias("pooled"), F.count_if(F.col("relevant") & (importance >= K.IMPORTANCE_THRESHOLD)).alias("accepted")
    )


@query("flt11_selected_headlines")
def _(t):
    return _selected(t).select("ticker", F.col("window_idx").cast("long").alias("window_idx"), "feed_pos", "title", "publisher", "path", "skip_reason")


@query("flt12_generated_text_check")
def _(t):
    turns = t.read("conversations")
    answer = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("\nANSWER: "), F.col("text"))).otherwise("")
    head = F.when(F.col("role") == "system", "NOTE: ").otherwise("Reasoning: ")
    parsed = text.parse_generated_text(F.concat(head, F.col("text"), answer))
    return turns.withColumn("p", parsed).select(
        "conv_id", "turn", "p.reject_reason",
        F.char_length("p.reasoning").cast("long").alias("reasoning_chars"), F.char_length("p.answer").cast("long").alias("answer_chars"),
    )


def _old_rows(t: Tables) -> DataFrame:
    """Old rows from headlines: one or two dated lines, a noise line, and an output that may be broken."""
    key = F.col("feed_pos")
    line = render.headline_line(F.to_date("published_at"), F.col("title"), F.col("publisher"))
    second = F.when(key % 9 == 0, F.concat(F.lit("\n"), line)).otherwise("")
    noise = F.lit(f"- [Mon, 01 Jan 2001] {K.NOISE_HEADLINES[0]} - Reuters\n")
    call = F.element_at(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("HOLD")), (key % 3).cast("int") + 1)
    valuation = F.when(key % 4 == 0, K.UNAVAILABLE).otherwise(
        F.concat(
            F.lit("Intrinsic Value (EPS-based): $10.00\nvs Current Price: "),
            F.when(key % 2 == 0, "overvalued").otherwise("undervalued"), F.lit(" by ~"), (key % 60).cast("string"), F.lit("%"),
        )
    )
    output = F.when(key % 13 == 0, "{broken").otherwise(
        F.concat(F.lit('{"impacted_stocks": [{"recommendation": "'), call, F.lit('", "reasoning": "r", "answer": "a"}]}'))
    )
    return t.headlines.select(
        key.alias("row_id"), "ticker", F.lit("").alias("user_query"), F.lit("").alias("market_data"), valuation.alias("valuation"),
        F.lit("").alias("earnings"), F.concat(noise, line, second).alias("news"), output.alias("output"),
    )


@query("flt13_signal_line_date")
def _(t):
    return _old_rows(t).select("row_id", convert.signal_date(F.col("news")).cast("string").alias("published"))


@query("flt14_15_convert_outcomes")
def _(t):
    return convert.drop_counts(convert.convert_rows(_old_rows(t), t.prices, t.earnings))


@query("prj6_converted_rows")
def _(t):
    done = convert.converted(convert.convert_rows(_old_rows(t), t.prices, t.earnings))
    return done.select("row_id", "ticker", "news_reaction", "recommendation", "valuation_bucket", "price_context")


def _simple_rows(t: Tables) -> DataFrame:
    """Reaction and analysis rows of labelled days with one plain news line."""
    labelled = _labels(t).where(F.col("news_reaction").isNotNull())
    base = render.price_context(labelled).withColumns(
        {"news": F.concat(F.lit("- "), F.col("ticker")), "user_query": F.lit("q"), "market_data": F.lit("m"), "valuation": F.lit("v"),
         "earnings": F.lit("e"), "recommendation": F.lit("HOLD"), "reasoning": F.lit("r"), "answer": F.lit("a"), "valuation_bucket": F.lit("")}
    )
    return rows.explode_rows(base, ["as_of"])


@query("prj2_3_stored_rows")
def _(t):
    built = _simple_rows(t)
    return built.groupBy("task", "ticker", "news_reaction").agg(
        _count().alias("n"), F.min("output").alias("output"), F.min("price_context").alias("lowest"), F.max("price_context").alias("highest")
    )


@query("prj5_prompts")
def _(t):
    return _simple_rows(t).select("ticker", _text("as_of"), "task", F.md5(render.prompt(F.col("task"))).alias("prompt_digest"))


# --- as-of joins -------------------------------------------------------------


@query("join1_first_trading_day")
def _(t):
    bars = label.trading_bars(t.prices)
    found = asof_lookup(_days(t), "ticker", "as_of", [AsOf("b", bars, "trade_date", ["trade_date", "close"], direction="forward")])
    return found.select("ticker", _text("as_of"), F.col("b.trade_date").cast("string").alias("trade_date"), _r("b.close").alias("close"))


@query("join2_next_earnings")
def _(t):
    spec = AsOf("e", t.earnings, "event_ts", ["event_ts"], direction="forward", inclusive=False)
    found = asof_lookup(_days(t), "ticker", "as_of", [spec])
    return found.select("ticker", _text("as_of"), F.to_date("e.event_ts").cast("string").alias("next_event"))


@query("join3_bars_to_event")
def _(t):
    found = label.measure_days(_days(t), t.prices, t.earnings)
    return found.select("ticker", _text("as_of"), F.col("bars_to_event").cast("long").alias("bars_to_event"), "assessable", "skip_reason")


@query("join4_to_7_facts_as_of")
def _(t):
    facts = value.facts_as_of(_days(t), t.prices, t.quarterly, t.earnings)
    return facts.select(
        "ticker", _text("as_of"), _text("price_date"), _text("last_quarter"), _text("next_earnings"),
        *[_r(c).alias(c) for c in ("price", "eps_ttm", "revenue", "year_ago_revenue", "last_eps", "last_estimate")],
    )


@query("join8_fusion")
def _(t):
    fused = signals.signal_days(_days(t), t)
    return fused.groupBy("news_reaction", "valuation_bucket", "recommendation").agg(
        _count().alias("n"), _r(F.min("confidence")).alias("low"), _r(F.max("confidence")).alias("high")
    )


@query("fuse_raw_gap")
def _(t):
    fused = signals.signal_days(_days(t), t, gap_mode="raw")
    return fused.groupBy("news_reaction", "valuation_bucket", "recommendation").agg(_count().alias("n"))


@query("join9_sector_lookup")
def _(t):
    return t.entities.join(sector_table(t.spark), "sector", "left").select(
        "ticker", "sector", "median_pe", "asset_heavy", "reit", F.col("keyword_pattern").isNotNull().alias("has_keywords")
    )


@query("join10_33_answers")
def _(t):
    kind, question = render.user_query(F.col("ticker"), F.col("feed_pos"))
    call = F.element_at(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("HOLD")), (F.col("feed_pos") % 3).cast("int") + 1)
    return t.headlines.select(
        "feed_pos", kind.alias("kind"), question.alias("question"), render.answer(kind, call, F.col("ticker")).alias("answer")
    )


@query("join13_pending_entities")
def _(t):
    """In each week, the entities without a headline are not done."""
    weeks = t.headlines.where("window_idx is not null").select("window_idx", "ticker").distinct()
    pairs = t.entities.select("ticker", "name", F.explode(F.sequence(F.lit(1), F.lit(FEED_WEEKS))).alias("window_idx"))
    return rows.pending(pairs, weeks, ["window_idx", "ticker"]).select(F.col("window_idx").cast("long").alias("window_idx"), "ticker", "name")


@query("join15_scored_predictions")
def _(t):
    return _scored(t).select("row_id", "model", "task", "expected", "predicted", "correct", "json_ok", "nonempty")


@query("join17_weekly_windows")
def _(t):
    weeks = calibrate.weekly_windows(t.entities.select("ticker"), _feed_end(), FEED_WEEKS)
    return weeks.select("ticker", F.col("window_idx").cast("long").alias("window_idx"), _text("after"), _text("before"))


# --- labels ------------------------------------------------------------------


@query("reaction_counts")
def _(t):
    return label.reaction_counts(t.headlines, t.prices, t.earnings)


@query("reaction_counts_wide_thresholds")
def _(t):
    return label.reaction_counts(t.headlines, t.prices, t.earnings, x=0.05, y=0.30)


@query("fn1_to_3_labelled_headlines")
def _(t):
    done = label.label_headlines(t.headlines, t.prices, t.earnings)
    return done.select("feed_pos", "ticker", "news_reaction", "skip_reason", _r("move_1d").alias("move_1d"), _r("move_21d").alias("move_21d"))


@query("fn4_5_fused_headlines")
def _(t):
    done = signals.fuse_headlines(t.headlines, t)
    return done.select("feed_pos", "news_reaction", "valuation_bucket", "recommendation", _r("confidence").alias("confidence"))


# --- valuation ---------------------------------------------------------------


@query("fn6_to_18_valuation")
def _(t):
    amounts = "price market_cap intrinsic gap_pct".split()
    ratios = "pe_trailing roe price_to_sales fcf_yield peg_ratio price_to_book".split()
    return _values(t).select(
        "ticker", _text("as_of"), "first_basis", "basis", *[_r(c, 4).alias(c) for c in amounts], *[_r(c, 8).alias(c) for c in ratios]
    )


@query("fn10_11_scenarios")
def _(t):
    names = [f"{part}_{name}" for part in ("g1", "g2", "g2d", "exit") for name in K.SCENARIOS]
    return _values(t).select("ticker", _text("as_of"), *[_r(c).alias(c) for c in names])


@query("agg8_basis_values")
def _(t):
    return _values(t).select("ticker", _text("as_of"), *[_r(c, 4).alias(c) for c in ("iv_eps", "iv_fcf", "iv_revenue", "iv_dividends", "stream_pv")])


@query("fn19_to_23_blocks")
def _(t):
    return render.blocks(_values(t)).select("ticker", _text("as_of"), "market_data", "valuation", "earnings")


@query("fn20_gap_from_text")
def _(t):
    valued = render.valuation(_values(t))
    return valued.select("ticker", _text("as_of"), render.gap_from_text(F.col("valuation")).alias("parsed"), text_gap(F.col("gap_pct")).alias("typed"))


@query("srt2_valuation_ranking")
def _(t):
    latest = t.prices.groupBy("ticker").agg(F.max("trade_date").alias("as_of"))
    valued = value.value_days(latest, t.prices, t.quarterly, t.earnings, t.fundamentals, t.sectors)
    ranked = report.valuation_ranking(valued)
    return ranked.select("ticker", _text("as_of"), "basis", "verdict", "shown_pct", _r("intrinsic", 4).alias("intrinsic"))


@query("agg7_trailing_eps")
def _(t):
    return value.trailing_eps(t.quarterly).select("ticker", _text("period_end"), _r("eps_ttm").alias("eps_ttm"))


@query("agg18_revenue_ranges")
def _(t):
    return template.revenue_ranges(t.quarterly).select("ticker", _r("low", 9).alias("low"), _r("high", 9).alias("high"))


# --- windows, caps and selection ----------------------------------------------


@query("win1_to_3_trading_bars")
def _(t):
    return label.trading_bars(t.prices).select(
        "ticker", _text("trade_date"), F.col("bar_no").cast("long").alias("bar_no"), _text("prev_date"), _text("ahead_date"),
        _r("prev_close").alias("prev_close"), _r("ahead_close").alias("ahead_close"),
    )


@query("win4_first_seen_titles")
def _(t):
    return select.first_seen(t.headlines).select("ticker", "title", F.col("window_idx").cast("long").alias("window_idx"), "feed_pos")


@query("win5_join14_assessed_pool")
def _(t):
    pool = select.screened_pool(select.first_seen(t.headlines), t.assessments)
    return pool.select("ticker", "feed_pos", F.col("pool_rank").cast("long").alias("pool_rank"), "covered", "relevant", F.col("importance").cast("long").alias("importance"))


@query("win6_7_kept_headlines")
def _(t):
    return _kept(t).select(
        "ticker", F.col("window_idx").cast("long").alias("window_idx"), "feed_pos", "news_reaction", "recommendation",
        F.col("rank_in_window").cast("long").alias("rank_in_window"), F.col("rank_in_entity").cast("long").alias("rank_in_entity"),
    )


@query("win8_latest_quarters")
def _(t):
    recent = Window.partitionBy("ticker").orderBy(F.col("period_end").desc())
    eps = value.preferred_metric(t.quarterly, K.EPS_METRICS).withColumn("n", F.row_number().over(recent)).where("n <= 4")
    return eps.select("ticker", _text("period_end"), F.col("n").cast("long").alias("n"), _r("value").alias("value"))


@query("win9_misclassified_samples")
def _(t):
    return evaluate.misclassified_samples(_scored(t)).select("model", "source", "expected", "predicted", "row_id", F.col("rank").cast("long").alias("rank"))


@query("win9_first_mismatches")
def _(t):
    return evaluate.mismatches(_scored(t), "tuned").select("row_id", "expected", "predicted")


@query("win11_set5_rebalanced")
def _(t):
    labelled = label.label_headlines(t.headlines, t.prices, t.earnings).where(F.col("news_reaction").isNotNull())
    stored_rows = labelled.select("feed_pos", "news_reaction", F.when(F.col("feed_pos") % 5 == 0, "analysis").otherwise("reaction").alias("task"))
    return rows.rebalance(settled(stored_rows), ["feed_pos"])


@query("agg9_class_targets")
def _(t):
    labelled = label.label_headlines(t.headlines, t.prices, t.earnings).where(F.col("news_reaction").isNotNull())
    return rows.class_targets(labelled.withColumn("task", F.lit("reaction")))


@query("win12_holdout_templates")
def _(t):
    return template.holdout_indices(t.template_pools).select("pool", F.col("idx").cast("long").alias("idx"))


@query("srt7_top_headlines")
def _(t):
    best = select.top_headlines(_tried(t))
    texts = F.transform("headlines", lambda h: F.concat(h["title"], F.lit(" | reaction: "), h["news_reaction"]))
    return best.select("ticker", F.col("window_idx").cast("long").alias("window_idx"), F.array_join(texts, "\n").alias("headlines"), "recommendation")


@query("agg1_skip_totals")
def _(t):
    return select.skip_totals(_selected(t))


@query("agg1_attempted_skips")
def _(t):
    selected = settled(_selected(t))
    tried = settled(_tried(t, selected))
    return select.attempted_skips(selected, tried, select.keep_within_caps(tried))


# --- calibration ----------------------------------------------------------------


@query("agg2_4_percentiles")
def _(t):
    found = calibrate.percentiles(calibrate.series_values(_samples(t)))
    return found.select("series", F.col("percent").cast("long").alias("percent"), F.col("n").cast("long").alias("n"), _r("value").alias("value"))


@query("agg2_price_percentiles")
def _(t):
    found = nearest_rank(t.prices, ["ticker"], "close", K.PERCENTS)
    return found.select("ticker", F.col("percent").cast("long").alias("percent"), F.col("n").cast("long").alias("n"), _r("close").alias("close"))


@query("agg3_4_moments")
def _(t):
    found = calibrate.moments(calibrate.series_values(_samples(t)))
    return found.select("series", "n", _r("mean").alias("mean"), _r("stdev").alias("stdev"))


@query("join16_agg5_6_threshold_grid")
def _(t):
    grid = calibrate.grid_counts(_samples(t))
    return grid.select("x", "y", "z", "n", *K.REACTIONS, _r("overreaction_share").alias("overreaction_share"), _r("neutral_share").alias("neutral_share"), "passes")


# Bands and gate that some of the sample's cells and models meet and others miss.
WIDE_BANDS = {"overreaction_band": (0.05, 0.185), "neutral_band": (0.008, 0.45)}
LOW_GATE = 0.275


@query("agg6_cells_in_wide_bands")
def _(t):
    return calibrate.grid_counts(_samples(t), **WIDE_BANDS).select("x", "y", "z", "passes")


@query("agg4_retracements")
def _(t):
    usable = _labels(t).where(F.col("assessable") & F.col("move_21d").isNotNull() & (F.abs("move_1d") >= min(K.Y_CANDIDATES)))
    side = F.when(F.col("move_1d") < 0, "down").otherwise("up")
    return usable.groupBy("ticker", side.alias("side")).agg(
        _count().alias("n"), _r(F.avg(retraced(F.col("move_1d"), F.col("move_21d")))).alias("mean_retraced")
    )


# --- evaluation --------------------------------------------------------------------


@query("agg10_accuracy")
def _(t):
    done = evaluate.accuracy(_scored(t))
    rates = ("accuracy", "json_rate", "nonempty_rate")
    return done.select("task", "model", "source", "total", "correct", "json_ok", "nonempty", *[_r(c).alias(c) for c in rates])


@query("agg11_srt4_confusion")
def _(t):
    return evaluate.confusion_report(_scored(t))


@query("agg12_class_recall")
def _(t):
    return evaluate.class_recall(_scored(t)).select("model", "expected", "total", "correct", _r("recall").alias("recall"), F.col("position").cast("long").alias("position"))


@query("agg13_cell_accuracy")
def _(t):
    return evaluate.cell_accuracy(_scored(t)).select("model", "news_reaction", "bucket", "total", "correct", _r("accuracy").alias("accuracy"))


@query("agg14_ship_gate")
def _(t):
    return evaluate.ship_gate(_scored(t)).select("model", "total", "correct", "cells", _r("worst_cell").alias("worst_cell"), _r("agreement").alias("agreement"), "ships")


@query("agg14_low_ship_gate")
def _(t):
    return evaluate.ship_gate(_scored(t), LOW_GATE).select("model", _r("agreement").alias("agreement"), "ships")


@query("agg15_running_accuracy")
def _(t):
    return evaluate.running_accuracy(_scored(t)).select("model", F.col("i").cast("long").alias("i"), _r("accuracy").alias("accuracy"))


@query("agg16_model_comparison")
def _(t):
    return evaluate.compare_models(_scored(t), "tuned", "base").select("task", "source", *[_r(c).alias(c) for c in ("tuned", "base", "delta")])


@query("win11_eval_sample")
def _(t):
    return evaluate.eval_sample(t.eval_rows, 10).select("row_id", "task", "source")


# --- rows, templates, reports -----------------------------------------------------------


HELD_OUT = ["NATION_3", "NATION_7"]


def _finished(t: Tables) -> DataFrame:
    return rows.finished_rows(_kept(t), F.lit("2002-01-01").cast("date"), HELD_OUT)


@query("finished_rows")
def _(t):
    done = _finished(t)
    return done.select(
        F.col("feed_pos"), "split", "task", "ticker", "user_query", "price_context", "valuation", "news_reaction", "recommendation",
        "valuation_bucket", F.get_json_object("output", "$.reasoning").alias("reasoning"), F.get_json_object("output", "$.answer").alias("answer"),
    )


@query("fn35_generated_texts")
def _(t):
    """Prose of analysis rows where conversations stand for generated texts, some of them unusable or without answer."""
    turns = t.read("conversations")
    first = turns.where("turn = 0").select(F.col("conv_id").alias("c"), F.coalesce("text", F.lit("")).alias("a"))
    second = turns.where("turn = 1").select(F.col("conv_id").alias("c"), F.col("text").alias("b"))
    answer = F.when(F.col("feed_pos") % 3 == 0, "").otherwise(F.concat(F.lit("\nANSWER: "), F.coalesce("b", F.lit(""))))
    texts = first.join(second, "c", "left")
    said = t.headlines.join(texts, F.col("feed_pos") % 100 == F.col("c")).select("feed_pos", F.concat(F.lit("REASONING: "), F.col("a"), answer).alias("text"))
    done = rows.finished_rows(_kept(t), F.lit("2002-01-01").cast("date"), HELD_OUT, said).where("task = 'analysis'")
    return done.select("feed_pos", F.get_json_object("output", "$.reasoning").alias("reasoning"), F.get_json_object("output", "$.answer").alias("answer"))


@query("job_rows_resumed")
def _(t):
    """All rows as a store holds them after a run over half of the entities and another one that goes on."""
    store, today = RowStore(t.spark, work_folder(t.spark, "rows")), F.lit("2002-01-01").cast("date")
    half = t.entities.where(jobs.group_of(F.col("ticker"), 2) == 0)
    jobs.generate_rows(jobs.Chosen(t, half), store, today, HELD_OUT, groups=1)
    jobs.generate_rows(t, store, today, HELD_OUT, groups=1)
    return store.rows().select(
        "split", "task", "ticker", "user_query", "price_context", "valuation", "news_reaction", "recommendation", "valuation_bucket",
        F.get_json_object("output", "$.reasoning").alias("reasoning"), F.get_json_object("output", "$.answer").alias("answer"),
    )


@query("agg17_split_summary")
def _(t):
    return report.split_summary(_finished(t))


@query("snk4_win10_review_headers")
def _(t):
    listed = report.review_list(_finished(t), "feed_pos")
    return listed.groupBy("ticker", "place", "split").agg(_count().alias("n"), F.min("value").alias("first")).select(
        "ticker", F.col("place").cast("long").alias("place"), "split", "n", F.when(F.col("place") == 0, F.col("first")).alias("header")
    )


@query("snk4_review_heading")
def _(t):
    return report.review_heading(_finished(t), "real")


@query("snk5_valuation_report")
def _(t):
    latest = t.prices.groupBy("ticker").agg(F.max("trade_date").alias("as_of"))
    texts = render.blocks(value.value_days(latest, t.prices, t.quarterly, t.earnings, t.fundamentals, t.sectors))
    lines = report.valuation_report(t.entities, texts.select("ticker", "market_data", "valuation", "earnings"), F.lit("2002-01-01"))
    return lines.select(F.col("place").cast("long").alias("place"), F.col("pct").cast("long").alias("pct"), "ticker", "value")


@query("snk6_spot_check")
def _(t):
    latest = t.prices.groupBy("ticker").agg(F.max("trade_date").alias("as_of"))
    texts = render.blocks(value.value_days(latest, t.prices, t.quarterly, t.earnings, t.fundamentals, t.sectors)).select(
        "ticker", "as_of", "market_data", F.when(F.col("ticker") == "NATION_3", "changed").otherwise(F.col("valuation")).alias("valuation"), "earnings"
    )
    return report.spot_check(latest, texts, t).select("ticker", _text("as_of"), "market_data_matches", "valuation_matches", "earnings_matches")


@query("prj7_typed_from_text")
def _(t):
    texts = render.blocks(_values(t)).select("ticker", "as_of", "market_data", "valuation")
    return report.typed_from_text(texts).select("ticker", _text("as_of"), "price", "pe_trailing", "pe_forward", "sector", "basis", "intrinsic", "verdict", "pct")


@query("fn24_market_cap_text")
def _(t):
    sized = t.read("orders").select("o_orderkey", (F.col("o_totalprice") * 4e6).alias("v"))
    worded = render.with_text(render.with_text(sized, 1, {"_b": F.col("v") / 1e9}), 2, {"_t": F.col("v") / 1e12})
    return worded.select("o_orderkey", render.money(F.col("v"), F.col("_t"), F.col("_b")).alias("amount"))


@query("fn18_exact_decimal_text")
def _(t):
    lines = t.read("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 8).alias("v"))
    return lines.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), fixed_text(F.col("v"), 1).alias("one"), fixed_text(-F.col("v"), 2).alias("two"))


@query("fn25_26_dates")
def _(t):
    shown = t.read("orders").select("o_orderkey", render.dated(F.to_date("o_orderdate")).alias("shown"))
    return shown.select("o_orderkey", "shown", render.parse_dated(F.col("shown")).cast("string").alias("parsed"))


@query("fn27_price_context")
def _(t):
    return render.price_context(_labels(t).where(F.col("move_1d").isNotNull())).select("ticker", _text("as_of"), "price_context")


@query("fn28_news_blocks")
def _(t):
    line = render.headline_line(F.to_date("published_at"), F.col("title"), F.col("publisher"))
    block = render.news_block(F.array(line), F.col("feed_pos"), F.lit("2002-01-01").cast("date"))
    return t.headlines.select("feed_pos", block.alias("news"))


@query("fn29_window_index")
def _(t):
    end = F.date_sub(_feed_end(), K.POST_PUBLISH_DAYS)
    index = select.window_index(F.to_date("published_at"), end, FEED_WEEKS)
    return t.feed.groupBy(F.coalesce(index, F.lit(0)).cast("long").alias("window_idx")).agg(_count().alias("n"))


@query("fn30_trait_rolls")
def _(t):
    return t.read("customer").select("c_custkey", _r(draw(F.col("c_name"), "dividend")).alias("roll"))


@query("fn31_value_commentary")
def _(t):
    valued = _values(t)
    words = render.value_commentary(F.col("operating_margin"), F.col("roe"), F.col("peg_ratio"), F.concat_ws("|", "ticker", F.col("as_of").cast("string")))
    return valued.select(
        "ticker", _text("as_of"), render.quality_tier(F.col("operating_margin"), F.col("roe")).alias("quality"),
        render.growth_tier(F.col("peg_ratio")).alias("growth"), words.alias("commentary"),
    )


@query("fn32_fusion_clauses")
def _(t):
    fused = signals.signal_days(_days(t), t).where(F.col("news_reaction").isNotNull())
    key = F.concat_ws("|", "ticker", F.col("as_of").cast("string"))
    kind = render.clause_kind(F.col("news_reaction"), F.col("valuation_bucket"), F.col("recommendation"))
    clause = render.fusion_clause(
        F.col("ticker"), F.col("news_reaction"), F.col("valuation_bucket"), F.col("recommendation"), F.col("fused_gap_pct"), key
    )
    return fused.select("ticker", _text("as_of"), kind.alias("kind"), clause.alias("clause"))


@query("fn36_37_text_fields")
def _(t):
    scored = t.predictions.select("row_id", "model", text.is_valid_json(F.col("text")).alias("json_ok"), *[
        text.field_text(F.col("text"), pattern).alias(name)
        for name, pattern in (("reaction", K.REACTION_FIELD_PATTERN), ("call", K.RECOMMENDATION_FIELD_PATTERN), ("answer", K.ANSWER_FIELD_PATTERN))
    ])
    return scored


@query("fn39_draws")
def _(t):
    return t.template_draws.groupBy("news_reaction", "ticker").agg(_count().alias("n"))


@query("fn40_missing_blocks")
def _(t):
    shown = render.drop_blocks(
        t.read("orders").select("o_orderkey", *[F.lit("x").alias(n) for n in ("market_data", "valuation", "earnings")]), "o_orderkey"
    )
    return shown.groupBy("market_data", "valuation", "earnings").agg(_count().alias("n"))


@query("fn4_bucket_edges")
def _(t):
    gap = F.col("l_extendedprice") / 100 - 500
    return t.read("lineitem").groupBy(valuation_bucket(F.round(gap, 0)).alias("bucket")).agg(_count().alias("n"))


def _template_rows(t: Tables) -> DataFrame:
    drawn = t.template_draws
    days = drawn.select("ticker", "as_of").distinct()
    valued = value.value_days(days, t.prices, t.quarterly, t.earnings, t.fundamentals, t.sectors)
    moved = drawn.withColumn("move_pct", F.round(draw(F.col("draw_id"), "move") * 6 - 3, 1))
    today = F.lit("2002-01-01").cast("date")
    return template.template_rows(
        moved, t.template_pools, t.sector_news, ["name", "ticker"], today, ["NATION_3"], days=template.rendered_days(valued)
    )


@query("join11_12_template_rows")
def _(t):
    done = _template_rows(t)
    reasoning = F.get_json_object("output", "$.reasoning")
    return done.where(F.col("task") == "analysis").select(
        "draw_id", "split", "ticker", "news_reaction", reasoning.isNotNull().alias("has_reasoning"),
        F.col("news").contains("demand firms").alias("sector_good"), F.col("news").contains("demand softens").alias("sector_bad"),
        F.regexp_extract("news", r"updates its ([a-z ]+) line", 1).alias("part_name"),
    )


@query("prj4_template_row_counts")
def _(t):
    done = _template_rows(t)
    return done.groupBy("task", "split", "news_reaction").agg(_count().alias("n"))


@query("set2_merged_pools")
def _(t):
    # Each table keeps its order; templates of both alternate where their numbers are alike.
    own = t.template_pools.select("pool", (F.col("idx").cast("long") * 2).alias("order_key"), "headlines", "reasonings")
    moved = t.tiered_templates.select(template.pool_of(F.col("direction"), F.col("tier")).alias("pool"), (F.col("order_key") * 2 + 1).alias("order_key"), "headlines", "reasonings")
    merged = template.merge_pools(own, moved)
    return merged.select("pool", F.col("idx").cast("long").alias("idx"), F.element_at("headlines", 1).alias("headline"), F.size("reasonings").cast("long").alias("n_reasonings"))


@query("str1_weekly_counts")
def _(t):
    arrivals = t.read("events").select(F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("published_at"))
    return arriving.weekly_counts(arrivals).select("ticker", F.col("after").cast("string").alias("after"), "n")


@query("set1_4_entity_sets")
def _(t):
    """In each week, entities with prices, with headlines, and with prices only."""
    end = F.date_sub(_feed_end(), K.POST_PUBLISH_DAYS)
    week = select.window_index(F.col("trade_date"), end, FEED_WEEKS).alias("window_idx")
    priced = t.prices.select("ticker", week).where("window_idx is not null").distinct()
    heard = t.headlines.where("window_idx is not null").select("ticker", "window_idx").distinct()
    parts = {"prices": priced, "headlines": heard, "prices only": priced.exceptAll(heard)}
    named = [part.select("ticker", F.col("window_idx").cast("long").alias("window_idx"), F.lit(name).alias("part")) for name, part in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("str2_unseen_titles")
def _(t):
    titled = t.feed.select("ticker", F.col("feed_title").alias("title"), "published_at", "feed_pos")
    return arriving.unseen_titles(titled).select("ticker", "title", _text("published_at"), "feed_pos")


@query("str3_ready_labels")
def _(t):
    complete = arriving.ready(t.headlines, F.lit("1998-06-01").cast("date"))
    return label.label_headlines(complete, t.prices, t.earnings).select("feed_pos", "news_reaction", "skip_reason")


