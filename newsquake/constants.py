"""The vocabularies, thresholds, patterns and formats the jobs must agree on."""

# --- reaction labels -------------------------------------------------------
REACTIONS = ("good", "bad", "neutral", "overreaction_down", "overreaction_up")
GOOD_BAD_THRESHOLD = 0.01
OVERREACTION_THRESHOLD = 0.03
RETRACEMENT_FRACTION = 0.5
LOOK_AHEAD_BARS = 21
PRE_PUBLISH_DAYS = 7
POST_PUBLISH_DAYS = 39
EARNINGS_SKIP_BARS = 0
EARNINGS_UNASSESSABLE_BARS = 21

# --- headline selection ----------------------------------------------------
LOOKBACK_WEEKS = 18
MAX_PER_ENTITY = 50
MAX_PER_WINDOW = 8
SCREEN_POOL = 30
IMPORTANCE_THRESHOLD = 3
DEFAULT_PUBLISHER = "Google News"

# Publishers whose headlines are dropped, matched by leading tokens.
LOW_QUALITY_PUBLISHERS = (
    "MarketBeat", "Stocktwits", "GuruFocus", "Trefis", "Simply Wall St.",
    "simplywall.st", "Zacks", "StockStory", "TIKR", "Moomoo",
    "TradingKey", "Quiver Quantitative",
)

# Verbs of price moves, part of the low-content pattern.
MOVE_VERBS = (
    r"(?:ris(?:e|es|ing)|fell|fall(?:s|ing)?|dropp?(?:ed|s|ing)?|"
    r"rall(?:y|ies|ying|ied)|slid(?:e|es|ing)?|climb(?:s|ed|ing)?|"
    r"surg(?:e|es|ed|ing)?|plung(?:e|es|ed|ing)?|jump(?:s|ed|ing)?|"
    r"sank|sink(?:s|ing)?|tumbl(?:e|es|ed|ing)|gain(?:s|ed|ing)?|"
    r"los(?:es|ing)|lost|nosediv(?:e|es|ed|ing)|soar(?:s|ed|ing)?|"
    r"sag(?:s|ged|ging)?|slump(?:s|ed|ing)?|wilt(?:s|ed|ing)?|"
    r"slip(?:s|ped|ping)?|retreat(?:s|ed|ing)?|advanc(?:e|es|ed|ing)?|"
    r"wobbl(?:e|es|ed|ing)|sink|dip(?:s|ped|ping)?|swoon(?:s|ed|ing)?|"
    r"spik(?:e|es|ed|ing)|skid(?:s|ded|ding)?)"
)

# Shapes of headlines that carry no information of their own.
LOW_CONTENT_PATTERN = (
    r"stock (?:is )?trad(?:ing|es) (?:up|down|higher|lower)"
    r"|(?:shares|stock) (?:are|is) (?:up|down|higher|lower) today"
    r"|here(?:.|\s+i)s why|here(?:.|\s+i)s what (?:investors|we|you) (?:need to know|see|should know)"
    r"|what you need to know|laps the stock market|what.s going on with"
    rf"|\bwhy\b.{{0,60}}\b(?:stock|shares?)\b.{{0,30}}\b{MOVE_VERBS}\b"
    rf"|\b(?:stock|shares?)\b.{{0,20}}\b(?:is|are)\b.{{0,10}}\b{MOVE_VERBS}(?:ing)?\b"
    r"|^Is .+ a Good Stock"
    r"|^Is .{1,60}\bStill\b.{1,25}\bAfter\b.{0,40}(?:\d+%|rally|surge|drop|plunge|rout|gain|dip|slump|rebound)"
    r"|Stock a (?:Good )?Buy\b|^Should You Buy|Buy,? Hold,? (?:or|and) Sell"
    r"|^\d+ (?:Reasons?|Stocks?)|Better Buy|Zacks (?:Investment|Rank)|Trending Stock"
    r"|shares (?:added to|removed from|acquired by|sold by|purchased by)"
    r"|^[\d,]+\+? Shares (?:in|of)|(?:Buys|Purchases?|Sells) Shares (?:in|of)"
    r"|(?:Takes|Makes New) .{0,25}(?:Position|Investment) in|Invests? \$[\d,.]+|13F"
    r"|portfolio.{0,20}(?:quiverquant|according to a)"
    r"|\b(?:Acquires|Buys|Purchases|Sells|Snaps Up|Reduces|Boosts|Trims|Grows)\s+"
    r"(?:its\s+)?(?:stake|position|holdings?)?\s*(?:of|in|by)?\s*[\d,]+\+?\s+shares\b"
    r"|\bHas \$[\d,.]+ (?:Million|Billion) (?:Stock )?(?:Holdings|Position|Stake)\b"
)

# Pieces of which every match of the pattern above contains at least one, in lower case.
LOW_CONTENT_PIECES = (
    "stock", "share", "s why", "s what", "need to know", "s going on with", "still", "should you buy", "hold",
    "reason", "better buy", "zacks", "position in", "invest", "13f", "portfolio", "has $",
)

# Keywords that make a headline relevant to a whole sector.
SECTOR_KEYWORDS = {
    "Technology": (
        "ai", "artificial intelligence", "chip", "chips", "semiconductor",
        "software", "cloud", "cybersecurity", "data center", "data centers",
    ),
    "Communication Services": (
        "streaming", "advertising", "ad revenue", "social media", "telecom",
        "wireless", "broadband", "5g",
    ),
    "Consumer Cyclical": (
        "retail sales", "consumer spending", "e-commerce", "auto sales",
        "vehicle sales", "electric vehicle", "tariff", "tariffs",
    ),
    "Consumer Defensive": (
        "retail sales", "consumer spending", "grocery", "beverage",
    ),
    "Financial Services": (
        "rate hike", "rate cut", "federal reserve", "fed", "banking",
        "interest rates", "credit", "payments", "fintech",
    ),
    "Industrials": (
        "aerospace", "defense", "manufacturing", "supply chain", "factory",
        "airline", "aviation",
    ),
    "Energy": (
        "oil", "gas", "crude", "opec", "drilling", "refinery", "pipeline",
    ),
    "Healthcare": (
        "drug", "fda", "clinical trial", "biotech", "pharma", "vaccine",
    ),
}

# Legal-form words dropped from both ends of a company name.
LEGAL_SUFFIX_WORDS = (
    "inc", "incorporated", "corp", "corporation", "co", "cos", "company",
    "ltd", "limited", "plc", "llc", "lp", "llp", "pte", "sarl", "gmbh",
    "sa", "sas", "nv", "bv", "ag", "se", "spa", "ab", "asa", "oyj", "as", "kgaa",
    "holding", "holdings", "group", "the",
)

# One-word name cores that are ordinary words.
AMBIGUOUS_NAME_CORES = (
    "target", "sea", "box", "gap", "shell", "ford", "key", "cross",
    "square", "block", "match", "unity", "arrow", "sun", "star",
    "first", "general", "national", "global", "standard", "premier",
    "energy", "power", "health", "service", "systems", "industries",
    "brands", "foods", "express", "motion", "signal", "vision",
    "focus", "edge", "peak", "summit", "pioneer", "eagle", "anchor",
    "compass", "apex", "core", "prime", "elite", "liberty",
    "atlantic", "pacific", "western", "eastern", "northern",
    "southern", "central",
)
MIN_NEEDLE_LENGTH = 2

# --- generated-text checks -------------------------------------------------
MAX_REASONING_CHARS = 800
MAX_ANSWER_CHARS = 400

# Phrases that make a generated text suspicious.
SUSPICIOUS_TEXT_PATTERN = (
    r"\bignore (the )?(above|previous|prior) instructions\b"
    r"|\bdisregard (the )?(above|previous|prior) instructions\b"
    r"|\bnew instructions\b"
    r"|\bsystem prompt\b"
    r"|\byou are now (an ai|in developer mode|acting as)\b"
    r"|\bas an ai( language model)?\b"
)

# --- fusion ----------------------------------------------------------------
BUCKET_THRESHOLD_PCT = 15.0
CONFIDENCE_CAP = 0.95
CONFIDENCE_SPAN_PCT = 50.0
CONFIDENCE_BONUS = 0.10

# Fixed values: (reaction, valuation bucket, recommendation, base confidence).
FUSION_ROWS = (
    ("good", "undervalued", "BUY", 0.80),
    ("good", "near_fair", "HOLD", 0.60),
    ("good", "overvalued", "HOLD", 0.65),
    ("good", "no_data", "HOLD", 0.55),
    ("bad", "undervalued", "HOLD", 0.60),
    ("bad", "near_fair", "SELL", 0.70),
    ("bad", "overvalued", "SELL", 0.80),
    ("bad", "no_data", "SELL", 0.55),
    ("neutral", "undervalued", "BUY", 0.65),
    ("neutral", "near_fair", "HOLD", 0.70),
    ("neutral", "overvalued", "SELL", 0.65),
    ("neutral", "no_data", "HOLD", 0.60),
    ("overreaction_down", "undervalued", "BUY", 0.85),
    ("overreaction_down", "near_fair", "BUY", 0.70),
    ("overreaction_down", "overvalued", "HOLD", 0.60),
    ("overreaction_down", "no_data", "HOLD", 0.55),
    ("overreaction_up", "undervalued", "HOLD", 0.60),
    ("overreaction_up", "near_fair", "SELL", 0.70),
    ("overreaction_up", "overvalued", "SELL", 0.85),
    ("overreaction_up", "no_data", "HOLD", 0.55),
)

# --- valuation -------------------------------------------------------------
ASSET_HEAVY_SECTORS = ("Energy", "Industrials", "Basic Materials", "Utilities")
REIT_SECTORS = ("Real Estate",)

# Rough median trailing P/E per sector.
SECTOR_MEDIAN_PE = {
    "Technology": 28.0,
    "Healthcare": 22.0,
    "Financial Services": 13.0,
    "Consumer Cyclical": 19.0,
    "Consumer Defensive": 21.0,
    "Communication Services": 18.0,
    "Industrials": 19.0,
    "Energy": 12.0,
    "Basic Materials": 15.0,
    "Utilities": 17.0,
}

BASIS_LABELS = {
    "revenue": "Revenue-based",
    "eps": "EPS-based",
    "fcf": "FCF-based",
    "dividends": "Dividend-based",
}
FALLBACK_BASIS_ORDER = ("fcf", "eps", "dividends", "revenue")

DIVIDEND_PAYOUT_THRESHOLD = 0.55
DIVIDEND_PAYOUT_CEILING = 1.20
PAYOUT_BLEND_HALF_WIDTH = 0.05
VALUATION_DISPLAY_CAP_PCT = 150.0
DISCOUNT_RATE = 0.10
SCENARIO_PROBABILITY = 1 / 3
SCENARIOS = ("normal", "best", "worst")

WORST_EXIT_ASSET_HEAVY = 12.0
WORST_EXIT_DEFAULT = 13.0
NORMAL_EXIT = 20.0
BEST_EXIT = 25.0
REVENUE_EXIT = {"normal": 3.0, "best": 6.0, "worst": 1.0}

G1_FALLBACK = {"normal": 0.08, "best": 0.10, "worst": 0.04}
G1_CAP = 0.30
G1_FLOOR = -0.10
G2_CEILING = {"normal": 0.10, "best": 0.12, "worst": 0.04}
G2_FLOOR = 0.0
G2_DIVIDENDS_FLOOR = -0.05
CONSENSUS_MAGNITUDE_CAP = 0.60
CONSENSUS_OFFSET_CAP = 0.10
GROWTH_BEST_SPREAD = 0.02
GROWTH_WORST_SPREAD = -0.04
ROE_CAP = 0.25
ROE_FLOOR = 0.02
PEG_MIN_GROWTH = 0.02
ONE_TIME_PE_RATIO = 0.5
LOW_PE_THRESHOLD = 6.0
EPS_SURPRISE_LIMIT = 0.75
PRICE_TOLERANCE_DAYS = 10
YEAR_AGO_TOLERANCE_DAYS = 20

EPS_METRICS = ("Diluted EPS", "Basic EPS")
REVENUE_METRICS = ("Total Revenue",)

OPERATING_MARGIN_STRONG = 0.15
OPERATING_MARGIN_WEAK = 0.08
ROE_STRONG = 0.15
ROE_WEAK = 0.08
PEG_CHEAP = 1.0
PEG_RICH = 2.0

# --- calibration -----------------------------------------------------------
X_CANDIDATES = (0.01, 0.015, 0.02, 0.025, 0.03)
Y_CANDIDATES = (0.03, 0.04, 0.05, 0.06, 0.07)
Z_CANDIDATES = (0.4, 0.5, 0.6)
OVERREACTION_BAND = (0.05, 0.12)
NEUTRAL_BAND = (0.25, 0.45)
PERCENTS = (5, 10, 25, 50, 75, 90, 95)

# --- rows ------------------------------------------------------------------
UNAVAILABLE = "Data unavailable."
REBALANCE_FLOOR = 30
BLOCK_MISSING_RATE = 0.15
HOLDOUT_FRACTION = 0.2
REACTION_WEIGHTS = {
    "good": 0.22, "bad": 0.22, "neutral": 0.26,
    "overreaction_down": 0.15, "overreaction_up": 0.15,
}
SECTOR_OVERRIDE_RATE = 0.40
COMMENTARY_RATE = 0.15
STALE_HEADLINE_RATE = 0.25
STALE_DAYS = 60
RECENT_DAYS = 6

# Unrelated market headlines mixed into a news block.
NOISE_HEADLINES = (
    "Fed leaves interest rates unchanged in split decision",
    "Oil prices dip amid oversupply concerns",
    "Treasury yields climb on inflation data",
    "Dollar strengthens against euro after jobs report",
    "Wall Street mixed as investors await earnings season",
    "Gold prices hold steady near record highs",
    "Asian markets close lower on trade tension fears",
    "Consumer confidence index ticks up slightly",
    "Housing starts fall for third consecutive month",
    "Retail sales beat expectations in broad-based gain",
    "Crude oil rebounds on OPEC+ supply cut signals",
    "Bond markets rally as recession fears ease",
)
NOISE_PUBLISHERS = ("Reuters", "Bloomberg", "MarketWatch", "CNBC")
NEWS_LINE_PATTERN = r"^- \[([A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4})\] (.+) - [^-]+$"

# User questions and their types, aligned by position.
USER_QUESTIONS = (
    ("direction", "Will ${ticker} go up or down based on recent news?"),
    ("buy", "Is {ticker} a buy right now?"),
    ("outlook", "What's the outlook for {ticker} this quarter?"),
    ("worry", "Should I be worried about my {ticker} position?"),
    ("impact", "How will the latest news affect ${ticker}?"),
    ("sell", "Is now a good time to sell {ticker}?"),
    ("sentiment", "What's the sentiment on {ticker} today?"),
    ("earnings", "Will {ticker} beat earnings expectations?"),
    ("read", "Give me your read on {ticker}."),
    ("none", ""),
)

# The answer per question type and recommendation.
ANSWER_TEMPLATES = {
    "direction": {
        "BUY": "The recent news points to upward momentum for {ticker}, so the near-term bias leans higher.",
        "SELL": "The recent news points to downward pressure on {ticker}, so the near-term bias leans lower.",
        "HOLD": "The recent news doesn't point clearly in either direction for {ticker}, so a flat near-term move is the more likely outcome.",
    },
    "buy": {
        "BUY": "Yes, the current signals lean favorably enough that {ticker} looks like a reasonable buy here.",
        "SELL": "No, the current signals are negative enough that {ticker} doesn't look like a buy right now.",
        "HOLD": "It's a close call - nothing here strongly argues for or against buying {ticker} at current levels.",
    },
    "outlook": {
        "BUY": "The outlook for {ticker} this quarter looks positive based on the latest developments.",
        "SELL": "The outlook for {ticker} this quarter looks challenged based on the latest developments.",
        "HOLD": "The outlook for {ticker} this quarter looks steady, without a clear positive or negative catalyst.",
    },
    "worry": {
        "BUY": "No significant cause for concern - the latest news on {ticker} is constructive.",
        "SELL": "Some caution is warranted - the latest news on {ticker} raises real concerns.",
        "HOLD": "Not particularly - nothing in the latest news materially changes the risk picture for {ticker}.",
    },
    "impact": {
        "BUY": "The latest news should be a net positive for {ticker}.",
        "SELL": "The latest news should weigh on {ticker}.",
        "HOLD": "The latest news is unlikely to move {ticker} much either way.",
    },
    "sell": {
        "BUY": "Not really - the current signals argue for holding rather than selling {ticker}.",
        "SELL": "It's a reasonable moment to consider trimming {ticker}, given the negative signals.",
        "HOLD": "There's no strong signal here to justify selling {ticker} now versus holding.",
    },
    "sentiment": {
        "BUY": "Sentiment on {ticker} is bullish today.",
        "SELL": "Sentiment on {ticker} is bearish today.",
        "HOLD": "Sentiment on {ticker} is neutral today.",
    },
    "earnings": {
        "BUY": "The signals point toward {ticker} beating expectations.",
        "SELL": "The signals point toward {ticker} falling short of expectations.",
        "HOLD": "There's no strong signal either way on whether {ticker} beats expectations.",
    },
    "read": {
        "BUY": "Overall, {ticker} looks bullish based on the current data and news.",
        "SELL": "Overall, {ticker} looks bearish based on the current data and news.",
        "HOLD": "Overall, {ticker} looks balanced - no strong read either way right now.",
    },
    "none": {
        "BUY": "{ticker} is showing a bullish setup based on current data and news.",
        "SELL": "{ticker} is showing a bearish setup based on current data and news.",
        "HOLD": "{ticker} looks neutral right now, without a clear directional catalyst.",
    },
}

# How each reaction reads in the fallback reasoning.
REACTION_PHRASES = {
    "good": "positive for the stock",
    "bad": "negative for the stock",
    "neutral": "routine, without a clear directional catalyst",
    "overreaction_down": "an apparent overreaction to the downside - the recent move looks larger than this headline alone would justify",
    "overreaction_up": "an apparent overreaction to the upside - the recent move looks larger than this headline alone would justify",
}
FALLBACK_REASONING = (
    "This headline about {ticker} reads as {phrase}. Combined with the valuation picture above, this resolves to "
    "{recommendation}. This reflects a deterministic rule (news reaction combined with valuation headroom), not a "
    "hand-verified causal read of the headline itself."
)

# The direction each reaction leans to on its own.
REACTION_LEAN = {
    "good": "BUY", "overreaction_down": "BUY",
    "bad": "SELL", "overreaction_up": "SELL",
    "neutral": None,
}

# Clauses that tie the reaction to the valuation bucket.
FUSION_CLAUSES = {
    "reinforcing": (
        "{ticker} also screens as {bucket_word} on a DCF basis (~{pct}%), reinforcing that read.",
        "That lines up with the DCF, which reads {bucket_word} by roughly {pct}% here too.",
        "The valuation picture agrees - {bucket_word} by about {pct}% on a DCF basis, corroborating the read.",
    ),
    "capping": (
        "That said, {ticker} already screens as {bucket_word} by roughly {pct}% on a DCF basis - a real signal, but not one with room left to act on, so this lands at {recommendation} rather than a stronger call.",
        "Still, the DCF reads {bucket_word} by about {pct}% here - real evidence, but at this price there's no headroom left, which caps this at {recommendation} instead of a full directional call.",
        "Weighed against a DCF that's {bucket_word} by ~{pct}%, though: the signal is real, but it doesn't by itself create room to act on - {recommendation}, not a stronger call.",
    ),
    "driving": (
        "No strong catalyst either way here, but {ticker} is trading at a level that screens {bucket_word} versus its estimated intrinsic value (~{pct}%) - a real, if imperfect, signal on its own.",
        "Nothing in the news itself moves the needle, but the DCF reads {bucket_word} by about {pct}% - worth weighing even without a fresh catalyst.",
        "The news is routine, but {ticker}'s valuation - {bucket_word} by roughly {pct}% on a DCF basis - is doing the real work here.",
    ),
    "near_fair": (
        "{ticker} is trading close to its estimated intrinsic value here, so valuation isn't a strong argument either way - that leaves {recommendation} as the call.",
        "No real valuation edge either way for {ticker} right now - it's trading near fair value on a DCF basis, so this stays at {recommendation}.",
    ),
    "no_data": (
        "No valuation estimate is available here, which tempers this to {recommendation}.",
        "With no usable valuation read available, there's nothing to confirm extra headroom, so this stays at {recommendation}.",
    ),
}

# Phrasings of the quality and growth tiers.
QUALITY_PHRASES = {
    "strong": (
        "Operating margins and ROE both point to a genuinely high-quality underlying business",
        "Strong operating margins paired with a high ROE suggest real competitive advantage here",
        "Both margins and returns on equity look like hallmarks of a well-run, capital-efficient business",
    ),
    "weak": (
        "Thin operating margins and weak ROE argue for caution regardless of the valuation gap",
        "Weak profitability metrics here are a real yellow flag, independent of what the valuation gap suggests",
        "Margins and capital efficiency both look shaky, which tempers how much confidence the valuation gap deserves",
    ),
    "adequate": (
        "Operating margins and ROE are unremarkable here - adequate, not standout",
        "Nothing special about the underlying profitability here - solid enough, not a standout",
        "Margins and ROE sit in an unremarkable middle ground - no particular red flag, no particular strength",
    ),
}
GROWTH_PHRASES = {
    "unknown": (
        "growth looks too uncertain to gauge against the price",
        "there isn't a reliable growth estimate to weigh the price against",
        "growth expectations are too unclear here to say whether the price is justified",
    ),
    "cheap": (
        "the price looks reasonable relative to expected growth (PEG under 1)",
        "relative to its growth outlook, the price doesn't look demanding (PEG under 1)",
        "growth-adjusted, this isn't an expensive price to pay (PEG under 1)",
    ),
    "rich": (
        "the price looks rich relative to expected growth (PEG over 2)",
        "growth-adjusted, this price is a stretch (PEG over 2)",
        "relative to its growth outlook, this is a demanding price to pay (PEG over 2)",
    ),
    "fair": (
        "the price is roughly in line with expected growth",
        "growth-adjusted, the price looks fair, neither cheap nor expensive",
        "relative to its growth outlook, the price doesn't stand out either way",
    ),
}
COMMENTARY_CONNECTORS = (", and ", ". Separately, ", " - ")

# Informal sector names and the formal sector each belongs to.
INFORMAL_SECTORS = {
    "tech": "Technology",
    "auto": "Consumer Cyclical",
    "semiconductors": "Technology",
    "e-commerce": "Consumer Cyclical",
    "software": "Technology",
    "social-media": "Communication Services",
    "banking": "Financial Services",
    "entertainment": "Communication Services",
    "streaming": "Communication Services",
    "fintech": "Financial Services",
    "gig-economy": "Technology",
    "retail": "Consumer Cyclical",
    "crypto": "Financial Services",
    "robotics": "Industrials",
    "biotech": "Healthcare",
    "logistics": "Industrials",
    "energy": "Energy",
    "industrials": "Industrials",
    "aerospace": "Industrials",
    "consumer-staples": "Consumer Defensive",
}

# The prompt formats; %s marks the fields in order.
REACTION_PROMPT = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:

Classify how the market has reacted to the following news for this stock, given its recent price move, and output JSON containing your classification, in exactly this shape:
{"news_reaction": "good|bad|neutral|overreaction_down|overreaction_up"}

news_reaction definitions:
- good: the news is genuinely positive for the stock.
- bad: the news is genuinely negative for the stock.
- neutral: the news is routine/ambiguous, not a real catalyst either way.
- overreaction_down: the price fell more than this news alone would justify - a plausible overreaction to the downside.
- overreaction_up: the price rose more than this news alone would justify - a plausible overreaction to the upside.

### Input:

Target Stock: %s
Recent Price Move: %s

Recent News & Results:
%s

### Response:

%s"""

ANALYSIS_PROMPT = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:

Decide the recommended action for this stock (BUY, SELL, or HOLD) yourself from the news reaction, valuation, earnings, and market data below, then explain your reasoning and answer the user's question. Output JSON in exactly this shape:
{"recommendation": "BUY|SELL|HOLD", "reasoning": "...", "answer": "..."}

### Input:

Target Stock: %s
User Question: %s
News Reaction: %s

Current Market Data:
%s

Valuation:
%s

Recent Earnings:
%s

Recent News & Results:
%s

### Response:

%s"""

# --- evaluation ------------------------------------------------------------
REACTION_FIELD_PATTERN = r'"news_reaction"\s*:\s*"(good|bad|neutral|overreaction_down|overreaction_up)"'
RECOMMENDATION_FIELD_PATTERN = r'"recommendation"\s*:\s*"(BUY|SELL|HOLD)"'
ANSWER_FIELD_PATTERN = r'"answer"\s*:\s*"((?:[^"\\]|\\.)*)"'
REASONING_FIELD_PATTERN = r'"reasoning"\s*:\s*"((?:[^"\\]|\\.)*)"'
SHIP_GATE = 0.90
SAMPLES_PER_PAIR = 3
MISMATCH_LIMIT = 20
PROGRESS_STEP = 20
