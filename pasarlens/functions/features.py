"""Derived features of the retail tables, as expressions over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pasarlens.functions.exact import flag

# --- Fixed values: labels, limits and weights that define the features -----------------

AGE_BANDS = ((25, "Gen-Z"), (35, "Millennial"), (45, "Gen-X"))
AGE_BEYOND = "Boomer"
RECENCY_BANDS = ((30, "active"), (90, "warm"), (180, "cooling"))
RECENCY_BEYOND = "churned"
RECENCY_WEIGHTS = ((30, 1.0), (90, 0.6))
RECENCY_WEIGHT_BEYOND = 0.2
ENGAGEMENT_WEIGHTS = {"email": 0.3, "loyalty": 0.4, "recency": 0.3}
NEW_USER_DAYS = 30
BIG_DISCOUNT_PCT = 30
NEW_ARRIVAL_DAYS = 90
POPULARITY_WEIGHTS = {"sales": 0.5, "rating": 0.3, "reviews": 0.2}
INTERACTION_SCORES = {
    "view": 1,
    "search": 1,
    "like": 3,
    "add_to_cart": 4,
    "checkout": 5,
    "purchase": 7,
    "share": 3,
    "review": 5,
}
FUNNEL_STAGES = {
    "awareness": ("view", "search"),
    "consideration": ("like", "add_to_cart"),
    "conversion": ("checkout", "purchase"),
}
FUNNEL_BEYOND = "advocacy"
ODD_HOURS_BEFORE = 5
HIGH_VALUE_TILES = 20
HIGH_VALUE_FROM_TILE = 19
HIGH_VELOCITY_ABOVE = 10
WEEKEND_DAYS = (1, 7)  # Sunday, Saturday
RATING_RANGE = (1, 5)
POSITIVE_FROM, NEGATIVE_TO = 4, 2
HIGH_QUALITY_WORDS, MEDIUM_QUALITY_WORDS = 10, 5
NO_CLICK = -1
CLICK_BANDS = ((3, "top3"), (10, "top10"))
CLICK_BEYOND = "below10"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
WORD_GAP = r"\s+"
ETL_VERSION = "v2.0"


def band(
    column: Column, edges: Sequence[tuple[float, object]], beyond: object, closed: bool
) -> Column:
    """Label of the first edge the value stays under (or at, if ``closed``).

    Null is under no edge, so it falls into ``beyond``.
    """
    label = None
    for limit, name in edges:
        within = column <= limit if closed else column < limit
        label = F.when(within, F.lit(name)) if label is None else label.when(within, F.lit(name))
    return label.otherwise(F.lit(beyond))


# --- users ------------------------------------------------------------------------------


def age_group(age: Column) -> Column:
    return band(age, AGE_BANDS, AGE_BEYOND, closed=False)


def recency_bucket(days: Column) -> Column:
    return band(days, RECENCY_BANDS, RECENCY_BEYOND, closed=True)


def engagement_score(open_rate: Column, loyalty: Column, days: Column) -> Column:
    """Weighted mix of mail opening, loyalty (0-100) and recency, 4 decimals."""
    recency = band(days, RECENCY_WEIGHTS, RECENCY_WEIGHT_BEYOND, closed=True)
    parts = {"email": open_rate, "loyalty": loyalty / 100, "recency": recency}
    return F.round(sum_of(parts, ENGAGEMENT_WEIGHTS), 4)


def sum_of(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    terms = [parts[name] * weight for name, weight in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def is_new_user(tenure_days: Column) -> Column:
    return flag(tenure_days < NEW_USER_DAYS)


# --- products ---------------------------------------------------------------------------


def availability(stock: Column) -> Column:
    return F.when(stock > 0, "in_stock").otherwise("out_of_stock")


def is_big_discount(discount_pct: Column) -> Column:
    return flag(discount_pct >= BIG_DISCOUNT_PCT)


def popularity_score(sales: Column, rating: Column, reviews: Column) -> Column:
    parts = {
        "sales": F.log1p(sales.cast("double")),
        "rating": rating / 5,
        "reviews": F.log1p(reviews.cast("double")),
    }
    return F.round(sum_of(parts, POPULARITY_WEIGHTS), 4)


def is_new_arrival(days_since_listed: Column) -> Column:
    return flag(days_since_listed < NEW_ARRIVAL_DAYS)


def margin_proxy(final_price: Column, discount_pct: Column) -> Column:
    """Takes the discount off the final price once more; kept as the defined feature."""
    return F.round(final_price * (1 - discount_pct / 100), 2)


# --- interactions -----------------------------------------------------------------------


def implicit_score(given: Column, kind: Column) -> Column:
    """The recorded score, else the score of the interaction type, else null."""
    pairs = [F.lit(x) for pair in INTERACTION_SCORES.items() for x in pair]
    return F.coalesce(given, F.create_map(*pairs)[kind]).cast("int")


def funnel_stage(kind: Column) -> Column:
    stage = None
    for name, kinds in FUNNEL_STAGES.items():
        stage = (F if stage is None else stage).when(kind.isin(*kinds), name)
    return stage.otherwise(FUNNEL_BEYOND)


# --- time -------------------------------------------------------------------------------


def parse_timestamp(text: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` wall-clock text; anything else becomes null."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


_CALENDAR = {
    "hour_of_day": F.hour,
    "day_of_week": F.dayofweek,
    "week_of_year": F.weekofyear,
    "month": F.month,
    "year": F.year,
    "is_weekend": lambda ts: flag(F.dayofweek(ts).isin(*WEEKEND_DAYS)),
}


def calendar(ts: str, *parts: str) -> dict[str, Column]:
    """Named calendar parts of a timestamp column, for ``withColumns``."""
    return {part: _CALENDAR[part](F.col(ts)) for part in parts or _CALENDAR}


def is_odd_hour(ts: Column) -> Column:
    return flag(F.hour(ts) < ODD_HOURS_BEFORE)


def days_since(as_of: str, ts: Column) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(ts))


# --- transactions -----------------------------------------------------------------------


def is_high_value(tile: Column) -> Column:
    return flag(tile >= HIGH_VALUE_FROM_TILE)


def is_high_velocity(per_day: Column) -> Column:
    return flag(per_day > HIGH_VELOCITY_ABOVE)


def fraud_score(*signals: Column) -> Column:
    """Number of raised signals; null when one of them is unknown."""
    total = signals[0]
    for signal in signals[1:]:
        total = total + signal
    return total


def effective_discount_pct(discount: Column, unit_price: Column) -> Column:
    return F.round(F.try_divide(discount, unit_price) * 100, 2)


# --- reviews ----------------------------------------------------------------------------


def word_count(text: Column) -> Column:
    return F.size(F.split(text, WORD_GAP))


def text_shape(text: str) -> dict[str, Column]:
    body = F.col(text)
    return {
        "char_count": F.length(body),
        "word_count": word_count(body),
        "has_exclamation": flag(F.contains(body, F.lit("!"))),
        "has_question": flag(F.contains(body, F.lit("?"))),
    }


def sentiment(rating: Column) -> Column:
    return (
        F.when(rating >= POSITIVE_FROM, "positive")
        .when(rating <= NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def review_quality(verified: Column, words: Column) -> Column:
    long_enough = words >= HIGH_QUALITY_WORDS
    return (
        F.when(long_enough & (verified == 1), "high")
        .when(words >= MEDIUM_QUALITY_WORDS, "medium")
        .otherwise("low")
    )


def clip_round_rating(prediction: Column) -> Column:
    """Nearest whole rating (halves to even), held inside the rating range."""
    low, high = (F.lit(float(limit)) for limit in RATING_RANGE)
    return F.least(F.greatest(F.bround(prediction, 0), low), high)


# --- search -----------------------------------------------------------------------------


def normal_query(query: Column) -> Column:
    return F.lower(F.trim(query))


def query_shape(query: str) -> dict[str, Column]:
    text = F.col(query)
    return {"query_length": F.length(text), "query_word_count": word_count(text)}


def filter_flags(category: Column, low: Column, high: Column) -> dict[str, Column]:
    return {
        "has_category_filter": flag(category.isNotNull()),
        "has_price_filter": flag(F.coalesce(low, high).isNotNull()),
    }


def is_zero_result(n_results: Column) -> Column:
    return flag(n_results == 0)


def clicked_or_zero(clicked: Column) -> Column:
    return F.coalesce(clicked, F.lit(0)).cast("int")


def click_position_bucket(position: Column) -> Column:
    return F.when(position == NO_CLICK, "no_click").otherwise(
        band(position, CLICK_BANDS, CLICK_BEYOND, closed=True)
    )


# --- labels and standard forms ----------------------------------------------------------


def relevance(clicked: Column, purchased: Column) -> Column:
    return clicked.cast("int") + 2 * purchased.cast("int")


def log_target(amount: Column) -> Column:
    return F.log1p(amount)


def from_log_target(prediction: Column) -> Column:
    return F.expm1(prediction)


def has_purchased(n_purchases: Column) -> Column:
    return flag(n_purchases > 0)


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))


def title_trimmed(text: Column) -> Column:
    return F.initcap(F.trim(text))


def audit(as_of: str) -> dict[str, Column]:
    """When and by which version a row was made; ``as_of`` keeps reruns identical."""
    return {
        "processed_at": F.lit(as_of).cast("timestamp_ntz"),
        "etl_version": F.lit(ETL_VERSION),
    }
