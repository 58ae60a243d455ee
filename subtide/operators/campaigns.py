"""Campaign audiences at a point in time, send records and campaign performance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.domain import AUDIENCE_CAP, CAMPAIGN_SEGMENTS, DEFAULT_SEGMENT, LOW_ACTIVITY_DAYS, UPSELL_PLANS
from subtide.functions.numbers import ratio, round_as_printed, round_half_even
from subtide.functions.running import running_total

# Users of a quarter that are dealt together.
_SLICE_USERS = 65_536

# Days in the first of the two words that hold a quarter and the days before it.
_WORD = 60

_ACTIVE, _CHURNED = "active", "churned"


def segment_of_type(campaign_type: Column) -> Column:
    """The segment a campaign type addresses; unknown types address everyone active."""
    segment = F.lit(DEFAULT_SEGMENT)
    for name, target in CAMPAIGN_SEGMENTS.items():
        segment = F.when(campaign_type == name, target).otherwise(segment)
    return segment


def campaign_segments(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(
        "campaign_id", "campaign_type", segment_of_type(F.col("campaign_type")).alias("segment")
    )


def _titled(text: Column) -> Column:
    """Every run of letters with a capital first and small letters after it."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def campaign_labels(campaigns: DataFrame) -> DataFrame:
    """Campaign names: by type, with the campaign's number within its type in send
    order, or its quarter, and the month or year it is sent in."""
    numbered = running_total(
        campaigns.select("campaign_id", "campaign_type", "send_date"),
        F.lit(1).cast("long"),
        day="send_date",
        key="campaign_id",
        within=("campaign_type",),
        name="ordinal",
    )
    month = F.date_format("send_date", "MMM yyyy")
    number = F.col("ordinal").cast("string")
    kind = F.col("campaign_type")

    def series(title: Column) -> Column:
        return F.concat(title, F.lit(" #"), number, F.lit(" — "), month)

    # The wording of each type's name.
    name = (
        F.when(kind == "newsletter", F.concat(F.lit("Monthly Newsletter — "), month))
        .when(
            kind == "promo",
            F.concat(F.lit("Q"), F.quarter("send_date"), F.lit(" Promotion — "), F.year("send_date")),
        )
        .when(kind == "upsell", series(F.lit("Upgrade Offer")))
        .when(kind == "re_engagement", series(F.lit("Re-engagement")))
        .when(kind == "winback", series(F.lit("Winback Campaign")))
        .otherwise(series(_titled(kind)))
    )
    return numbered.select("campaign_id", "campaign_type", "send_date", "ordinal", name.alias("campaign_name"))


def _dealt(users: DataFrame) -> DataFrame:
    """``users`` in as many partitions as a shuffle has. A user becomes a row per campaign in the same task, so adaptive
    execution must not merge partitions by the bytes they have before."""
    return users.repartition(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _reach(calendar: DataFrame) -> tuple[Column, Column]:
    """First and last send date, as scalar subqueries that run with the plan."""
    return calendar.agg(F.min("send_date")).scalar(), calendar.agg(F.max("send_date")).scalar()


def _quarters(calendar: DataFrame) -> Column:
    """The quarters that have campaigns, as a scalar subquery."""
    return calendar.agg(F.collect_set(F.trunc("send_date", "quarter"))).scalar()


def _users_in_reach(subs: DataFrame, reach: tuple[Column, Column], active: bool, churned: bool) -> DataFrame:
    """Users with the half-open date intervals in which they are active, or have churned. The scan already leaves out
    users whom no campaign can reach."""
    first, last = F.col("_first"), F.col("_last")
    signup, churn, no_date = F.col("signup_date"), F.col("churn_date"), F.lit(None).cast("date")
    intervals, in_reach = [], F.lit(False)
    if active:
        intervals.append(F.struct(F.lit(_ACTIVE).alias("kind"), signup.alias("since"), churn.alias("until")))
        in_reach = in_reach | ((signup <= last) & (churn.isNull() | (churn > first)))
    if churned:
        gone = (F.col("status") == "churned") & (churn <= last)
        entry = F.struct(F.lit(_CHURNED).alias("kind"), churn.alias("since"), no_date.alias("until"))
        intervals.append(F.when(F.col("status") == "churned", entry))
        in_reach = in_reach | gone
    return (
        subs.select("user_id", "plan", "status", "signup_date", "churn_date", reach[0].alias("_first"), reach[1].alias("_last"))
        .where(in_reach)
        .select("user_id", "plan", "_first", "_last", F.array(*intervals).alias("_intervals"))
    )


def _memberships(users: DataFrame, wanted: Column) -> DataFrame:
    """One row per interval of ``users`` and quarter that it shares with the campaigns; ``wanted`` are the quarters that have some."""
    first, last, since, until = F.col("_first"), F.col("_last"), F.col("since"), F.col("until")
    quarters = F.sequence(
        F.trunc(F.greatest(since, first), "quarter"),
        F.trunc(F.least(F.date_sub(until, 1), last), "quarter"),
        F.expr("interval 3 months"),
    )
    return (
        users.select("user_id", "plan", "_first", "_last", F.inline("_intervals"))
        .where((since <= last) & (until.isNull() | ((until > first) & (until > since))))
        .select("user_id", "plan", "kind", "since", "until", F.explode(F.array_intersect(quarters, wanted)).alias("quarter"))
    )


def _cell() -> Column:
    return F.concat("kind", "quarter")


def _slices_of_quarters(memberships: DataFrame) -> Column:
    """Into how many slices the users of a row's kind and quarter are dealt: one for every ``_SLICE_USERS`` of them.

    The counts are a scalar subquery, a map with the quarters that need more than one.
    """
    counted = memberships.groupBy(_cell().alias("cell")).agg(F.ceil(F.count("*") / _SLICE_USERS).alias("slices")).where("slices > 1")
    many = counted.agg(F.map_from_entries(F.collect_list(F.struct("cell", "slices")))).scalar()
    return F.coalesce(F.try_element_at(many, _cell()), F.lit(1).cast("long"))


def _members(calendar: DataFrame, memberships: DataFrame, slices: Column) -> DataFrame:
    """Each campaign of ``calendar`` with the users its segment's dates and plans allow.

    Users and campaigns meet on the calendar quarters a user's interval covers, not by
    comparing every user with every campaign. Quarters are few, so the users of a quarter are dealt into ``slices``
    and every slice meets the quarter's campaigns: a campaign is copied as often as its quarter's users ask for. Which side travels is up to
    adaptive execution.
    """
    keyed = calendar.withColumns(
        {
            "kind": F.when(F.col("segment") == "churned", _CHURNED).otherwise(_ACTIVE),
            "quarter": F.trunc("send_date", "quarter"),
        }
    ).withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
    sent = F.col("send_date")
    in_interval = (F.col("since") <= sent) & (F.col("until").isNull() | (F.col("until") > sent))
    plan_fits = (F.col("segment") != "starter_growth") | F.col("plan").isin(UPSELL_PLANS)
    rows = memberships.withColumn("_slice", F.pmod(F.xxhash64("user_id"), slices))
    return rows.join(keyed, ["kind", "quarter", "_slice"]).where(in_interval & plan_fits)


def _shifted(function: str, value: Column, by: Column) -> Column:
    return F.call_function(function, value, by)


def _recent_days(events: DataFrame, reach: tuple[Column, Column], wanted: Column | None = None) -> DataFrame:
    """Per user and quarter (of those ``wanted``, if given), the days of events that are recent on some date of the quarter, as bits of two words.

    Bit 0 is the first day that is recent when the quarter begins. A day's events matter for its own quarter and, at
    the end of it, for the next. Words are summed map-side, so what is shuffled is at most a row per
    user, quarter and task, however many campaigns or events there are.
    """
    first, last = reach
    span, day = LOW_ACTIVITY_DAYS - 1, F.col("event_date")
    quarters = F.array(F.trunc(day, "quarter"), F.trunc(F.date_add(day, span), "quarter"))
    quarters = F.array_distinct(quarters) if wanted is None else F.array_intersect(quarters, wanted)
    place, one, none = F.col("_place"), F.lit(1).cast("long"), F.lit(0).cast("long")
    return (
        events.where((day >= F.date_sub(first, span)) & (day <= last))
        .select("user_id", "event_date", F.explode(quarters).alias("quarter"))
        .withColumn("_place", F.datediff("event_date", "quarter") + span)
        .groupBy("user_id", "quarter")
        .agg(
            F.bit_or(F.when(place < _WORD, _shifted("shiftleft", one, place)).otherwise(none)).alias("early"),
            F.bit_or(F.when(place >= _WORD, _shifted("shiftleft", one, place - _WORD)).otherwise(none)).alias("late"),
        )
    )


def _recently_active(sent: Column) -> Column:
    """Whether a bit is set among the ``LOW_ACTIVITY_DAYS`` that end on the day ``sent``."""
    place, early, late = F.datediff(sent, "quarter"), F.col("early"), F.col("late")
    window, one, none = F.lit((1 << LOW_ACTIVITY_DAYS) - 1), F.lit(1).cast("long"), F.lit(0).cast("long")
    of_early = F.when(place < _WORD, _shifted("shiftright", early, place).bitwiseAND(window)).otherwise(none)
    beyond = F.greatest(place + (LOW_ACTIVITY_DAYS - _WORD), F.lit(0))
    of_late = F.when(place < _WORD, late.bitwiseAND(_shifted("shiftleft", one, beyond) - 1)).otherwise(
        _shifted("shiftright", late, place - _WORD).bitwiseAND(window)
    )
    return F.coalesce((of_early != 0) | (of_late != 0), F.lit(False))


def campaign_audience(
    campaigns: DataFrame, subs: DataFrame, events: DataFrame, only: str | None = None
) -> DataFrame:
    """Each campaign with every member of its segment on its send date; a campaign
    nobody qualifies for has no row.

    Only low_activity campaigns read the events; what they need of them joins users' quarters, not
    the much longer audience, and only quarters that have such a campaign. ``only`` says that all campaigns
    have this segment, so that the plan leaves out the others' parts.
    """
    segment = F.coalesce("segment", F.lit(DEFAULT_SEGMENT))
    calendar = campaigns.where(F.col("send_date").isNotNull()).select(
        "campaign_id", "send_date", segment.alias("segment")
    )
    quiet = F.col("segment") == "low_activity"
    parts = []
    users = _users_in_reach(subs, _reach(calendar), active=only != "churned", churned=only in (None, "churned"))
    slices = _slices_of_quarters(_memberships(users, _quarters(calendar)))
    if only != "low_activity":
        others = calendar.where(~quiet)
        parts.append(_members(others, _memberships(_dealt(users), _quarters(others)), slices))
    if only in (None, "low_activity"):
        quiet_ones = calendar.where(quiet)
        reach, wanted = _reach(quiet_ones), _quarters(quiet_ones)
        active = _memberships(_users_in_reach(subs, reach, active=True, churned=False), wanted)
        with_days = active.join(_recent_days(events, reach, wanted), ["user_id", "quarter"], "left")
        parts.append(_members(quiet_ones, with_days, slices).where(~_recently_active(F.col("send_date"))))
    return reduce(DataFrame.unionByName, [part.select("campaign_id", "send_date", "user_id") for part in parts])


def resolve_segment(segment: str, campaigns: DataFrame, subs: DataFrame, events: DataFrame) -> DataFrame:
    """Members of one segment on each campaign's send date, whatever segment the
    campaign itself names. An unknown segment means everyone active."""
    return campaign_audience(campaigns.withColumn("segment", F.lit(segment)), subs, events, only=segment)


def cap_audience(audience: DataFrame, cap: int = AUDIENCE_CAP) -> DataFrame:
    """At most ``cap`` users of each campaign, the same ones on every run: those with
    the smallest digest of campaign and user.

    Each campaign is first cut within slices of its users, so that the final cut of even a
    campaign to all users sees no more than ``cap`` rows per slice. Any slices give the same rows; the partitions
    that the audience comes in are cut before anything is shuffled.
    """
    order = ["_digest", "user_id"]
    sliced = Window.partitionBy("campaign_id", "_slice").orderBy(*order)
    whole = Window.partitionBy("campaign_id").orderBy(*order)
    return (
        audience.withColumns({"_digest": F.unhex(F.md5(F.concat_ws(":", "campaign_id", "user_id"))), "_slice": F.spark_partition_id()})
        .withColumn("_rank", F.row_number().over(sliced))
        .where(F.col("_rank") <= cap)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= cap)
        .drop("_digest", "_slice", "_rank")
    )


def campaign_audience_capped(
    campaigns: DataFrame, subs: DataFrame, events: DataFrame, cap: int = AUDIENCE_CAP
) -> DataFrame:
    return cap_audience(campaign_audience(campaigns, subs, events), cap)


def send_records(
    campaigns: DataFrame, subs: DataFrame, events: DataFrame, sends: DataFrame, cap: int = AUDIENCE_CAP
) -> DataFrame:
    """One record per campaign and recipient, numbered through the campaigns in send
    order, with the outcomes that ``sends`` observed for the pair (false if none).

    A campaign's at most ``cap`` recipients travel as one row until the campaigns are numbered, so that totals and records
    come from the same capped audience.
    """
    pair = ["campaign_id", "user_id"]
    recipient = F.struct("user_id", "send_date")
    capped = campaign_audience_capped(campaigns, subs, events, cap)
    sizes = capped.groupBy("campaign_id").agg(
        F.min(recipient)["send_date"].alias("send_date"), F.count("*").alias("size"), F.sort_array(F.collect_list(recipient)).alias("recipients")
    )
    numbered = running_total(sizes, F.col("size"), day="send_date", key="campaign_id", name="last_number", keys=campaigns)
    records = (
        numbered.where(F.col("campaign_id").isNotNull())
        .select("campaign_id", (F.col("last_number") - F.col("size")).alias("before"), F.posexplode("recipients").alias("position", "recipient"))
        .select("campaign_id", "recipient.*", (F.col("before") + F.col("position") + 1).alias("number"))
    )
    flags = ["opened", "clicked", "replied", "unsubscribed"]
    outcomes = sends.groupBy(*pair).agg(*[F.bool_or(flag).alias(flag) for flag in flags])
    return records.join(outcomes, pair, "left").select(
        F.format_string("snd_%06d", "number").alias("send_id"),
        "campaign_id",
        "user_id",
        "send_date",
        *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in flags],
    )


def campaign_calendar_overview(campaigns: DataFrame) -> DataFrame:
    return campaigns.agg(
        F.count("*").alias("campaigns"),
        F.min("send_date").alias("first_send"),
        F.max("send_date").alias("last_send"),
    )


def campaign_performance(sends: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Sends and engagement rates (3 places) by campaign type; sends are summed per
    campaign before they meet the calendar."""
    flags = {"opened": "open_rate", "clicked": "click_rate", "replied": "reply_rate", "unsubscribed": "unsub_rate"}
    measures = ["sends", *[f"{flag}_{part}" for flag in flags for part in ("yes", "known")]]
    per_campaign = sends.groupBy("campaign_id").agg(
        F.count("send_id").alias("sends"),
        *[F.count_if(flag).alias(f"{flag}_yes") for flag in flags],
        *[F.count(flag).alias(f"{flag}_known") for flag in flags],
    )
    return (
        per_campaign.join(campaigns.select("campaign_id", "campaign_type"), "campaign_id")
        .where(F.col("campaign_type").isNotNull())
        .groupBy("campaign_type")
        .agg(*[F.sum(name).alias(name) for name in measures])
        .select(
            "campaign_type",
            "sends",
            *[
                round_half_even(ratio(F.col(f"{flag}_yes"), F.col(f"{flag}_known")), 3).alias(rate)
                for flag, rate in flags.items()
            ],
        )
        .orderBy("campaign_type")
    )


def send_overview(sends: DataFrame) -> DataFrame:
    def rate(flag: str) -> Column:
        return round_as_printed(ratio(F.count_if(flag), F.count(flag)) * 100, 1)

    return sends.agg(
        F.count("*").alias("total_sends"),
        rate("opened").alias("open_rate_pct"),
        rate("replied").alias("reply_rate_pct"),
    )
