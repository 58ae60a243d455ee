"""Domain constants shared by the adapters, the reports and the quality checks."""

# Monthly price of each plan.
PLAN_PRICES = {"starter": 49, "growth": 149, "pro": 399, "enterprise": 999}

# Why a customer may leave.
CHURN_REASONS = [
    "too_expensive",
    "missing_features",
    "switched_competitor",
    "no_longer_needed",
    "poor_onboarding",
    "poor_support",
    "contract_ended",
    "acquisition",
]

# How a customer may have been acquired.
ACQUISITION_CHANNELS = ["organic", "paid_ads", "referral", "sales", "partner"]

# Reported funnel stages, top first.
FUNNEL_STAGES = ["new", "qualified", "demo_booked", "converted"]

# Why a lead may be lost, by the stage it was lost in.
LOSS_REASONS = {
    "new": ["no_response", "wrong_icp", "duplicate"],
    "qualified": ["budget_constraint", "no_response", "wrong_icp", "chose_competitor"],
    "demo_booked": ["no_show", "budget_constraint", "chose_competitor", "not_ready"],
}

# Company size classes.
COMPANY_SIZES = ["1-10", "11-50", "51-200", "201-500", "500+"]

# The audience segment each campaign type addresses.
CAMPAIGN_SEGMENTS = {
    "newsletter": "all_active",
    "promo": "all_active",
    "upsell": "starter_growth",
    "re_engagement": "low_activity",
    "winback": "churned",
}
DEFAULT_SEGMENT = "all_active"

# Plans in the starter_growth segment, and the look-back of low_activity.
UPSELL_PLANS = ["starter", "growth"]
LOW_ACTIVITY_DAYS = 30

# Most recipients one campaign is sent to.
AUDIENCE_CAP = 300

# A churned customer's life ends its normal phase at 60 % of the
# tenure and its declining phase at 85 %.
NORMAL_PHASE_END = 0.60
DECLINE_PHASE_END = 0.85
