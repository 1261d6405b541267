"""Fixed values that results depend on."""

from datetime import date

# Event names and their short forms
TRANSACTION = "transaction"
RECEIVED = "offer received"
VIEWED = "offer viewed"
COMPLETED = "offer completed"
EVENTS = [TRANSACTION, RECEIVED, VIEWED, COMPLETED]
OFFER_EVENTS = [RECEIVED, VIEWED, COMPLETED]

# Offer types and channels
OFFER_TYPES = ["bogo", "discount", "informational"]
CHANNELS = ["email", "mobile", "social", "web"]
GENDERS = ["M", "F", "O", "Unknown"]

# Required columns
PORTFOLIO_COLUMNS = ["id", "offer_type", "difficulty", "reward", "duration", "channels"]
PROFILE_COLUMNS = ["age", "became_member_on", "gender", "id", "income"]
TRANSCRIPT_COLUMNS = ["event", "person", "time", "value"]

# Missing-age marker, as-of date, days per month
AGE_SENTINEL = 118
AS_OF = date(2018, 7, 26)
DAYS_PER_MONTH = 30.44

# Bins are (low, high], anything outside is null
AGE_BINS = ([0, 25, 35, 45, 55, 65, 100], ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"])
INCOME_BINS = ([0, 40000, 60000, 80000, 100000, 200000], ["<40K", "40-60K", "60-80K", "80-100K", "100K+"])
TENURE_BINS = ([0, 6, 12, 24, 60, 1000], ["0-6M", "6-12M", "1-2Y", "2-5Y", "5Y+"])
CHART_INCOME_BINS = ([0, 30000, 50000, 75000, 100000, 200000], ["<30K", "30-50K", "50-75K", "75-100K", "100K+"])
CHART_AGE_BINS = ([0, 25, 35, 50, 65, 120], ["18-25", "26-35", "36-50", "51-65", "65+"])
ENGAGEMENT_BINS = ([-0.001, 0.3, 0.6, 1.0], ["Low", "Medium", "High"])
ENGAGEMENT_BINS_OPEN_ZERO = ([0, 0.3, 0.6, 1.0], ["Low", "Medium", "High"])

# Segment labels by cluster number
CLUSTER_LABELS = {
    0: "Unknown Demographics",
    1: "Discount Responders",
    2: "BOGO Responders",
    3: "Low Engagement",
}

# Columns used for segmentation
CLUSTERING_COLUMNS = [
    "age_imputed", "income_imputed", "tenure_months", "age_missing", "income_missing",
    "gender_M", "gender_F", "gender_O", "gender_Unknown",
    "trans_count", "trans_total", "trans_avg", "trans_std",
    "offers_received", "offers_viewed", "offers_completed",
    "view_rate", "completion_rate", "view_to_completion_rate",
    "bogo_received", "bogo_viewed", "bogo_completed", "bogo_view_rate", "bogo_completion_rate",
    "discount_received", "discount_viewed", "discount_completed", "discount_view_rate", "discount_completion_rate",
    "info_received", "info_viewed", "info_view_rate",
]

# Metrics of a segment profile
PROFILE_METRICS = [
    "age_imputed", "income_imputed", "tenure_months", "trans_count", "trans_avg", "trans_total",
    "offers_received", "offers_viewed", "offers_completed", "view_rate", "completion_rate",
    "bogo_completion_rate", "discount_completion_rate",
]

# Segment type -> display name
SEGMENT_NAMES = {
    "high_value_loyalist": "High-Value Loyalists",
    "discount_seeker": "Discount Seekers",
    "bogo_responder": "BOGO Responders",
    "low_engagement": "Low-Engagement Customers",
    "moderate_spender": "Moderate Spenders",
    "tenured_conservative": "Tenured Conservatives",
    "high_income_casual": "High-Income Casuals",
}
