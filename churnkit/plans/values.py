"""Fixed values of the telecom data model.

Field names, types and order, thresholds, labels and point values below are given by the data and
the business rules. They are stated as they are and must not be changed.
"""

from __future__ import annotations

# Fields of the two batch files, in file order.
CLIENT_FIELDS = """
uniqsubs int, actvsubs int, new_cell string, crclscod string, asl_flag string, totcalls int,
totmou double, totrev double, adjrev double, adjmou double, adjqty int, avgrev double,
avgmou double, avgqty double, avg3mou int, avg3qty int, avg3rev int, avg6mou double,
avg6qty double, avg6rev double, prizm_social_one string, area string, dualband string,
refurb_new string, hnd_price double, phones double, models double, hnd_webcap string,
truck double, rv double, ownrent string, lor double, dwlltype string, marital string,
adults double, infobase string, income double, numbcars double, HHstatin string,
dwllsize string, forgntvl double, ethnic string, kid0_2 string, kid3_5 string,
kid6_10 string, kid11_15 string, kid16_17 string, creditcd string, eqpdays double,
Customer_ID int
"""
RECORD_FIELDS = """
rev_Mean double, mou_Mean double, totmrc_Mean double, da_Mean double, ovrmou_Mean double,
ovrrev_Mean double, vceovr_Mean double, datovr_Mean double, roam_Mean double, change_mou double,
change_rev double, drop_vce_Mean double, drop_dat_Mean double, blck_vce_Mean double,
blck_dat_Mean double, unan_vce_Mean double, unan_dat_Mean double, plcd_vce_Mean double,
plcd_dat_Mean double, recv_vce_Mean double, recv_sms_Mean double, comp_vce_Mean double,
comp_dat_Mean double, custcare_Mean double, ccrndmou_Mean double, cc_mou_Mean double,
inonemin_Mean double, threeway_Mean double, mou_cvce_Mean double, mou_cdat_Mean double,
mou_rvce_Mean double, owylis_vce_Mean double, mouowylisv_Mean double, iwylis_vce_Mean double,
mouiwylisv_Mean double, peak_vce_Mean double, peak_dat_Mean double, mou_peav_Mean double,
mou_pead_Mean double, opk_vce_Mean double, opk_dat_Mean double, mou_opkv_Mean double,
mou_opkd_Mean double, drop_blk_Mean double, attempt_Mean double, complete_Mean double,
callfwdv_Mean double, callwait_Mean double, churn int, months int, Customer_ID int
"""
CUSTOMER = "Customer_ID"
LABEL = "churn"

# Columns the silver table keeps, in its order (run columns follow).
KEPT_COLUMNS = """
Customer_ID churn months rev_Mean mou_Mean totmrc_Mean ovrmou_Mean ovrrev_Mean datovr_Mean
roam_Mean change_mou change_rev drop_vce_Mean drop_dat_Mean blck_vce_Mean blck_dat_Mean
unan_dat_Mean plcd_vce_Mean plcd_dat_Mean comp_vce_Mean custcare_Mean cc_mou_Mean inonemin_Mean
mou_cvce_Mean mou_cdat_Mean drop_blk_Mean attempt_Mean uniqsubs actvsubs crclscod asl_flag totrev
adjrev adjmou adjqty avgrev prizm_social_one area refurb_new marital adults income eqpdays
""".split()
RUN_VERSION = "1.0.0-local"
RUN_SOURCE = "GCS_CSV"
RUN_ZONE = "Africa/Cairo"

# Event topics: JSON fields and topic names.
CALL_FIELDS = """
customer_id string, anger_rate int, issue_type string, call_duration_sec int, resolved string,
event_time string
"""
NETWORK_FIELDS = """
customer_id string, signal_strength int, dropped_calls int, internet_speed int, outage_flag int,
event_time string
"""
USAGE_FIELDS = """
customer_id string, voice_minutes int, data_usage_mb int, sms_count int, package_usage_pct int,
event_time string
"""
CALLS_TOPIC = "customer_care_calls"
NETWORK_TOPIC = "network_events"
USAGE_TOPIC = "usage_events"
TOPIC_FIELDS = {
    CALLS_TOPIC: CALL_FIELDS,
    NETWORK_TOPIC: NETWORK_FIELDS,
    USAGE_TOPIC: USAGE_FIELDS,
}
WATERMARK = "10 minutes"
ROWS_PER_TRIGGER = 50_000
TRIGGER = "30 seconds"

# Social posts, the second example of a topic.
POST_FIELDS = """
post_id string, timestamp string, day_of_week string, platform string, user_id string,
location string, language string, text_content string, hashtags string, mentions string,
keywords string, topic_category string, sentiment_score double, sentiment_label string,
emotion_type string, toxicity_score double, likes_count int, shares_count int,
comments_count int, impressions int, engagement_rate double, brand_name string,
product_name string, campaign_name string, campaign_phase string,
user_past_sentiment_avg double, user_engagement_growth double, buzz_change_rate double
"""
POST_KEY = "post_id"

# Imputation and caps.
CONSTANT_FILL = {"income": -1, "adults": 0, "prizm_social_one": "Unknown"}
NO_TEXT = "Unknown"
SIGNED_MARK = "change"
VALUE_COLUMN = "avgrev"
VALUE_SEGMENT = "clv_segment"
OUTLIER_RATIO = 0.01
QUANTILE_ERROR = 0.01
CAP_ERROR = 0.001

# Value maps and prefix classes.
ASL_LABELS = {"Y": "Yes", "N": "No"}
REFURB_LABELS = {"N": "New", "R": "Refurbished"}
SOCIAL_LABELS = {"U": "Urban", "S": "Suburban", "T": "Town", "R": "Rural", "C": "City"}
SOCIAL_OTHER = "Unknown"
CREDIT_CLASSES = {p: f"Class {p}" for p in "ABCDEZ"}
CREDIT_OTHER = "Class Other"

# Tiers: the first comparison that holds gives the label; the last entry is for all the rest.
OVERAGE_STEPS = [("<=", 0.01, "No Overage"), ("<=", 0.10, "Light Overage"), ("<=", 0.30, "Medium Overage")]
OVERAGE_REST = "Heavy Overage"
REVENUE_CHANGE_STEPS = [
    ("<=", -20, "Significant Drop"),
    ("<", -5, "Slight Drop"),
    ("<=", 5, "Stable"),
    ("<=", 20, "Slight Increase"),
]
REVENUE_CHANGE_REST = "Significant Increase"
LOYALTY_STEPS = [("<=", 6, "newcomer"), ("<=", 12, "mid_term"), ("<=", 24, "loyal")]
LOYALTY_REST = "veteran"
HOUSEHOLD_STEPS = [("==", 0, "Unknown"), ("==", 1, "Single"), ("<", 4, "Small Family")]
HOUSEHOLD_REST = "Big Family"
DEVICE_AGE_STEPS = [("<=", 365, "New"), ("<=", 730, "Mid-Age")]
DEVICE_AGE_REST = "Old"
QUALITY_STEPS = [("<=", 0.02, "Excellent"), ("<=", 0.05, "Good"), ("<=", 0.07, "Poor")]
QUALITY_REST = "Very Poor"
NO_DATA_LABEL = "No Data Usage"

# Churn score: column, comparison, bound, points; then the risk tiers.
SCORE_RULES = [
    ("anger_rate", ">", 7, 30),
    ("resolved", "==", "No", 20),
    ("dropped_calls", ">", 2, 20),
    ("outage_flag", "==", 1, 15),
    ("package_usage_pct", "<", 20, 15),
]
RISK_STEPS = [(">=", 60, "High"), (">=", 30, "Medium")]
RISK_REST = "Low"

# Warehouse column lists.
CUSTOMER_ATTRIBUTES = """
customer_id income marital adults area prizm_social_one prizm_social_mapped household_segment
""".split()
LOYALTY_ATTRIBUTES = "customer_loyalty clv_segment crclscod crclscod_bin asl_flag".split()
DEVICE_ATTRIBUTES = "refurb_new device_age eqpdays".split()
SNAPSHOT_MEASURES = """
churn rev_mean totrev adjrev avgrev change_rev totmrc_mean refunds mou_mean adjmou adjqty
change_mou mou_cvce_mean mou_cdat_mean inonemin_mean ovrmou_mean ovrrev_mean datovr_mean
overage_flag overage_rate overage_status is_roamer roam_mean custcare_mean cc_mou_mean
drop_vce_mean drop_dat_mean blck_vce_mean blck_dat_mean unan_dat_mean drop_blk_mean attempt_mean
completed_call_rate blocked_call_rate drop_block_call_rate network_quality data_failure_rate
data_experience
""".split()
CALL_MEASURES = "issue_type anger_rate call_duration_sec resolved".split()
USAGE_MEASURES = "voice_minutes data_usage_mb sms_count package_usage_pct".split()
NETWORK_MEASURES = "signal_strength dropped_calls internet_speed outage_flag".split()
RISK_MEASURES = "risk_level churn_score".split()
USAGE_MEANS = {
    "avg_data_usage_mb": "data_usage_mb",
    "avg_signal_strength": "signal_strength",
    "avg_internet_speed": "internet_speed",
    "avg_package_usage_pct": "package_usage_pct",
}
OVERVIEW_SNAPSHOT = """
totrev avgrev rev_mean change_rev totmrc_mean churn network_quality data_experience is_roamer
overage_flag overage_status
""".split()
OVERVIEW_CUSTOMER = "area household_segment prizm_social_mapped".split()
OVERVIEW_LOYALTY = "customer_loyalty clv_segment crclscod_bin".split()
OVERVIEW_DEVICE = "device_age refurb_new".split()
QUALITY_CUSTOMER = ["area"]
QUALITY_LOYALTY = "customer_loyalty clv_segment".split()
QUALITY_SNAPSHOT = """
network_quality data_experience is_roamer data_failure_rate completed_call_rate blocked_call_rate
drop_block_call_rate drop_vce_mean drop_dat_mean blck_vce_mean blck_dat_mean attempt_mean
custcare_mean
""".split()
