"""Fixed values the reports depend on.

Everything in this module is a literal that must equal the value used by the
original report scripts for results to match (labels, code lists, rule bounds,
file names).  They are stated once, in their natural order, and the rule
builders in :mod:`shopscope.functions` read them from here.
"""

from __future__ import annotations

from datetime import datetime

# ---------------------------------------------------------------------------
# Run time used for the test fixtures (10:46 daily schedule).
# ---------------------------------------------------------------------------
FIXTURE_AS_OF = datetime(2001, 6, 30, 10, 46)

# ---------------------------------------------------------------------------
# Age classification.
# Each rule is (comparison, bound, label), tried in order after the
# "birth date missing" test; the last entry of each list is the fall-through.
# ---------------------------------------------------------------------------
MISSING = "Missing"

AGE_BAND_SCV = [
    ("<", 15, "<=15"),
    ("<", 20, "16-18"),
    ("<", 25, "19-21"),
    ("<", 30, "22-24"),
    ("<", 35, "25-29"),
    ("<", 40, "30-34"),
    ("<", 45, "35-44"),
    ("<", 50, "45-60"),
    (">", 59, "60+"),
]
AGE_BAND_SCV_ELSE = "xx"

AGE_BAND_PERKS = [
    ("<", 15, "<=15"),
    ("<=", 20, "16-20"),
    ("<=", 25, "21-25"),
    ("<=", 30, "26-30"),
    ("<=", 35, "31-35"),
    ("<=", 40, "36-40"),
    ("<=", 45, "41-45"),
    ("<=", 50, "46-50"),
    (">", 51, "51+"),
]
AGE_BAND_PERKS_ELSE = "xx"

AGE_SEGMENT = [
    (">", 80, "Missing"),
    ("<", 10, "Missing"),
    ("<", 19, "Young Reach (<19)"),
    ("<", 25, "Edit (19-24)"),
    ("<", 40, "Older Reach (25-39)"),
    (">=", 40, "Older Reach (40+)"),
]
AGE_SEGMENT_ELSE = "Missing"

# Age used by the customer view when the birth date is unknown.
UNKNOWN_AGE = 9999

# ---------------------------------------------------------------------------
# Loyalty / customer attributes.
# ---------------------------------------------------------------------------
ACTIVE_STATUS = "A"
KEPT_INSERT_USERS = ("WEB", "RD Script")
OTHER_INSERT_USER = "OTHER"
INSTORE_STORE_TYPE = "INSTORE"
GENDER_MALE = ("m", "M")
GENDER_FEMALE = ("f", "F")

# ---------------------------------------------------------------------------
# Item hierarchy labels used by the segment rules.
# ---------------------------------------------------------------------------
DIV_COTTONON = "1 - COTTONON"
DIV_KIDS = "2 - KIDS"
DIV_BODY = "3 - BODY"
DIV_RUBI = "4 - RUBI"
DIV_FACTORIE = "5 - FACTORIE"
DIV_SUPRE = "10 - SUPRE"
DIV_COMMUNITY = "11 - COMMUNITY"
DIV_LOST = "12 - LOST (DNU)"
DIV_SUNNY_BUDDY = "13 - SUNNY BUDDY (DNU)"

DEPT_LADIESWEAR = "12 - LADIESWEAR"
DEPT_BABY = "21 - BABY"
CAT_CURVE = "165 - CURVE"

MENS_DIVISIONS = (DIV_COTTONON, DIV_FACTORIE)
MENS_DEPARTMENT_WORDS = ("BOY", "MENS", "GUY")
KIDS_DIVISIONS = (DIV_KIDS, DIV_SUNNY_BUDDY)
COBRAND_DIVISIONS = (DIV_COTTONON, DIV_BODY, DIV_RUBI, DIV_LOST)
PETITE_BODY_EXCLUDED_CATEGORIES = ("300 - SOLUTIONS", "399 - BODY OTHER")
PETITE_SIZES = ("XXS", "XS", "6", "8")
SPORTS_AFL_TEXT = "AFL "
SPORTS_NRL_TEXT = "NRL "

# Plus-size bottoms lookup.
PLUS_BOTTOMS_DIVISIONS = ("1 - COTTONON", "3 - BODY")
PLUS_BOTTOMS_DEPARTMENTS = (
    "12 - LADIESWEAR",
    "31 - BODY SLEEPWEAR",
    "32 - BODY INTIMATES",
    "33 - BODY - ACTIVE",
)
BOTTOMS_WORDS = ("bottoms", "skirts", "pants", "denim", "shorts")
BOTTOMS_LABEL = "bottoms"
PLUS_SIZE_PATTERN = "%L%"
PLUS_SIZES = ("14", "16")

# ---------------------------------------------------------------------------
# Rolling windows (days back from the run time).
# ---------------------------------------------------------------------------
SCV_STORE_DAYS = 365
SCV_ONLINE_DAYS = 1
KIDS_DAYS = 365
PROFILE_FIRST_DAY_BACK = 10
PROFILE_LAST_DAY_BACK = 1

# ---------------------------------------------------------------------------
# E-mail campaign matching (upper-cased name, literal substring).
# ---------------------------------------------------------------------------
CAMPAIGN_AFL_NRL = "_AFLNRL"
CAMPAIGN_AFL = "_AFL"
CAMPAIGN_NRL = "_NRL"

# ---------------------------------------------------------------------------
# Segment labels.
# ---------------------------------------------------------------------------
PURE = "Pure"
MULTI = "Multi"
SPORTS_LABELS = [
    "AFL",
    "NRL",
    "Multi",
    "Multi_em_c",
    "AFL_em_c",
    "NRL_em_c",
    "Multi_em_o",
    "AFL_em_o",
    "NRL_em_o",
]
LIFESTAGE_PARENT = "PARENT"
LIFESTAGE_EDIT = "EDIT"
LIFESTAGE_GENERIC = "GENERIC"

# ---------------------------------------------------------------------------
# Age profiling.
# ---------------------------------------------------------------------------
PROFILE_CURRENCIES = ("AUD", "HKD", "MLR", "NZD", "SGD", "USD", "ZAR")
CHANNEL_STORE = "Store"
CHANNEL_ONLINE = "Online"

# ---------------------------------------------------------------------------
# Segment extracts.  (file base, customer-view column,
# destination folder); the SUPRE extract also carries the e-mail address.
# ---------------------------------------------------------------------------
SEGMENT_ROUTING = [
    ("cat_curve", "Transacted_Cat_Curve", "Transacted_Cat_Curve"),
    ("cat_menswear", "Transacted_Cat_Menswear", "Transacted_Cat_Menswear"),
    ("cat_sports", "Transacted_Cat_Sports", "Transacted_Cat_Sports"),
    ("cat_kids", "Transacted_KIDS_flag", "Transacted_kids"),
    ("cat_cobrands", "Transacted_Cat_CoBrands", "Transacted_CoBrands"),
    ("cat_lifestage", "LIFESTAGE", "Lifestage"),
    ("cat_baby", "Transacted_BABY", "Transacted_BABY"),
    ("cat_supre", "Transacted_Cat_SUPRE", "Transacted_Cat_SUPRE"),
    ("cat_curve_bottom", "Transacted_Cat_Curve_Bottoms", "Transacted_Cat_Curve_Bottoms"),
    ("cat_petite", "Transacted_Cat_Petite", "Transacted_Cat_Petite"),
]
SUPRE_SEGMENT = "cat_supre"
EXPORT_DATE_FORMAT = "%d-%m-%Y"
AGE_PROFILE_FILE = "ageProfiling"
AGE_PROFILE_ITEM_FILE = "ageProfilingItem"
AGE_PROFILE_ITEM_FOLDER = "ageProfileItem"

# ---------------------------------------------------------------------------
# Mobile app report.
# ---------------------------------------------------------------------------
EVENT_APP_OPEN = "appOpen"
EVENT_PURCHASE = "ecommerce_purchase"
EVENT_SESSION_START = "session_start"
EVENT_FIRST_OPEN = "first_open"
NAMED_COUNTRIES = ("Australia", "New Zealand", "United States")
OTHER_COUNTRY = "Other"
PUSH_PARAM_VALUE = "Push"
SESSION_PROPERTY_KEY = "ga_session_id"
EVENT_DATE_FORMAT = "yyyyMMdd"
