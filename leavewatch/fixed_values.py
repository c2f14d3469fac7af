"""Values that results depend on. Change one and the numbers change."""

# ---- Fixed values: labels and names ---------------------------------------

LABEL_PAGE = "Cancellation Confirmation"
UNKNOWN = "Unknown"

PAGES = [
    "NextSong", "Thumbs Up", "Thumbs Down", "Add to Playlist", "Add Friend",
    "Home", "Roll Advert", "Logout", "Downgrade", "Settings", "Help",
    "Upgrade", "About", "Save Settings", "Error", "Submit Upgrade",
    "Submit Downgrade", "Cancel", "Cancellation Confirmation",
    "Register", "Submit Registration", "Login",
]

# Columns that name a person, or give the label away.
IDENTITY_COLUMNS = ["auth", "firstName", "lastName"]

# Categories that are one-hot encoded, in output order.
ENCODED_COLUMNS = ["gender", "level", "method", "userAgent", "page", "status"]

# Categories whose nulls become UNKNOWN.
FILLED_COLUMNS = ["userAgent", "gender"]

# ---- Fixed values: text patterns ------------------------------------------

ARTIST_NOISE = r"[^0-9a-zA-Z]"
AGENT_NOISE = r"[^a-zA-Z]+"
LONE_LETTER = r" [a-z] "
USER_KEY_IN_LINE = r'"userId"\s*:\s*"([^"]*)"'

# ---- Fixed values: session measure -> the label it looks for ---------------

GENDER_FLAGS = {"gender_F": "F", "gender_M": "M", "gender_Unknown": "Unknown"}

STATUS_COUNTS = {"status_200": 200, "status_307": 307, "status_404": 404}

LEVEL_COUNTS = {
    "num_paid_interactions": "paid",
    "num_free_interactions": "free",
}

METHOD_COUNTS = {
    "num_put_interactions": "PUT",
    "num_get_interactions": "GET",
}

PAGE_COUNTS = {
    "num_nextsong_clicks": "NextSong",
    "num_thumbsup_clicks": "Thumbs Up",
    "num_home_visits": "Home",
    "num_addtoplaylist_clicks": "Add to Playlist",
    "num_addfriend_clicks": "Add Friend",
    "num_rolladvert_visits": "Roll Advert",
    "num_logout_visits": "Logout",
    "num_thumbsdown_clicks": "Thumbs Down",
    "num_downgrade_visits": "Downgrade",
    "num_settings_visits": "Settings",
    "num_help_visits": "Help",
    "num_upgrade_visits": "Upgrade",
    "num_about_visits": "About",
    "num_savesettings_clicks": "Save Settings",
    "num_errors": "Error",
    "num_upgrades": "Submit Upgrade",
    "num_downgrades": "Submit Downgrade",
}

# Counted per session but never a user feature: it foretells the label.
CANCEL_COUNTS = {"num_cancel_visits": "Cancel"}

# Pages that only a log with sign-up traffic holds.
SIGNUP_PAGE_COUNTS = {
    "num_register_visits": "Register",
    "num_submitreg_clicks": "Submit Registration",
    "num_login_visits": "Login",
}

# Other names in use for some of the user features.
ALTERNATE_FEATURE_NAMES = {
    "avg_num_rolladvert_visits": "avg_num_roll_advert_visits",
    "avg_num_downgrades": "avg_num_downgrade_clicks",
    "avg_num_upgrades": "avg_num_upgrade_clicks",
    "avg_number_of_songs_per_session": "avg_num_songs_per_session",
}

# ---- Fixed values: numbers -------------------------------------------------

MILLIS_PER_SECOND = 1000
SECONDS_PER_HOUR = 3600

# Two-sided 95 %: 0.975 quantile of the normal, and of Student's t with
# 1 to 9 degrees of freedom.
NORMAL_975 = 1.959963984540054
STUDENT_975 = {
    1: 12.706204736432095,
    2: 4.302652729696142,
    3: 3.182446305284263,
    4: 2.7764451051977987,
    5: 2.5705818366147395,
    6: 2.446911848791681,
    7: 2.3646242510102993,
    8: 2.306004135033371,
    9: 2.2621571627409915,
}

# ---- Fixed values: model search --------------------------------------------

LOGISTIC_DEFAULTS = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}
SMALL_LOGISTIC_GRID = {"elasticNetParam": [0.0], "regParam": [0.01, 0.1]}
LARGE_LOGISTIC_GRID = {
    "elasticNetParam": [0.0, 0.33, 0.66, 1.0],
    "regParam": [0.001, 0.01, 0.1],
}
INVERSE_STRENGTHS = [0.000001, 0.00001, 0.0001, 0.001, 0.01, 0.1, 1, 10, 100]
L1_RATIOS = [0, 0.25, 0.4, 0.5, 0.6, 0.75, 1]
TREE_DEPTHS = [2, 5, 10, 20, 100]
TREE_SPLIT_SIZES = [2, 8, 16, 32]
