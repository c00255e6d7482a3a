"""Controlled vocabularies. All are fixed values that results depend on."""

CATEGORIES = ["archaeological", "historic", "culture"]
CUTOFF_YEAR = 1700

# Site types by category; the type "unknown" has none.
SITE_TYPES = {
    "archaeological": "tel khirbe settlement_remains burial necropolis water_installation agricultural_installation quarry road_milestone fortification cult_ancient synagogue_ancient church_ancient mosaic cave prehistoric".split(),
    "historic": "ottoman_building khan mill railway templer founders_building settlement_heritage defense_heritage memorial place_of_worship cemetery industrial_heritage water_heritage".split(),
    "culture": "museum visitor_center heritage_center archive library community_culture_center hall amphitheater gallery art_school conservatory studio_collective cinema festival_venue other_culture".split(),
}

# Periods from oldest to newest with their first year and the year after the last.
PERIODS = {
    "paleolithic": (-1_000_000, -10000),
    "neolithic": (-10000, -4500),
    "chalcolithic": (-4500, -3600),
    "bronze_early": (-3600, -2000),
    "bronze_middle": (-2000, -1550),
    "bronze_late": (-1550, -1200),
    "iron": (-1200, -586),
    "persian": (-586, -332),
    "hellenistic": (-332, -37),
    "roman": (-37, 324),
    "byzantine": (324, 638),
    "early_islamic": (638, 1099),
    "crusader": (1099, 1291),
    "mamluk": (1291, 1516),
    "ottoman_early": (1516, 1700),
    "ottoman_late": (1700, 1918),
    "mandate": (1918, 1948),
    "state": (1948, 2100),
}

_A, _H, _C = CATEGORIES

# Status axes, each with its values (besides "unknown") and the categories it applies to.
AXES = {
    "reg_antiquity": ("declared known none", [_A, _H]),
    "reg_conservation": ("listed plan_approved restored surveyed none", [_A, _H, _C]),
    "reg_institution": ("recognized_museum public_library none", [_C]),
    "protected_area": ("national_park nature_reserve forest none", [_A, _H, _C]),
    "excavation": ("excavated surveyed_only not_excavated", [_A, _H]),
    "accessibility": ("open_free open_paid by_appointment restricted not_accessible", [_A, _H, _C]),
    "a11y_disabled": ("accessible partial not_accessible", [_A, _H, _C]),
    "condition": ("good fair poor endangered destroyed", [_A, _H]),
    "activity": ("active seasonal inactive", [_A, _H, _C]),
    "signage": ("blue_sign other_sign none", [_A, _H, _C]),
    "visitor_dev": ("developed partial undeveloped", [_A, _H]),
    "ownership": ("state council settlement ngo private religious", [_A, _H, _C]),
}
AXES = {k: ([*v.split(), "unknown"], on) for k, (v, on) in AXES.items()}

# Tones of status values; values without one are neutral, unknown ones a gap.
TONES = {
    "reg_antiquity": {"declared": "good", "known": "warn", "none": "bad"},
    "reg_conservation": {"listed": "good", "plan_approved": "good", "restored": "good", "surveyed": "warn", "none": "bad"},
    "reg_institution": {"recognized_museum": "good", "public_library": "good", "none": "bad"},
    "protected_area": {"national_park": "good", "nature_reserve": "good", "forest": "warn", "none": "bad"},
    "excavation": {"excavated": "good", "surveyed_only": "warn", "not_excavated": "bad"},
    "accessibility": {"open_free": "good", "open_paid": "good", "by_appointment": "warn", "restricted": "warn", "not_accessible": "bad"},
    "a11y_disabled": {"accessible": "good", "partial": "warn", "not_accessible": "bad"},
    "condition": {"good": "good", "fair": "warn", "poor": "bad", "endangered": "bad", "destroyed": "bad"},
    "activity": {"active": "good", "seasonal": "warn", "inactive": "bad"},
    "signage": {"blue_sign": "good", "other_sign": "warn", "none": "bad"},
    "visitor_dev": {"developed": "good", "partial": "warn", "undeveloped": "bad"},
}

# What counts as registered.
REGISTERED = {
    "reg_antiquity": ["declared"],
    "reg_conservation": ["listed", "plan_approved", "restored"],
    "reg_institution": ["recognized_museum", "public_library"],
    "protected_area": ["national_park", "nature_reserve"],
}

# Rank of each source, 1 the strongest.
SOURCE_RANK = {
    "declared_antiquities": 1, "boundary": 1, "iaa_cluster_table": 2, "iaa_discover": 2, "heritage_official": 3, "blue_signs": 3,
    "culture_institutions": 3, "iicp_culture_table": 4, "manual_curated": 4, "osm_wikidata": 5, "amudanan": 6,
}

# Sources of a field in order; others follow by rank.
PRECEDENCE = {
    "geometry.archaeological": ["iaa_cluster_table", "declared_antiquities", "iaa_discover", "heritage_official", "osm_wikidata", "amudanan", "iicp_culture_table"],
    "geometry.historic": ["heritage_official", "blue_signs", "osm_wikidata", "iaa_cluster_table", "amudanan", "iicp_culture_table"],
    "geometry.culture": ["culture_institutions", "iicp_culture_table", "osm_wikidata", "heritage_official"],
    "name.archaeological": ["iaa_cluster_table", "declared_antiquities", "iaa_discover", "osm_wikidata"],
    "name.historic": ["blue_signs", "heritage_official", "osm_wikidata"],
    "name.culture": ["culture_institutions", "iicp_culture_table", "osm_wikidata"],
    "periods": ["iaa_cluster_table", "iaa_discover", "osm_wikidata", "heritage_official", "amudanan"],
    "reg_antiquity": ["declared_antiquities", "iaa_cluster_table", "iaa_discover"],
    "reg_conservation": ["heritage_official", "blue_signs"],
    "reg_institution": ["culture_institutions"],
    "protected_area": ["heritage_official", "osm_wikidata"],
    "excavation": ["iaa_discover", "iaa_cluster_table"],
    "signage": ["blue_signs", "heritage_official"],
    "activity": ["culture_institutions", "iicp_culture_table"],
    "accessibility": ["heritage_official", "culture_institutions", "amudanan", "osm_wikidata"],
}

# Axes that only these sources may state.
AUTHORITY_ONLY = {
    "reg_antiquity": ["declared_antiquities", "iaa_cluster_table", "iaa_discover"],
    "reg_institution": ["culture_institutions"],
    "signage": ["blue_signs", "heritage_official", "iicp_culture_table"],
}

# Name words, with final letters folded. Heads say what kind of place it is; stop words leave the key.
GENERIC_HEADS = "בית כפר תל חורבת חאנ עינ באר שיח דיר נבי רוגומ גבעת רמת נחל הר מצפה אבנ מגדל קרית קריית עמק חצר מעונ משמר עני אומ תחנת".split()
STOP_WORDS = "אתר אתרי עתיקות שרידי של ה את מתקן מבנה מבני אזור גן לאומי שמורת טבע".split()
INSTITUTION_WORDS = (
    "העמ עמ ספריה ספרייה מוזיאונ ארכיונ מרכז תרבות קהילתי מגדל מימ בארות מקווה צרכניה מכולת מרפאה גנ ילדימ קברות עלמינ כנסת מסגד כנסיה אנדרטה אנדרטת מצפור "
    "אולמ מופעימ היכל גלריה סטודיו בריכה מתנס ישנ ישנה הראשונימ ראשונימ מבקרימ אמנות אומנות"
).split()

# First words that are spellings of one word.
PREFIXES = [
    ("חירבת|חרבת|כירבת|כרבת|חורבת|חורבה|חרבה|חר|ח", "חורבת"),
    ("תל|טל", "תל"),
    ("ח'?אן|כאן", "חאן"),
    ("עיון|עין|איין|עיין|ען", "עין"),
    ("ביר|באר|בר", "באר"),
    ("רוג'ום|רוגום|רג'ום", "רוגום"),
    ("שיח|שייח|שח", "שיח"),
    ("דיר|דייר", "דיר"),
    ("נבי|נביא", "נבי"),
]

# Characters that the keys drop or fold: points, quotation marks, dashes, brackets; articles before a dash or a space; letters that the loose key folds (the rest of the first
# string it drops), and final letters.
POINTS = "[\u0591-\u05bd\u05bf\u05c1\u05c2\u05c4\u05c5\u05c7]"
QUOTES = "[\u05f3\u05f4'\"`\u2018\u2019\u201c\u201d]"
DASHES = "[\u05be\u2010-\u2015\\-]"
BRACKETS = "[()\\[\\]{}]"
ARTICLE = "(?:(?<=\\s)|^)(?:אל|א[טסשדזרנתלצכ])" + DASHES + "(?=\\S)"
ARTICLE_WORD = "(?:(?<=\\s)|^)אל(?=\\s)"
FOLDED_LETTERS = ("טקשאעה", "תכס")
FINAL_LETTERS = ("ךםןףץ", "כמנפצ")

# Gates in metres by the two categories, and the default.
GATES = {(_C, _C): 200.0, (_A, _A): 400.0, (_H, _H): 300.0, (_A, _H): 350.0, (_A, _C): 250.0, (_H, _C): 250.0}
GATE = 300.0
