"""Default word lists and lookup values.

Everything in this module is a FIXED VALUE: results only agree with the data
this library has to reproduce when these words, codes and patterns are exactly
these. Every operator that uses one of them takes it as a parameter, so a
caller can supply their own.
"""

# --------------------------------------------------------------------------
# Hazard classification
# --------------------------------------------------------------------------
HAZARD_KEYWORDS = {
    "rainfall / flood": [
        "rain", "rains", "rainfall", "rainshower", "rain showers", "heavy rain",
        "downpour", "monsoon", "habagat", "amihan", "lpa", "itcz",
        "weather system", "weather update", "weather advisory", "weather alert",
        "rainfall warning", "orange rainfall", "yellow rainfall", "red rainfall",
        "orange warning", "yellow warning", "red warning",
        "rainfall alert", "rainfall advisory", "rainfall watch",
        "thunderstorm", "thunderstorms", "thunderstorm watch", "thunderstorm advisory",
        "thunderstorm warning", "thunderstorm information",
        "kulog", "kidlat", "lightning", "storm surge", "coastal surge", "daluyong",
        "gusty", "baha", "lunop", "pagbaha", "paglunop", "flood", "flooding",
        "overflow", "pag-apaw", "apaw", "pagapaw", "inundation",
    ],
    "landslide": ["landslide", "pagguho", "mudslide", "nahulog", "slope", "erosion"],
    "earthquake": ["lindol", "linog", "pagyanig", "nangurog", "magnitude", "aftershock", "epicenter"],
    "tsunami": ["tsunami", "daluyong", "tidal wave", "sea surge"],
    "fire": ["sunog", "nasunog", "apoy", "fire", "blaze", "wildfire", "sumiklab"],
    "volcanic eruption": [
        "volcano", "volcanic", "eruption", "ashfall", "ash cloud", "ash plume",
        "lava", "lahar", "crater", "pyroclastic", "phreatic", "phreatomagmatic",
        "sulfur dioxide", "so2", "mayon", "taal", "pinatubo", "kanlaon", "bulusan",
        "hibok-hibok", "hibok hibok", "banahaw", "banahao", "ragang", "didicas",
        "babuyan claro", "smith volcano", "camiguin", "apo", "matutum", "bulkan", "bulkang",
    ],
    "typhoon": ["typhoon", "bagyo", "bagyong", "unos", "tropical", "cyclone", "storm", "landfall"],
}

# a keyword also counts with one of these endings
KEYWORD_SUFFIXES = ("s", "es", "ing", "ed")

# earlier wins when scores and hit counts tie
HAZARD_PRIORITY = [
    "tsunami", "volcanic eruption", "earthquake", "landslide",
    "typhoon", "rainfall / flood", "fire", "other",
]

# candidate labels handed to a scoring model
HAZARD_LABELS = [
    "other (not a natural disaster or emergency, unrelated to calamities)",
    "rainfall / flood (rainfall, heavy rain, monsoon, thunderstorm, baha, flood, lunop, overflow, storm surge)",
    "landslide (pagguho ng lupa, soil collapse, mudslide)",
    "earthquake (lindol, shaking, seismic activity)",
    "tsunami (sea wave after earthquake)",
    "fire (sunog, blaze, wildfire, burning)",
    "volcanic eruption (eruption, bulkan, ashfall, lava flow)",
    "typhoon (bagyo, tropical storm, cyclone, landfall)",
]

# --------------------------------------------------------------------------
# Capture filter
# --------------------------------------------------------------------------
CAPTURE_KEYWORDS = [
    # typhoon, storm
    "typhoon", "storm", "storm surge",
    "tropical storm", "tropical depression",
    "super typhoon", "tropical cyclone",
    "bagyo", "unos", "thunderstorm", "lightning",
    "malakas na bagyo", "malakas na hangin",
    "#typhoon", "#storm",
    # rain, weather
    "rain", "raining", "rainfall",
    "heavy rain", "heavy rainshowers", "monsoon",
    "LPA", "low pressure area",
    "malakas na ulan",
    # flood
    "flood", "flooding", "flash flood", "river overflow",
    "street flood", "baha", "lunop",
    "pagbaha", "paglunop", "flood alert",
    "#flood", "#FloodAlert", "#BahaPH", "#StreetFloodAlert",
    # landslide
    "landslide", "mudslide", "soil erosion", "slope failure",
    "pagguho ng lupa", "nangurog",
    "#landslide", "#LandslideAlert", "#LandslidePH",
    # earthquake
    "earthquake", "aftershock", "ground shaking", "seismic",
    "lindol", "linog", "pagyanig",
    "#EarthquakeAlert", "#EarthquakePH",
    # tsunami
    "tsunami", "tidal wave", "sea surge", "coastal surge",
    "daluyong",
    "#tsunami",
    # fire
    "fire", "blaze", "burning", "wildfire",
    "sunog", "nasunog", "apoy",
    "#FireAlert",
    # volcano
    "volcano", "volcanic", "eruption", "ashfall", "lava",
    "bulkan", "pagputok ng bulkan",
    "#volcano", "Taal", "Mayon", "Pinatubo", "Kanlaon", "Balusan",
    # general
    "disaster", "emergency", "rescue", "relief",
    "evacuate", "evacuation", "evacuated", "#evacuation",
    "disaster response", "disaster relief",
    # warnings
    "warning", "alert", "advisory", "bulletin",
    "babala", "abiso",
    "#warning", "#alert",
    # Tagalog, Cebuano
    "pag-uga", "pagbaha", "paglikas", "malakas na ulan",
    "mainit na bato", "kalamidad", "sakuna",
    "pahimangno", "pasidaan",
    # Bisaya
    "nahulog ang yuta", "nabahaan",
    "kusog nga ulan", "ting-ulan",
    "tabang",
]

# a caption is cut before the first line that matches one of these
COMMENT_PATTERNS = [
    r"(stay safe|ingat|commented|replied|shared|🙏|po$|tagged)",
    r"^see more comments",
    r"^view more replies",
]

MAX_TEXT_CHARS = 5000
MIN_CAPTION_WORDS = 3
FB_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
X_TIME_FORMAT = "yyyy-MM-dd HH:mm"
LOCAL_OFFSET_HOURS = 8

# names always counted as a place mention, besides the gazetteer's
EXTRA_PLACE_NAMES = ["philippines", "pilipinas", "ph"]

# --------------------------------------------------------------------------
# Page sources
# --------------------------------------------------------------------------
SOURCE_HOSTS = ("facebook.com", "x.com")

SOURCE_NAMES = {
    "abscbnnews": "ABS-CBN",
    "atenews": "Atenews",
    "bfprhq11": "BFPRHQ11",
    "civildefensedavao": "Civil Defense Davao",
    "davaocitydrmmc": "Davao City DRRMC",
    "davaodrrmo": "Davao DRRMO",
    "davaocitydisasterradio": "Davao City Disaster Radio",
    "dzmmteleradyo.mspc": "DZMM Teleradyo MSPC",
    "gmanews": "GMA News",
    "inquirerdotnet": "Inquirer.net",
    "manilabulletin": "Manila Bulletin",
    "mprsdcdo": "MPRSD CDO",
    "mindanews": "Mindanews",
    "mrpsd.com.ph": "MRPSD",
    "ndrrmc": "NDRRMC",
    "pagasa.dost.gov.ph": "PAGASA",
    "philstarnews": "Philstar News",
    "phivolcs": "PHIVOLCS",
    "piagovernment": "PIA Government",
    "rapplerdotcom": "Rappler",
    "sunstardavaonews": "SunStar Davao",
    "sunstarphilippines": "SunStar Philippines",
    "stormchasersph": "Storm Chasers PH",
    "untvnewsrescue": "UNTV News Rescue",
    "weather.davao": "Weather Davao",
}

TRUSTED_SOURCES = [
    "pagasa", "pagasa.dost.gov.ph", "dost.pagasa", "phivolcs", "ndrrmc",
    "piagovernment",
    "abs-cbn", "gma news", "philstar news", "inquirer.net",
    "manila bulletin", "rappler",
    "sunstar davao", "sunstar philippines",
    "atenews", "mindanews",
    "mprsdcdo", "mrpsd.com.ph",
    "davao city drrmc", "davao drrmo", "davao city disaster radio",
    "dzmm teleradyo mspc",
    "storm chasers ph", "untv news rescue", "weather davao",
    "bfprhq11", "civil defense davao",
]

OUTPUT_RENAMES = {
    "text": "raw_text",
    "event_time_primary": "datetime",
    "location_matched_json": "location",
    "post_url": "url",
}

OUTPUT_COLUMNS = [
    "source", "page_source", "text_content", "datetime",
    "location", "disaster_type", "url",
]

# --------------------------------------------------------------------------
# places
# --------------------------------------------------------------------------
PLACE_GROUPS = ["LOC", "GPE"]

COUNTRY_NAME = "Philippines"
COUNTRY_TERMS = [
    "ph", "ph.", "pilipinas", "philippine", "philippines",
    "philippine area of responsibility", "par",
]

ISLAND_GROUPS = ["luzon", "visayas", "mindanao"]

PLACE_BLOCKLIST = [
    "philippine", "philippine sea", "west philippine sea",
    "northern luzon", "southern luzon", "eastern visayas",
    "western visayas", "central visayas",
    "philippine area of responsibility", "area of responsibility",
]

PLACE_ALIASES = {
    "metro manila": "National Capital Region (NCR)",
    "ncr": "National Capital Region (NCR)",
    "manila metro": "National Capital Region (NCR)",
    "maynila": "National Capital Region (NCR)",
    "car": "Cordillera Administrative Region (CAR)",
    "barmm": "Bangsamoro Autonomous Region in Muslim Mindanao (BARMM)",
    "armm": "Bangsamoro Autonomous Region in Muslim Mindanao (BARMM)",
    "soccsksargen": "SOCCSKSARGEN Region",
    "region 12": "SOCCSKSARGEN Region",
    "region 11": "Davao Region",
    "region 4a": "CALABARZON",
    "calabarzon": "CALABARZON",
    "region 4b": "MIMAROPA",
    "mimaropa": "MIMAROPA",
    "region 10": "Northern Mindanao",
}

POI_TERMS = [
    "road", "rd", "street", "st", "ave", "avenue", "blvd", "highway", "hwy",
    "bridge", "overpass", "underpass", "rotunda", "roundabout",
    "market", "terminal", "airport", "pier", "port", "wharf", "harbor",
    "school", "church", "chapel", "cemetery", "hospital", "clinic",
    "mall", "plaza", "park", "grounds", "field", "gym", "court",
    "river", "creek", "canal", "subdivision", "subd", "village", "vlge",
    "phase", "blk", "block", "barangay hall", "brgy hall",
    "brgy", "barangay", "volcano", "mount", "mountain",
]

DIRECTIONS = [
    "northern", "southern", "eastern", "western", "north", "south", "east", "west",
    "hilaga", "hilagang", "timog", "timogang", "silangan", "silangang",
    "kanluran", "kanlurang", "amihan", "habagat", "habagatan",
]

VOLCANO_NAMES = ["mayon", "taal", "bulusan", "kanlaon", "pinatubo", "hibok"]

# phrase -> province that replaces the mention; the first phrase found wins
VOLCANO_PROVINCES = {
    "bulkang taal": "Batangas",
    "taal volcano": "Batangas",
    "bulkang mayon": "Albay",
    "mayon volcano": "Albay",
    "bulkang bulusan": "Sorsogon",
    "bulusan volcano": "Sorsogon",
    "bulkang kanlaon": "Negros Occidental",
    "kanlaon volcano": "Negros Occidental",
    "bulkang pinatubo": "Zambales",
    "mount pinatubo": "Zambales",
    "bulkang hibok-hibok": "Camiguin",
    "hibok-hibok volcano": "Camiguin",
}

# region code -> Roman numeral used in names; codes above 18 have none
ROMAN_NUMERALS = [
    "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix",
    "x", "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii", "xviii",
]
MAX_REGION_NUMBER = 20

# --------------------------------------------------------------------------
# Dates and times
# --------------------------------------------------------------------------
TIME_GROUPS = ["DAT", "TIM"]

TAGALOG_DAY_PARTS = {"umaga": "am", "hapon": "pm", "gabi": "pm", "tanghali": "pm"}

TAGALOG_MONTHS = {
    "enero": "january", "pebrero": "february", "marso": "march", "abril": "april",
    "mayo": "may", "hunyo": "june", "hulyo": "july", "agosto": "august",
    "setyembre": "september", "oktubre": "october", "nobyembre": "november",
    "disyembre": "december",
}

MONTH_ABBREVIATIONS = [
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
]

# a fragment without a digit is kept only when it holds one of these
FRAGMENT_WORDS = [
    "am", "pm", "aug", "jul", "jun", "sep", "oct", "nov", "dec", "july", "august",
    "friday", "saturday", "sunday", "monday", "tuesday", "wednesday", "thursday",
]

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

MISSING_WORDS = ["none", "nan", "unknown", "null", ""]

DISPLAY_TIME_FORMAT = "MMMM dd, yyyy HH:mm:ss"
