"""Fixed values.

Everything in this module must equal the published data set's own vocabulary
for results to agree: enumerations, word lists, lookup tables, thresholds and
text patterns. Nothing here is logic. All literals are Icelandic data and are
compared as they stand.

Patterns start with flags: ``UNICODE`` is case-insensitive, with Unicode
letters and word boundaries, and newline as the only line end; ``LOWER`` is the
same for text that was put into lower case before, which matches far faster.
"""

UNICODE = "(?iuUd)"
LOWER = "(?Ud)"

# --- fixed values: enumerations ---------------------------------------------

BASIS_PRIORITY = [
    "almenn laun",
    "launatafla",
    "kauptaxtar",
    "lágmarkstekjur",
    "byrjunarlaun",
    "óskilgreint",
]
BASIS_UNSPECIFIED = "óskilgreint"

YEAR_FROM_TEXT = "úr texta"
YEAR_CORRECTED = "leiðrétt"
YEAR_INFERRED = "ályktað"
YEAR_INFERRED_UNSURE = "ályktað (óvisst)"
YEAR_SUSPICIOUS = "grunsamlegt"
TRUSTED_YEAR = [YEAR_FROM_TEXT, YEAR_CORRECTED, YEAR_INFERRED]

TYPE_PERCENT = "prósenta"
TYPE_AMOUNT = "krónutala"
TYPE_BOTH = "prósenta og krónutala"
TYPE_EITHER = "prósenta eða krónutala"
TYPE_FLOOR = "prósenta með krónutölulágmarki"

ORIGIN_REGISTER = "ríkissáttasemjari"
ORIGIN_WEB = "vefskjal"
ORIGIN_MANUAL = "handvirk leiðrétting"

TRACE_METADATA = "staðfest lýsigögn"
TRACE_PARTY = "aðili úr skjali"
TRACE_SITE = "vefur félagsins"
TRACE_MANUAL = "yfirfarið handvirkt"
TRACE_NONE = "órakið"

GRADE_CONTINUOUS = "samfelld"
GRADE_GAPS = "eyður"
GRADE_TOO_FEW = "of fáir punktar"

NOTE_BASE = "grunnur"
NOTE_SIDE = "hliðarsamningur - ekki keðjað"
NOTE_LONG_GAP = "löng eyða á undan"
NOTE_AMOUNT_ONLY = "krónutöluhækkun - vísitala stendur í stað"

STEP_REMARK = "lægra en fyrra þrep"
MANUAL_QUOTE = "Handvirk leiðrétting við yfirferð eyðu."
APPROVED = "samthykkt"
PROPOSAL_NONE = "engin"
PROPOSAL_INCREASE = "haekkun"

# --- fixed values: thresholds -----------------------------------------------

GAP_MONTHS = 18
LONG_GAP_MONTHS = 24
TWIN_DAYS = 90
SIDE_DAYS = 100
SIDE_RATIO = 3
SIDE_MIN_SOURCES = 3
CONFIRM_DAYS = 31
YIELD_DAYS = 45
GENERAL_MIN_UNIONS = 3
PERCENT_EQUAL = 0.005
YEAR_WINDOW_DAYS = 400
EXTRACT_PERCENT = (0.0, 15.0)
EXTRACT_AMOUNT = (500, 100_000)
REVIEW_PERCENT = (0.0, 25.0)
REVIEW_AMOUNT = (500, 200_000)
RATE_CHANGE_PERCENT = (-2.0, 25.0)
CEILING_FACTOR = 1.02

# --- fixed values: months ---------------------------------------------------

MONTHS = {
    "janúar": 1, "januar": 1, "jan": 1,
    "febrúar": 2, "februar": 2, "feb": 2,
    "mars": 3, "mar": 3,
    "apríl": 4, "april": 4, "apr": 4,
    "maí": 5, "mai": 5,
    "júní": 6, "juni": 6, "jún": 6, "jun": 6,
    "júlí": 7, "juli": 7, "júl": 7, "jul": 7,
    "ágúst": 8, "agust": 8, "ág": 8, "ag": 8,
    "september": 9, "sept": 9, "sep": 9,
    "október": 10, "oktober": 10, "okt": 10,
    "nóvember": 11, "november": 11, "nóv": 11, "nov": 11,
    "desember": 12, "des": 12,
}
PROFILE_MONTHS = {
    "janúar": 1, "januar": 1, "febrúar": 2, "februar": 2, "mars": 3,
    "apríl": 4, "april": 4, "maí": 5, "mai": 5, "júní": 6, "juni": 6,
    "júlí": 7, "juli": 7, "ágúst": 8, "agust": 8, "september": 9,
    "október": 10, "oktober": 10, "nóvember": 11, "november": 11,
    "desember": 12,
}


def _longest_first(words) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


MONTH_WORDS = _longest_first(MONTHS)
PROFILE_MONTH_WORDS = _longest_first(PROFILE_MONTHS)

# --- fixed values: dates, percents, amounts in running text -------------------

DATE_IN_TEXT = (
    UNICODE + rf"(\d{{1,2}})\s*\.\s*(?:dag[i]?\s+)?({MONTH_WORDS})\s*\.?\s*(\d{{4}})?"
)
PERCENT_IN_TEXT = r"(?U)(?<![\d.,])(\d{1,2}(?:[.,]\d{1,2})?)\s*%"
AMOUNT_IN_TEXT = (
    LOWER + r"(?:kr\.?\s*(?<![\d.,])(\d{1,3}(?:\.\d{3})+|\d{4,7})"
    r"|(?<![\d.,])(\d{1,3}(?:\.\d{3})+|\d{4,7})\s*(?:kr\.?|krón\w*))"
)

# --- fixed values: context words around an increase ---------------------------

WAGE_WORD = LOWER + (
    r"\blaun|\bkaup|taxt|mánaðarlaun|grunnlaun|byrjunarlaun|launaflokk|"
    r"launatafl|launali[ðd]|kjarataxt|tímakaup|dagvinn"
)
EXCLUDED_PAYMENT = LOWER + (
    r"iðgjald|lífeyri|mótframlag|séreign|sjúkrasjó[ðd]|starfsmennta|"
    r"orlofsheimil|félagsgjald|tryggingagjald|vaxta|verðbólg|"
    r"framlag í|sjóðfélag|endurmenntun|vísitala neysluverðs|"
    r"desemberuppbót|orlofsuppbót|persónuuppbót|"
    r"eingreiðsl|uppgjörsgreiðsl|innáborgun|"
    r"vaktaálag|stórhelgi|álagsgreiðsl|ferðapening|dagpening|vátrygg|"
    r"bifreiðastyrk|fatapening|akstursgjald|námskeiðaálag|"
    r"vátryggingarfjárhæð|slysatrygg|starfsaldursálag"
)
FUND_FEE = LOWER + (
    r"(?<!ríkis)sjóð|virk-?starfsendurhæf|\bvirk\b|starfsendurhæfing|"
    r"iðgjald|mótframlag|\bframlag\s+(?:í|til)\b|gjald\s+(?:í|til)\b|"
    r"greið\w*\s+\d[\d.,]*\s*%\s*(?:af|í|til)\b"
)
PRECEDING_SURCHARGE = LOWER + r"persónuálag|starfsaldursálag"
ENTITLEMENT_SHARE = LOWER + (
    r"orlofs(?:laun|prósent|ávinnsl|rétt\w*|fé)[^.]{0,30}?\d[\d.,]*\s*%|"
    r"(?:skal\s+(?:hann|hún|starfsma\w+)\s+fá|á\s+rétt\s+á|fá\s+þó)"
    r"[^.]{0,20}?\d[\d.,]*\s*%|"
    r"starfsaldri?\s+eða\s+\d+\s*ára\s+aldur"
)
WAGE_LEVEL = LOWER + (
    r"í\s*(?:kr\.?\s*)?\d|skal vera|skulu vera|verða\s*(?:kr\.?\s*)?\d|"
    r"reiknast|nemur\s*\d|% hærri|hærri en"
)
CHANGE_WORD = LOWER + (
    r"hækk|lækk|breyt(?:ast|ist|ing)|taka? hlutfallsh|"
    r"kemur til framkvæmda|áfangahækkun"
)
CONDITION_BEFORE_DATE = LOWER + (
    r"(?:hófu|hóf|hafið|hefja|hefur hafið)\s+(?:þá\s+)?störf[^.]{0,30}$|"
    r"ráðni[rn][^.]{0,25}$|starfað[^.]{0,25}$|"
    r"til og með\s*$|gildir til\s*$|rann út\s*$"
)
BASIS_PATTERNS = [
    ("kauptaxtar", LOWER + r"kauptaxt|launataxt|taxtakaup|taxtalaun|kauptöxt"),
    ("launatafla", LOWER + r"launatafl|launaflokk|launaþrep|launatöfl"),
    ("lágmarkstekjur", LOWER + r"lágmarkstekj|lágmarkslaun|tekjutrygg"),
    ("byrjunarlaun", LOWER + r"byrjunarlaun|upphafslaun"),
    ("almenn laun", LOWER + r"öll laun|almenn\w* (?:launa)?hækk|mánaðarlaun|"
                            r"grunnlaun|laun hækka|hækka laun|dagvinnulaun"),
]
FLOOR_WORD = LOWER + (
    r"að lágmarki|þó (?:eigi|ekki) (?:um )?lægri|hi[ðd] minnsta|"
    r"lágmarkshækkun|krónutöluhækkun að lágmarki"
)
OR_WORD = LOWER + r"\beða\b"

# --- fixed values: contract documents ----------------------------------------

NOT_CONTRACT_NAME = UNICODE + (
    r"blad|blaðið|bladid|frettabref|fréttabréf|timarit|tímarit|arsrit|ársrit|"
    r"arsskyrsl|ársskýrsl|arsreikning|ársreikning|kynningarb|frettir|fréttir|"
    r"vrbladid|skyrsla|skýrsla|glaerur|glærur|erindi"
)
CONTRACT_MARKER = UNICODE + (
    r"kjarasamning|samningur þessi|gildistími|\bgr\.\s*\d|kauptaxt|launatafl"
)
CONTRACT_MARKERS_NEEDED = 3
CONTRACT_MARKER_CHARS = 20_000
CONTRACT_MIN_CHARS = 500
PARTY_CHARS = 4_000
VALIDITY_CHARS = 8_000
PARTY_PATTERNS = [
    "(?iuUds)" + r"\bmilli\s+(.{5,130}?)\s+annars\s+vegar\s+og\s+(.{5,130}?)\s+hins\s+vegar",
    "(?iuUds)" + r"\bmilli\s+(.{5,110}?)\s+og\s+(.{5,110}?)(?=\s*(?:\n|um\b|vegna\b|\d\.))",
    UNICODE + r"KJARASAMNINGUR\s*\n+\s*(.{4,90}?)\s*\n+\s*og\s*\n+\s*(.{4,90}?)\s*(?:\n|$)",
    "(?iuUds)" + r"(?:kjara)?samningur\s+(.{5,90}?)\s+og\s+(.{5,90}?)(?=\s*(?:\n|um\b|\d\.))",
]
VALIDITY = "(?iuUds)" + (
    rf"gild(?:ir|istími)\s*(?:er\s*)?frá\s*(?:og með\s*)?(\d{{1,2}})\s*\.\s*({MONTH_WORDS})"
    rf"\s*\.?\s*(\d{{4}}).{{0,40}}?til\s*(\d{{1,2}})\s*\.\s*({MONTH_WORDS})\s*\.?\s*(\d{{4}})"
)
YEARS_IN_NAME = r"(19\d{2}|20\d{2})\s*[-–_]\s*(19\d{2}|20\d{2})"

# --- fixed values: wage tables -------------------------------------------------

WAGE = r"\d{1,3}(?:\.\d{3})+(?:,\d{1,2})?|\d{4,7}(?:,\d{1,2})?"
TABLE_DATE_WORDS = UNICODE + (
    r"(?:launatafl\w*|launataxt\w*|kauptaxt\w*|gild\w*|tekur\s+gildi)"
    r"[\s,:—–-]*(?:frá|f\.?o\.?m\.?|og\s+með|gildir)*[\s,:—–-]*"
    rf"(\d{{1,2}})\s*\.\s*({MONTH_WORDS})\s*\.?\s*(\d{{4}})"
)
TABLE_DATE_NUMBERS = UNICODE + (
    r"(?:launatafla|kauptaxtar?|gildir?\s+frá)\s*(\d{1,2})\.(\d{1,2})\.(\d{4})"
)
WAGE_UNITS = [
    ("vaktaálag", UNICODE + r"^\s*vaktaálag"),
    ("stórhátíðakaup", UNICODE + r"^\s*stórhátíða"),
    ("yfirvinnukaup", UNICODE + r"^\s*yfirvinn"),
    ("tímakaup í dagvinnu", UNICODE + r"^\s*(?:dagvinna|tímakaup)"),
    ("mánaðarlaun", UNICODE + r"^\s*mánaðarlaun"),
]
UNIT_MONTHLY = "mánaðarlaun"
UNIT_HOURLY = "tímakaup í dagvinnu"
MONTHLY_FROM = 50_000
WAGE_BOUNDS = {
    "mánaðarlaun": (15_000, 3_000_000),
    "tímakaup í dagvinnu": (50, 20_000),
    "yfirvinnukaup": (100, 40_000),
    "stórhátíðakaup": (100, 50_000),
    "vaktaálag": (10, 40_000),
}
RATE_LINE = UNICODE + (
    r"^[\s|]*(?:launafl(?:okkur|\.)?|lfl\.?|fl\.?|flokkur)?[\s|]*"
    rf"(\d{{1,3}})[\s|]+((?:(?:{WAGE})[\s|]*){{2,14}})$"
)
STEP_HEADER = UNICODE + r"(byrjunarl|starfsaldur|grunnlaun|grunnl\.|eftir\s*\d)"
STEP_LABEL = UNICODE + (
    r"byrjunarl\w*\.?|grunnl\w*\.?|eftir\s*\d+\s*(?:ár|mán\w*)|\d+\s*ár|\d+\s*mán\w*"
)

# --- fixed values: coverage profile --------------------------------------------

_PROFILE_DATE = rf"(\d{{1,2}})\.?\s*(?:dag\s+)?({PROFILE_MONTH_WORDS})\s*,?\s*(\d{{4}})?"
_PROFILE_PERCENT = r"(\d{1,2}(?:[.,]\d{1,2})?)\s*%"
PROFILE_DATE_FIRST = UNICODE + (
    rf"{_PROFILE_DATE}\s*[:\-–]?\s*(?:um\s+|hækka\s+um\s+)?{_PROFILE_PERCENT}"
)
PROFILE_PERCENT_FIRST = UNICODE + (
    rf"{_PROFILE_PERCENT}\s*(?:hækkun\s*)?(?:frá|þann|hinn|fr\.o\.m\.?|1\.)?\s*{_PROFILE_DATE}"
)
PROFILE_WORD = LOWER + r"hækk|launabreyting|launaþróun|kauptaxt|taxtahækk|launahækk"
PROFILE_YEARS = (1940, 2035)
PROFILE_PERCENT = (0.0, 40.0)
UNKNOWN = "óþekkt"

# --- fixed values: union and counterparty names ---------------------------------

PUBLIC_FEDERATIONS = ["BSRB", "BHM", "KÍ"]
PRIVATE_FEDERATION = "ASÍ"
PUBLIC_MARKET = "opinber"
PUBLIC_ORDER = ["riki", "sveitarfelog", "reykjavikurborg"]
PRIVATE_ORDER = ["sa"]
OTHER_ORDER = ["sa", "riki"]
MIN_MAIN_ROWS = 3
RECENT_YEARS = 10

UNKNOWN_COUNTERPARTY = "othekktur"
UNKNOWN_COUNTERPARTY_NAME = "Óþekktur mótaðili"
KIND_COMPANY = "fyrirtaeki"
KIND_UNKNOWN = "othekkt"
COMPANY_PREFIX = "fy-"

# (id, display name, kind, patterns); the first entry with a hit decides
COUNTERPARTIES = [
    ("riki", "Ríkið", "riki", [
        r"r[ií]kiss?j[oó]ð", r"fj[aá]rm[aá]la\W*(og efnahags)?r[aá]ðherr",
        r"\bsnr\b", r"samninganefnd r[ií]kisins", r"^r[ií]ki[ðd]$",
        r"\bfjarmalaraduneyti", r"\brikid\b", r"\bog r[ií]kisins\b"]),
    ("reykjavikurborg", "Reykjavíkurborg", "sveitarfelag", [
        r"reykjav[ií]kurborg", r"\brvk\b"]),
    ("sveitarfelog", "Samband íslenskra sveitarfélaga", "sveitarfelag", [
        r"samband\w* [ií]slenskra sveitarf[eé]lag", r"launanefnd sveitarf",
        r"\bsambands?\W+islenskra\W+sveitarfelaga", r"\bsns\b"]),
    ("sfs", "Samtök fyrirtækja í sjávarútvegi", "samtok", [
        r"sj[aá]var[uú]tveg", r"[uú]tvegsmann", r"\bl[ií][uú]\b", r"\bsfs\b",
        r"botnv[oö]rpuskip"]),
    ("fa", "Félag atvinnurekenda", "samtok", [
        r"atvinnurekenda", r"st[oó]rkaupmann", r"\bf[ií]s\b"]),
    ("sfv", "Samtök fyrirtækja í velferðarþjónustu", "samtok", [
        r"velfer[ðd]ar(þ|th)j[oó]nust"]),
    ("smabatar", "Landssamband smábátaeigenda", "samtok", [r"sm[aá]b[aá]taeig"]),
    ("bgs", "Bílgreinasambandið", "samtok", [r"b[ií]lgreinasamband"]),
    ("sa", "Samtök atvinnulífsins", "samtok", [
        r"atvinnul[ií]f", r"^sa$", r"^sa\W", r"\Wsa$", r"\bsa\b",
        r"vinnuveitendasamband", r"\bvs[ií]\b", r"vinnum[aá]lasamband",
        r"rafverktak", r"\bsart\b", r"fer[ðd]a(þ|th)j[oó]nust", r"\bsaf\b",
        r"i[ðd]na[ðd]arins", r"meistarasamband", r"meistaraf[eé]lag",
        r"samninganefnd bankanna", r"fj[aá]rm[aá]lafyrirt", r"\bsff\b",
        r"verslunar og (þ|th)j[oó]nustu", r"\bsv(þ|th)\b",
        r"veitinga\W*og\W*gistih", r"samvinnuf[eé]lag"]),
]
LEGAL_FORM = UNICODE + r"\b(ohf|hf|ehf|sf|ses|bs|slf|svf)\b\.?"
COMPANY_ALIASES = {
    "simans": "siminn",
    "flugfelags-islands": "flugfelag-islands",
    "landsvirkjunar": "landsvirkjun",
    "nordurorku": "nordurorka",
}
COUNTERPARTY_SITES = {
    "sa": "sa", "fa": "fa", "rikid": "riki",
    "samband": "sveitarfelog", "reykjavik": "reykjavikurborg",
}
UNION_SITES = {
    "vr": "VR", "efling": "Efling", "sgs": "SGS",
    "afl": "AFL Starfsgreinafélag", "rsi": "RSÍ", "rafis": "RSÍ",
    "samidn": "Samiðn", "vm": "VM", "matvis": "MATVÍS", "grafia": "Grafía",
    "ssf": "Samtök starfsmanna fjármálafyrirtækja",
    "eining-idja": "Eining-Iðja", "framsyn": "Framsýn",
    "vlfa": "Verkalýðsfélag Akraness", "verkvest": "Verkalýðsfélag Vestfirðinga",
    "liv": "LÍV", "sjomenn": "Sjómannasamband Íslands",
    "bhm": "BHM", "bsrb": "BSRB", "ki": "Kennarasamband Íslands",
    "sameyki": "Sameyki", "hjukrun": "Félag íslenskra hjúkrunarfræðinga",
    "lis": "Læknafélag Íslands", "fin": "Félag íslenskra náttúrufræðinga",
    "vfi": "Verkfræðingafélag Íslands",
}
COPY_PRIORITY = ["rikissattasemjari", "sa", "rikid", "samband", "reykjavik"]

# letters that fold to something other than their base letter
LETTER_FOLD = {"þ": "th", "æ": "ae", "ö": "o", "ð": "d"}
EMPTY_SLUG = "ohekkt"
SLUG_CHARS = 60
COMPANY_SLUG_CHARS = 48
STEM_CHARS = 5

# --- fixed values: collection --------------------------------------------------

RELEVANT_FILE = UNICODE + (
    r"kjarasamn|kjarasamm|samningur|samningar|samkomulag|bokun|bókun|"
    r"launatafl|launataxt|kauptaxt|kaupgjald|launatoflu|launatöflu|taxtar|"
    r"gerdardom|gerðardóm|midlunartillag|miðlunartillög|sattatillag|sáttatillög|"
    r"lifskjarasamning|lífskjarasamning|stodugleikasamning|stöðugleikasamning|"
    r"serkjarasamn|sérkjarasamn|vidauki|viðauki|launabreyting|launahaekkun|"
    r"launahækkun|kjarasamningur"
)
IRRELEVANT_FILE = UNICODE + (
    r"umsokn|umsókn|eydublad|eyðublað|arsreikning|ársreikning|fundargerd|"
    r"fundargerð|personuvernd|persónuvernd|orlofshus|orlofshús|styrkumsokn|"
    r"tjonstilkynning|auglysing|auglýsing|vinnustadaskirteini|namskeid|námskeið"
)
SKIPPED_EXTENSIONS = [
    ".jpg", ".png", ".gif", ".svg", ".zip", ".docx", ".doc", ".xlsx", ".xls",
    ".mp4", ".css", ".js", ".ico", ".webp",
]
FOLLOW_WORDS = [
    "kjarasamning", "kjaramal", "kjaramál", "samningur", "samningar",
    "kaup-kjor", "kaup-og-kjor", "launatafla", "launataxt", "launatoflur",
    "taxt", "eldri", "kjor", "kjör", "media", "skjol", "utgafa", "sidur",
    "vinnumarkadsvefur", "kauptaxt", "kaupgjald", "samthykkt", "bokun",
    "mannaudsmal", "starfskjor", "fylgigogn", "library", "stofnanasamning",
    "adildarfelog", "felag-", "riki",
]
SKIP_WORDS = [
    "umsokn", "umsóknar", "eydublad", "eyðublað", "arsskyrsla", "ársskýrsla",
    "arsreikning", "ársreikning", "fundargerd", "fundargerð", "logreglusamthykkt",
    "personuvernd", "persónuvernd", "sjodfelagi", "styrktarsjod", "sjukrasjod",
    "sjúkrasjóð", "orlofs", "logbok", "lögbók", "samthykktir-felagsins",
]
PDF_URL = r"(?i)(?:https?://[^\s\"'<>\\]+?|/[^\s\"'<>\\]+?)\.pdf"

# --- fixed values: review forms --------------------------------------------------

FORM_HEADINGS = {
    "Félag": "felag", "Auðkenni félags": "audkenni", "Samningur": "samningur",
    "Eyða": "eyda", "Tegund": "tegund", "Gildistaka": "dagsetning",
    "Prósenta": "prosenta", "Krónur": "kronur", "Á við": "a_vid",
    "Heimild": "heimild", "Athugasemd": "athugasemd",
}
FORM_NO_RESPONSE = "_No response_"
FORM_NO_INCREASE = "Engin"
REVIEW_SKIP_STATES = ["rétt", "rett", "óvisst", "ovisst", "óvíst"]
