"""Fixed values of the domain: constants, word lists and patterns that results depend on."""

# geometry, in pixels at 300 dpi
LINE_TOLERANCE = 22
COLUMN_GAP = 90
INDENT_GAP = 10
MIN_COLUMN_WORDS = 3
NOTE_HEADER_REACH = 150
NOTE_HALF_WIDTH = 60
LABEL_MARGIN = 5
HEADER_MARGIN = 150
HEADER_REACH = 40
CELL_REACH = 5
# arithmetic
SUM_TOLERANCE = 1
VALUE_TOLERANCE = 1
PREFIX_BOUND = 14
# matching and confidence
MIN_TITLE_SIMILARITY = 0.6
LOW_CONFIDENCE = 0.70
LINK_THRESHOLD = 0.60
MAX_CANDIDATES = 30
SCORE_WEIGHTS = {"semantic": 0.5, "value": 0.3, "period": 0.2}
LINK_WEIGHTS = {"model": 0.35, "amount": 0.25, "period": 0.15, "agreement": 0.15, "extraction": 0.10}
RELATIONS = ("equals_total", "equals_opening_balance", "equals_movement", "breakdown_component", "unrelated")
# words
STATEMENTS = {
    "balance_sheet": ("BİLANÇO", "FİNANSAL DURUM"),
    "comprehensive_income": ("KAPSAMLI GELİR", "GELİR TABLOSU"),
    "cash_flow": ("NAKİT AKIM",),
    "equity_changes": ("ÖZKAYNAK DEĞİŞİM",),
}
MONTHS = ("ocak", "şubat", "mart", "nisan", "mayıs", "haziran", "temmuz", "ağustos", "eylül", "ekim", "kasım", "aralık")
DASHES = ("-", "–", "—", "_", "~", "−")
DIGIT_LIKE = ("OoDlI|iSB", "000111158")
REF_LIKE = ("IlL|!iOoS", "111111005")
SEVERE = ("unbalanced_parenthesis", "irregular_grouping", "unreadable_ink")
VALUE_KINDS = ("number", "zero", "dash", "percent", "percent_range")
# patterns
HEADING = r"^(?:NOT\s*)?([0-9IlL|]{1,2})\s*[.:\-_]?\s+([^0-9]{3,})\z"
TOC_ENTRY = r"^NOT\s*([0-9IlL|]{1,2})\s+(.+?)[\s.\-_]*([0-9]{1,3})(?:\s*-\s*([0-9]{1,3}))?\z"
TOC_TITLE_ONLY = r"^NOT\s*([0-9IlL|]{1,2})\s+([^0-9]+)\z"
FOLIO = r"^[0-9]{1,3}\z"
UNIT_LINE = r"(?i)tutarlar|gösterilmiş"
FOOTER_LINE = r"(?i)ekteki\s+dipnot"
DECIMAL_AMOUNT = r"^\(?0,[0-9]+\)?\z"
NOTE_TOKEN = r"^[0-9Il|iL!]{1,2}\z"
YEAR = r"(?:19|20)[0-9]{2}"
