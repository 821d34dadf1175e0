"""Fixed values that must equal the reference's for equal results.

Kept together, in natural order, as plain text. Everything else in the
package is derived by rule (fold tables from the Unicode database, etc.).
"""

# --- fixed values ----------------------------------------------------------
HEBREW_BLOCK = ("֐", "׿")      # token and clean_word range
HEBREW_LETTERS = ("א", "ת")    # strip_niqqud keeps only these
EN_DASH = "–"
LRM = "‎"                            # removed from song files
FILENAME_FORBIDDEN = '\\/*?:"<>|'         # removed from song file names
ARTICLE_MARKER = "ביאורי מילים"           # "word explanations": article text stops here
NO_RESULTS_TEXT = "לא נמצאו תוצאות"       # "no results found": end of a lexicon listing
LISTING_LETTERS = ["א", "ב", "ג", "ד", "ה", "ו", "ז", "ח", "ט", "י", "כ",
                   "ל", "מ", "נ", "ס", "ע", "פ", "צ", "ק", "ר", "ש", "ת"]
DICT_BASE = "https://www.pealim.com"      # dictionary site root (absolute word URLs)
LEXICON_BASE = "https://hadshon.education.gov.il"  # lexicon / article site root
SENTENCE_SOURCES = ("reverso", "tatoeba")  # provider names, in priority order
EXAMPLES_PER_WORD = 3
# ---------------------------------------------------------------------------
