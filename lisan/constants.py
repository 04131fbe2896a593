"""Patterns, letters, names and numbers that results depend on."""

# --- fixed values: text ------------------------------------------------------

# Characters Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Abbreviations that never end a sentence: something belongs to them.
ABBREVIATIONS = [
    "Mr", "Mrs", "Ms", "Messrs", "Dr", "Prof", "St", "Gen", "Sen", "Rep", "Gov", "Capt", "Col", "Lt", "Sgt", "Maj",
    "Cmdr", "Adm", "Rev", "Hon", "Pres", "vs", "cf", "viz",
]
# Abbreviations that do not end a sentence before a lower-case word or a number.
OPEN_ABBREVIATIONS = [
    "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec", "Mon", "Tue", "Wed", "Thu",
    "Fri", "Sat", "Sun", "No", "Nos", "Vol", "Fig", "Figs", "Eq", "Sec", "Ch", "pp", "p", "approx", "est", "ca", "al",
    "etc", "Inc", "Ltd", "Co", "Corp", "Bros", "Jr", "Sr", "dept", "Ave", "Blvd", "Rd", "Mt", "ft", "lb", "oz", "hr",
    "min", "max",
]
# Closing quotes and brackets that may follow the sign that ends a sentence.
CLOSERS = "\"')\\]}”’»"

# Arabic sentence ends; the ASCII question mark does not end one.
ARABIC_SENTENCE_END = "[.!؟\n]+"

# Arabic combining marks removed by normalisation.
ARABIC_MARKS = "[\u0617-\u061A\u064B-\u0652\u0670\u0653-\u065F\u06D6-\u06ED]"

# Arabic letters folded by normalisation; the last one (tatweel) is dropped.
ARABIC_FOLD_FROM = "إأآةىؤئـ"
ARABIC_FOLD_TO = "اااهيوي"

# --- fixed values: language model --------------------------------------------

TRAIN_SHARE = 0.8
SENTENCE_START = "<s>"
SENTENCE_END = "</s>"
UNKNOWN = "<UNK>"

# --- fixed values: tags, chunks and entities ---------------------------------

OUTSIDE = "O"
# NP: {<DT>?<JJ.*>*<NN.*>+}, over one letter per tag (see functions.tags.tag_codes).
NOUN_PHRASE = "D?J*N+"
UNEQUAL_LENGTHS = "Gold and Pred must be same length."
ENTITY_LINE = "%s -> %s (score=%.4f)"
TOP_ENTITIES = 20

# --- fixed values: previews and summary report -------------------------------

PREVIEW_CHARS = 150
SAMPLE_CHARS = 200
PREVIEW_TAIL = "..."
SUMMARY = {
    "stamp": "Run timestamp: %s",
    "data": "=== DATA STATS ===",
    "english_articles": "Total English articles: %d",
    "arabic_articles": "Total Arabic articles: %d",
    "english_model": "=== ENGLISH N-GRAM LM (BIGRAM) ===",
    "english_vocabulary": "English vocab size: %d",
    "english_perplexity": "English perplexity: %s",
    "english_sample": "English sample generation: %s",
    "arabic_model": "=== ARABIC N-GRAM LM (BIGRAM) ===",
    "arabic_vocabulary": "Arabic vocab size: %d",
    "arabic_perplexity": "Arabic perplexity: %s",
    "arabic_sample": "Arabic sample generation: %s",
    "pos": "=== ENGLISH POS SAMPLE (FIRST SENTENCE) ===",
    "note": "=== NOTE ===",
}

BOM = "\ufeff"
