"""Word, suffix and pattern tables used when the caller brings none. Plain data, meant to be replaced."""

from __future__ import annotations

# English function words, Penn Treebank tags.
ENGLISH_LEXICON = {
    "DT": ["the", "a", "an", "this", "these", "those", "each", "every", "some", "any", "no"],
    "IN": [
        "of", "in", "with", "on", "for", "by", "at", "from", "that", "into", "over", "under", "than", "as",
        "if", "because", "while", "through", "between", "against", "during", "after", "before", "about",
    ],
    "CC": ["and", "or", "but", "nor"],
    "TO": ["to"],
    "VBZ": ["is", "has", "does", "says"],
    "VBP": ["are", "am", "have", "do"],
    "VBD": ["was", "were", "had", "did", "said"],
    "VB": ["be"],
    "VBN": ["been"],
    "MD": ["can", "could", "may", "might", "must", "shall", "should", "will", "would", "ca", "wo"],
    "PRP": ["i", "it", "they", "you", "we", "he", "she", "him", "them", "us", "me"],
    "PRP$": ["my", "your", "his", "her", "its", "our", "their"],
    "RB": ["not", "n't", "very", "also", "never", "always", "now", "then", "here"],
    "EX": ["there"],
    "WDT": ["which"],
    "WP": ["who", "what", "whom"],
    "WRB": ["when", "where", "why", "how"],
    "JJ": ["new", "old", "good", "quick", "lazy", "tiny", "other", "many", "such"],
    "POS": ["'s", "'"],
    ".": [".", "!", "?"],
    ",": [","],
    ":": [":", ";", "...", "--", "-"],
    "(": ["(", "[", "{"],
    ")": [")", "]", "}"],
    "``": ["``"],
    "''": ["''"],
    "$": ["$"],
    "#": ["#"],
}

# Shape rules, tried in order on the token as written; the first match wins. Kinds: "capital" (the
# first character is upper case), "prefix", "suffix", "pattern" (a regular expression).
ENGLISH_SHAPES = [
    ("capital", "", "NNP"),
    ("suffix", "ing", "VBG"),
    ("suffix", "ed", "VBD"),
    ("suffix", "ly", "RB"),
    ("suffix", "ble", "JJ"),
    ("suffix", "ous", "JJ"),
    ("suffix", "ful", "JJ"),
    ("suffix", "est", "JJS"),
    ("suffix", "tion", "NN"),
    ("suffix", "ness", "NN"),
    ("suffix", "ss", "NN"),
    ("suffix", "us", "NN"),
    ("suffix", "s", "NNS"),
    ("pattern", r"^[0-9][0-9.,:/-]*$", "CD"),
    ("pattern", r"^[^\p{L}\p{N}]+$", "SYM"),
]
ENGLISH_DEFAULT = "NN"

# (previous tag, tag, next tag, new tag); None matches anything. One pass over the sentence per rule.
ENGLISH_CONTEXT = [
    ("TO", "NN", None, "VB"),
    ("MD", "NN", None, "VB"),
    ("DT", "VBD", "NN", "JJ"),
    ("DT", "VBG", None, "NN"),
]

# Arabic function words, Universal Dependencies tags.
ARABIC_LEXICON = {
    "ADP": ["في", "من", "على", "إلى", "الى", "عن", "مع", "بين", "عند", "منذ", "حتى", "خلال", "بعد", "قبل"],
    "CCONJ": ["و", "أو", "ثم", "بل", "لكن"],
    "SCONJ": ["أن", "إن", "ان", "لأن", "كي", "إذا"],
    "DET": ["هذا", "هذه", "ذلك", "تلك", "هؤلاء", "الذي", "التي", "الذين"],
    "PRON": ["هو", "هي", "هم", "نحن", "أنا", "أنت"],
    "PART": ["لا", "لم", "لن", "قد", "ما", "سوف"],
    "AUX": ["كان", "كانت", "يكون", "ليس", "ليست"],
    "VERB": ["قال", "قالت", "زار", "فاز"],
    "PROPN": ["محمد", "بن", "سلمان", "الرياض"],
}

ARABIC_SHAPES = [
    ("prefix", "ي", "VERB"),
    ("pattern", r"^ال.*ية$", "ADJ"),
    ("pattern", r"^\p{N}+$", "NUM"),
    ("pattern", r"^[^\p{L}\p{N}\p{M}_]+$", "PUNCT"),
    ("pattern", r"^[A-Za-z]+$", "X"),
]
ARABIC_DEFAULT = "NOUN"

# Phrases written as their tokens joined by one blank.
ENGLISH_GAZETTEER = [
    ("GNU", "ORG"),
    ("General Public", "ORG"),
    ("GNU General Public License", "LAW"),
    ("General Public License", "LAW"),
    ("Public License", "LAW"),
    ("Apache License", "LAW"),
    ("MIT License", "LAW"),
    ("CC BY", "LAW"),
    ("Fox News", "ORG"),
    ("Secret Service", "ORG"),
    ("US Secret Service", "ORG"),
    ("White House", "ORG"),
    ("Dominion Voting Systems", "ORG"),
    ("Anthony Guglielmi", "PERSON"),
    ("Tuesday", "DATE"),
]

ARABIC_GAZETTEER = [
    ("المنتخب السعودي", "ORG"),
    ("محمد بن سلمان", "PER"),
    ("الرياض", "LOC"),
]

ENTITY_PATTERNS = [
    ("EMAIL", r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("IP", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    ("MONEY", r"\$[0-9][0-9,]*(?:\.[0-9]+)?"),
    ("LONG_NUMBER", r"[0-9]{6,}"),
]
