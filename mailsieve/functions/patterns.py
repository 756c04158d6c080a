"""Regular expressions, stop words and tokens used by the column functions.

White space and digits are spelt out as Unicode classes, because the shorthand
classes of Java cover ASCII only.
"""

# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Replacement tokens.
URL_TOKEN = " urltoken "
EMAIL_TOKEN = " emailtoken "
NUMBER_TOKEN = " numbertoken "

# Regular expressions whose matches the results depend on.
SCRIPT_BLOCK = r"(?isu)<script[^>]*>.*?</script>"
STYLE_BLOCK = r"(?isu)<style[^>]*>.*?</style>"
TAG = r"<[^>]+>"
URL = rf"(?iu)https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
# A match may start only where a run of address characters starts (or where the
# last match ended), which keeps the search linear on long unbroken runs.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
    r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
)
DIGITS = r"\p{Nd}+"
NOT_LETTERS = r"[^a-z]+"
LETTERS = r"[a-z]+"
URL_MARK = r"https?://|www\."
UPPERCASE_RUN = r"\p{IsUppercase}+"

#: Runs of at least two word characters.
WORD = r"[\p{L}\p{N}_]{2,}"

# The short English stop-word list.
SHORT_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
    "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with", "you",
    "your",
]

#: Languages whose stop words ship with Spark.
STOPWORD_LANGUAGES = [
    "danish", "dutch", "english", "finnish", "french", "german", "hungarian", "italian",
    "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish",
]
