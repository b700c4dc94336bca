"""Lists, patterns and limits that decide results.

They are data, not logic; changing one changes what a run returns.
"""

# Provider terms and what replaces them, in insertion order.
TERM_REPLACEMENTS = {
    "ChatGPT": "the AI assistant",
    "chatgpt": "the AI assistant",
    "Chat GPT": "the AI assistant",
    "OpenAI": "the AI provider",
    "openai": "the AI provider",
    "OpenAI's": "the AI provider's",
    "GPT-4": "the advanced language model",
    "GPT-3.5": "the language model",
    "GPT-3": "the language model",
    "gpt-4": "the advanced language model",
    "gpt-3.5": "the language model",
    "OpenAI API": "the AI API",
    "ChatGPT API": "the AI API",
}

# Acceptance limits of a reply.
MIN_REPLY_LENGTH = 1
MIN_LENGTH_RATIO = 0.3
MAX_LENGTH_RATIO = 3.0
MIN_SCRIPT_RATIO = 0.5

# Retry and rate defaults.
MAX_RETRIES = 3
BACKOFF_MULTIPLIER = 2
REQUESTS_PER_MINUTE = 40
RATE_WINDOW_SECONDS = 60
REQUEST_TIMEOUT_SECONDS = 30
EXHAUSTED = "All API attempts exhausted"
EMPTY_REPLY = "API returned None"

# A column is text when its mean cell length is above this.
TEXT_MEAN_LENGTH = 10
SPECIAL_SHARE = 0.3

# Regular expression classes (java.util.regex spelling).
# WHITESPACE names the 29 characters that Unicode-aware regular expressions and
# string trimming both count as blank; WHITESPACE_CHARS lists the same set.
WHITESPACE = r"\p{IsWhite_Space}\x1c-\x1f"
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CONTROL = r"\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f"
ARABIC = r"\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff"
WORD = r"\p{L}\p{N}_"
CODE_FENCE = "```"
CODE_WORDS = "def|class|function|import|const|var|let"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
# ASCII letters that more than two characters match when case is ignored.
FOLDED = {"i": "iI\u0131\u0130", "k": "kK\u212a", "s": "sS\u017f"}
URL_PREFIXES = ("http://", "https://")

# Traces of text decoded with the wrong encoding.
MOJIBAKE = ("Ã©", "Ã¨", "Ã ", "Ã§", "â€™", "â€œ", "\ufffd")

# Letter forms folded into bare alef.
ALEF_FORMS = "إأآ"
ALEF = "ا"
# The same forms as a range but one, which is the quicker search.
ALEF_PATTERN = r"[\u0622-\u0625&&[^\u0624]]"

# CSV tokens read as null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Chat templates and sampling parameters per provider.
CHAT_TEMPLATES = {
    "nvidia": {
        "model": "nvidia/riva-translate-4b-instruct-v1.1",
        "system": "You are an expert at translating text from English to Arabic.",
        "before": "What is the Arabic translation of the sentence: ",
        "after": "?",
        "temperature": 0.1,
        "max_tokens": 512,
        "top_p": 0.7,
        "strip_reply": False,
    },
    "fanar": {
        "model": "Fanar",
        "system": "You are an expert translator. Translate the following English text to "
                  "fluent, natural Arabic. Provide only the translation without any explanations.",
        "before": "Translate to Arabic: ",
        "after": "",
        "temperature": 0.3,
        "max_tokens": 1024,
        "top_p": None,
        "strip_reply": True,
    },
}
