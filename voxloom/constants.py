"""Fixed values shared by the operators.

Everything below must equal the published behaviour of the data format (audio limits, tags, language names, code points),
so it is stated as plain literals in one place.
"""

# --- fixed values: audio limits -------------------------------------------------------------------------------------
SAMPLE_RATE = 16000
MAX_RECOGNITION_SECONDS = 1200
MAX_ALIGNMENT_SECONDS = 180
MIN_CHUNK_SECONDS = 0.5
SEARCH_EXPAND_SECONDS = 5.0
MIN_WINDOW_MS = 100.0
MIN_WINDOW_SAMPLES = 4
SESSION_TTL_SECONDS = 600

# --- fixed values: text format --------------------------------------------------------------------------------------
TEXT_TAG = "<asr_text>"
LANGUAGE_PREFIX = "language "
NO_LANGUAGE = "None"
UNKNOWN_LANGUAGE = "Unknown"
TIMESTAMP_MARK = "<timestamp>"
AUDIO_MARKS = "<|audio_start|><|audio_pad|><|audio_end|>"
AUDIO_TOKEN = "<|audio_pad|>"
LABEL_IGNORE = -100

# --- fixed values: defaults of the filters --------------------------------------------------------------------------
MAX_REPEAT_FILTER = 10
REPEAT_LIMIT_REPAIR = 20
MAX_UNIT_REPAIR = 20
MAX_DURATION_SECONDS = 30.0
MAX_SEQUENCE_LENGTH = 2048
PREVIEW_CHARS = 200
EVAL_RATIO = 0.003
SEED = 42
TOKENS_PER_100_FRAMES = 13

# --- fixed values: language names the recogniser accepts -------------------------------------------------------------
RECOGNITION_LANGUAGES = (
    "Chinese", "English", "Cantonese", "Arabic", "German", "French", "Spanish", "Portuguese", "Indonesian", "Italian",
    "Korean", "Russian", "Thai", "Vietnamese", "Japanese", "Turkish", "Hindi", "Malay", "Dutch", "Swedish", "Danish",
    "Finnish", "Polish", "Czech", "Filipino", "Persian", "Greek", "Romanian", "Hungarian", "Macedonian", "Malayalam",
)
# fixed values: language names the aligner accepts
ALIGNMENT_LANGUAGES = (
    "Chinese", "English", "Cantonese", "French", "German", "Italian", "Japanese", "Korean", "Portuguese", "Russian",
    "Spanish",
)
# fixed values: detector code -> language name in the training corpus
DETECTOR_CODES = {
    "ar": "Arabic", "ml": "Malayalam", "zh-cn": "Chinese", "zh-tw": "Chinese", "en": "English", "hi": "Hindi",
}
# the corpus tables also carry these codes
CORPUS_CODES = {**DETECTOR_CODES, "fr": "French", "de": "German", "es": "Spanish"}

# --- fixed values: code points --------------------------------------------------------------------------------------
# the characters a Python string strip removes; Spark's trim alone removes only the blank
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# the same set inside a regular-expression class (valid in Java and in RE2)
WHITESPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# line ends, as str.splitlines sees them
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# seven ideograph blocks; narrower than the Han script property
CJK_CLASS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}"
    r"\x{F900}-\x{FAFF}"
)
KEPT_CLASS = r"'\p{L}\p{N}"
# unicode ranges that decide a script, one per language of the training corpus
SCRIPT_CLASSES = {
    "Arabic": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}",
    "Malayalam": r"\x{0D00}-\x{0D7F}",
    "Chinese": r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}",
    "English": r"A-Za-z",
    "Hindi": r"\x{0900}-\x{097F}",
}
