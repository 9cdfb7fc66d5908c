"""Text functions against plain Python restatements."""

import random
import re
from itertools import groupby

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxloom.constants import WHITESPACE
from voxloom.functions import text as X
from voxloom.functions.language import forced_language, language_display, normalize_language_name, parse_model_output

x = F.col("x")


def repaired(s):
    """Leftmost shortest unit of up to 20 characters repeated 20 times or more, where 40 characters are left."""
    s = "".join(c if n > 20 else c * n for c, n in ((c, len(list(g))) for c, g in groupby(s)))
    out = ""
    while len(s) >= 40:
        unit = next((s[:k] for k in range(1, 21) if s.startswith(s[:k] * 20)), None)
        if unit is None:
            out, s = out + s[0], s[1:]
            continue
        while s.startswith(unit):
            s = s[len(unit) :]
        out += unit
    return out + s


def repeat_cases():
    rng = random.Random(7)
    cases = ["", "a" * 20, "a" * 21, "a" * 40, "ab" * 19, "ab" * 20, "ab" * 25 + "c", "x" * 20 + "y" * 19, "\n" * 30]
    cases += ["x" * 20 + "y" * 20, "😀" * 25 + "b", "é😀" * 22, "abcdefghijklmnopqrst" * 20, "abcdefghijklmnopqrstu" * 20]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 4)):
            unit = "".join(rng.choice("ab\n😀") for _ in range(rng.randint(1, 22)))
            parts.append(unit * rng.choice([1, 2, 10, 19, 20, 21, 30]))
        cases.append("".join(parts))
    return cases


def test_repair_matches_restatement(column):
    cases = repeat_cases()
    assert column(cases, X.repair_repetitions(x)) == [repaired(c) for c in cases]


def test_long_run(column):
    cases = ["a" * 10, "a" * 11, "\n" * 20, "ab" * 20, "", None, "x" + "😀" * 11, "\r" * 11]
    want = [bool(re.search(r"(.)\1{10,}", c)) if c else False for c in cases]
    assert column(cases, X.has_long_run(x)) == want
    assert column(["aaab"], X.has_long_run(x, 2)) == [True]


def test_extract_transcript(column):
    tag = "<asr_text>"
    cases = [f"language A{tag}hi", f"{tag}", f"a{tag}b\n", f"a{tag}b\nc", f"a\n{tag}b{tag}c", f"a{tag}b\n\n", "none", "", "x\n"]
    cases += [f"a{tag}b\rc", f"a{tag}b c", f"{tag}\n", f"a{tag}b\n{tag}c\n"]

    def want(s):
        m = re.search(r"<asr_text>(.*)$", s)
        return m.group(1) if m else s

    assert column(cases, X.extract_transcript(x)) == [want(c) for c in cases]
    assert column([None], X.extract_transcript(x)) == [""]


def test_trim_every_blank(column):
    cases = [WHITESPACE + "a b" + WHITESPACE, WHITESPACE, "", "​a​", "\x1ca\x85"]
    assert column(cases, X.trim_py(x)) == [c.strip() for c in cases]


def test_tokens(column):
    cases = ["Hello, world", "a,b c", "你好world再 x", "it's  --  5%", "", " 　 ", "𠀀𪜀b", "Ünï-cödé ½", "ab cd ef"]

    def cjk(c):
        blocks = [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F)]
        return any(a <= ord(c) <= b for a, b in [*blocks, (0x2B820, 0x2CEAF), (0xF900, 0xFAFF)])

    def kept(c):
        return c == "'" or c.isalpha() or c.isnumeric()

    def spaced(text):
        words = ("".join(filter(kept, w)) for w in text.split())
        return [t for w in words for single, run in groupby(w, cjk) for t in (list(run) if single else ["".join(run)])]

    def mixed(text):
        kinds = groupby(text, lambda c: "one" if cjk(c) else "run" if kept(c) else "cut")
        return [t for k, run in kinds if k != "cut" for t in (list(run) if k == "one" else ["".join(run)])]

    assert column(cases, X.tokenize_space_lang(x)) == [spaced(c) for c in cases]
    assert column(cases, X.count_tokens(x)) == [len(spaced(c)) for c in cases]
    assert column(cases, X.tokenize_chinese_mixed(x)) == [mixed(c) for c in cases]
    assert column(["a,b"], X.tokenize_space_lang(x)) == [["ab"]]
    assert column(["a,b"], X.tokenize_chinese_mixed(x)) == [["a", "b"]]


def test_encode_alignment_text(column):
    got = column(["a b", ""], X.encode_alignment_text(X.tokenize_space_lang(x)))
    start = "<|audio_start|><|audio_pad|><|audio_end|>"
    assert got == [f"{start}a<timestamp><timestamp>b<timestamp><timestamp>", f"{start}<timestamp><timestamp>"]


def test_words_by_language(spark):
    df = spark.createDataFrame([("a b", "Korean"), ("a b", "JAPANESE"), ("a b", "English")], "t string, l string")
    words = X.words_by_language(F.col("t"), F.col("l"), korean=F.array(F.lit("k")), japanese=F.array(F.lit("j")))
    assert [r[0] for r in df.select(words).collect()] == [["k"], ["j"], ["a", "b"]]


def test_language_names(column):
    cases = ["cHINese", " english\t", "nEW yORK", "ß", "", "  ", None]
    assert column(cases, normalize_language_name(x)) == ["Chinese", "English", "New york", "SS", None, None, None]
    with pytest.raises(PySparkException):
        column([" "], normalize_language_name(x, strict=True))
    assert column(["ENGLISH", " ", None], forced_language(x, ("English",))) == ["English", None, None]
    with pytest.raises(PySparkException):
        column(["klingon"], forced_language(x, ("English",)))
    assert column([" new__yORK  city_", None, ""], language_display(x)) == ["New YORK City", "", ""]


PARSED = [
    (None, None, ("", "")),
    (" \n ", "English", ("", "")),
    (" plain text ", None, ("", "plain text")),
    ("language Chinese<asr_text> ni hao ", None, ("Chinese", "ni hao")),
    ("junk\r\n   LANGUAGE eNGLISH \n\n<asr_text>hi<asr_text>x", None, ("English", "hi<asr_text>x")),
    ("language None<asr_text>", None, ("", "")),
    ("Language NONE<asr_text> still here", None, ("", "still here")),
    ("no head<asr_text>text", None, ("", "text")),
    ("language <asr_text>text", None, ("", "text")),
    ("<asr_text>text", None, ("", "text")),
    ("language French<asr_text>bonjour", "German", ("German", "language French<asr_text>bonjour")),
    ("language French<asr_text>" + "a" * 50, "", ("French", "a")),
]


def test_parse_model_output(spark):
    rows = [(i, raw, forced) for i, (raw, forced, _) in enumerate(PARSED)]
    df = spark.createDataFrame(rows, "i int, raw string, forced string")
    got = parse_model_output(df, "raw", "forced", "language", "text").orderBy("i").collect()
    assert [(r["language"], r["text"]) for r in got] == [want for _, _, want in PARSED]


def test_undetected_and_preview(column):
    tagged = "language None<asr_text>a language None<asr_text>b"
    assert column([tagged, "x"], X.is_undetected(x)) == [True, False]
    assert column([tagged], X.strip_undetected_tag(x)) == ["a b"]
    assert column(["a" * 200, "a" * 201], X.preview(x)) == ["a" * 200, "a" * 200 + "..."]
    assert column(["language A language B<asr_text>t", "t"], X.extract_language_tag(x)) == ["A B", "Unknown"]
