import math
import random
import re

import pytest
from pyspark.sql import functions as F

from dossier.functions import text


def scanned_number(s):
    """The last number in 0..1, found by walking through the characters."""
    last, digits = None, ""
    for c in s + " ":
        if c in "0123456789" or (c == "." and digits and "." not in digits):
            digits += c
            continue
        if digits and float(digits) <= 1:
            last = float(digits)
        digits = ""
    return last


@pytest.mark.parametrize("s, want", [
    ("no digits", None), ("75%", None), ("-0.5", 0.5), ("v1.0.2", 1.0), ("score 0.3 then 1.", 1.0),
    ("only 2", None), ("５", None), ("0.25 and 7.5", 0.25), ("", None), ("1.0", 1.0),
])
def test_last_unit_number(value, s, want):
    assert value(text.last_unit_number, s) == want == scanned_number(s)


def test_last_unit_number_random(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("01.9 a-%") for _ in range(draw.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(text.last_unit_number(F.col("t")).alias("v")).collect()]
    assert got == [scanned_number(t) for t in texts]


@pytest.mark.parametrize("s, want", [
    ("匹配度：0.5\n理由: good ", "理由: good"), ("理由：a\n理由：b\n", "理由：a\n理由：b"), ("理由。", ""), ("", ""),
    ("x理由：\n\n好　", "理由：\n\n好"),
])
def test_reason_tail(value, s, want):
    assert value(text.reason_tail, s) == want


@pytest.mark.parametrize("s, want", [(0.0, 0.4), (0.1, 0.1), (None, None), (1.0, 1.0)])
def test_floor_zero_score(value, s, want):
    assert value(text.floor_zero_score, s, types=["double"]) == want


def test_soften_reason(value):
    soften = lambda s, t: value(text.soften_reason, s, t, types=["double", "string"])
    end = text.SOFTER_CLOSING
    assert soften(0.0, "缺乏经验") == "有待提升经验" + end
    assert soften(0.0, "经验不足") == "经验有改进空间" + end
    assert soften(0.0, "缺乏，不足") == "有待提升，有改进空间" + end
    assert soften(0.0, "很好") == "很好"
    assert soften(0.1, "缺乏") == "缺乏"
    assert soften(None, "缺乏") == "缺乏"


def test_render_prompt(value):
    full = value(text.render_prompt, "my résumé %s {x}", "the job")
    assert "岗位描述: the job\n        简历: my résumé %s {x}\n" in full
    assert '{\n  "score": float,\n  "reason": string\n}' in full
    short = value(lambda a, b: text.render_prompt(a, b, criteria=False), "r", "j")
    assert scanned_number(short) is None and scanned_number(full) == 1.0


def second_segment(s):
    starts = [m.start() for m in re.finditer(r'"score"\s*:', s)]
    if len(starts) < 2:
        return s.strip()
    return s[starts[1]: starts[2] if len(starts) > 2 else None].strip()


CASES = [
    "", "no key", 'a "score": 0.1 b', '"score": 0.1 b', 'a "score": 0.1 b "score"\t: 0.2 c ',
    '"score": 1 "score": 2 "score": 3', 'x"score"　:1"score":2"score" :3 "score":4', '"score":"score":',
]


@pytest.mark.parametrize("s", CASES)
def test_second_score_segment(value, s):
    assert value(text.second_score_segment, s) == second_segment(s)


@pytest.mark.parametrize("s, want", [
    ('"score": 0.75,', 0.75), ('"score" :\n 7', 7.0), ('"score": 1.2.3', -1.0), ('"score": .', -1.0),
    ('"score": .5', 0.5), ('"score": 1.', 1.0), ("none", -1.0), ('"score": "0.5"', -1.0),
])
def test_json_score(value, s, want):
    assert value(text.json_score, s) == want


@pytest.mark.parametrize("x", [
    0.75, 1.0, 0.0, 0.0005, 0.0001, 0.00001, 1e-7, 12345678.25, 1e7, 123456789012345.0, 1e15, 1e16, 1.5e300, 0.1 + 0.2,
])
def test_py_float(value, x):
    assert value(text.py_float, x, types=["double"]) == repr(x)


def test_report_block(value):
    block = value(text.report_block, 3, 0.5, "text\nmore", types=["int", "double", "string"])
    assert block == "ID: 3\nScore: 0.5\nGenerated Output:\ntext\nmore\n" + "-" * 80
    assert "\nScore: -1\n" in value(text.report_block, 3, -1.0, "t", types=["int", "double", "string"])


@pytest.mark.parametrize("x", [0.125, 1.005, 0.00125, 0.99999, 0.5, 12.34565, 0.0, 1 / 3])
def test_formats(value, x):
    assert value(text.fmt4, x, types=["double"]) == f"{x:.4f}"
    assert value(text.pct, x, types=["double"]) == f"{x:.2%}"


@pytest.mark.parametrize("s", ["", " a ", "　a b\x1c", "\x85a b \n c\xa0", "a​b", "\x1f\x0b"])
def test_strip_and_words(value, s):
    assert value(text.py_strip, s) == s.strip()
    assert value(text.py_words, s) == s.split()


@pytest.mark.parametrize("name, want", [
    ("a.b.png", "a.b"), ("a.", "a"), (".png", ".png"), ("..png", "..png"), ("x/y.z/file", "x/y.z/file"), ("file.PDF", "file"),
])
def test_stem(value, name, want):
    assert value(text.stem, name) == want


def test_file_names(value):
    assert value(text.page_key, "cv.12.pdf") == "cv.12_page0"
    assert value(lambda c: text.page_key(c, 3), "cv.pdf") == "cv_page3"
    assert value(text.first_int, "scan_007_v2.pdf") == "007"
    assert value(text.first_int, "scan.pdf") == ""
    out = lambda p: value(lambda c: text.out_path(c, "/in/", "/out/"), p)
    assert out("/in/a.b/c.d.JPG") == "/out/a.b/c.d_train.JPG"
    assert out("/in/a.b/c") == "/out/a.b/c_train"
    assert out("/in/.png") == "/out/.png_train"


RECORD = (
    "岗位描述：Do things.\n- well\n简历内容：A clerk.\n\nEducation: School, 2015\n\nWork Experience: X; Y"
    "\n\nProjects: \n\nSkills: a; b; c\n\nCertifications: \n\nLanguages: en; fr"
)


def test_parse_instruction(value):
    got = value(text.parse_instruction, RECORD)
    assert got.job == "Do things.\n- well" and got.summary == "A clerk." and got.education == "School, 2015"
    assert got.work_experience == "X; Y" and got.projects == "" and got.skills == "a; b; c"
    assert got.certifications == "" and got.languages == "en; fr"
    bare = value(text.parse_instruction, RECORD.replace("A clerk.\n\n", ""))
    assert bare.summary == "" and bare.education == "School, 2015"
    assert value(text.parse_instruction, RECORD.replace("Skills", "Tools")).job is None
    assert value(text.parse_instruction, "x" + RECORD).job is None
    assert value(text.parse_instruction, "").job is None
    empty_end = value(text.parse_instruction, RECORD.replace(" en; fr", ""))
    assert empty_end.languages == ""


def test_parse_instruction_like_one_pattern(spark):
    """Cutting header by header agrees with one lazy pattern over the whole record."""
    whole = re.compile(
        r"\A" + text.RECORD_START + "".join("(.*?)" + h for h in text.SECTION_STARTS) + r"(.*)\Z", re.S
    )
    draw = random.Random(3)
    parts = [text.RECORD_START, "\n简历内容：", "Education: ", "\n\nWork Experience: ", "\n\nProjects: ",
             "\n\nSkills: ", "\n\nCertifications: ", "\n\nLanguages: ", "\n", "a", " "]
    texts = [RECORD]
    for _ in range(200):
        pieces = [parts[0]] + [p for part in parts[1:8] for p in (draw.choice(["", "a", "\n"]), part, draw.choice(parts))]
        if draw.random() < 0.3:
            pieces.pop(draw.randrange(len(pieces)))
        texts.append("".join(pieces))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(text.parse_instruction(F.col("t")).alias("r"))
    for t, row in zip(texts, df.collect()):
        m = whole.match(t)
        assert tuple(row.r) == (m.groups() if m else (None,) * 8), t


def test_items_and_target(value):
    assert value(text.list_items, "a; b c; d") == ["a", "b c", "d"]
    assert value(text.list_items, "") == []
    got = value(text.parse_target, "匹配度：0.68\n理由：fine\nreally ")
    assert got.score == 0.68 and got.reason == "fine\nreally"
    assert value(text.parse_target, "匹配度:0.1\n理由:x").score == 0.1
    assert value(text.parse_target, "none").score is None
    assert math.isclose(value(text.parse_target, "匹配度：1").score, 1.0)
