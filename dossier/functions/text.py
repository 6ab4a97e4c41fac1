"""Column expressions on text: scores, reasons, prompts, reports, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip(), str.split() and re's \s take as whitespace.
# Java's \s is ASCII only, and its Unicode variant lacks U+001C to U+001F.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Score and reason markers.
NUMBER = r"([0-9]+\.?[0-9]*)"
REASON = r"理由[:：][\s\S]*"
SCORE_KEY = r'"score"' + WHITESPACE + "*:"
SCORE_VALUE = SCORE_KEY + WHITESPACE + r"*([0-9.]+)"
FLOOR_SCORE = 0.4

# Wording that replaces harsh terms once a zero score is lifted.
SOFTER_TERMS = {"缺乏": "有待提升", "不足": "有改进空间"}
SOFTER_CLOSING = " 尽管如此，候选人具备潜力，适应性强，可以通过培训提升相关技能。"

# The scoring prompt. The criteria block is present in one of two variants.
PROMPT_HEAD = """
        请根据简历和职位描述评估候选人的匹配度。，面对的候选人都是从粗排中筛选出来的中等以上的候选人。
    请你根据以下岗位描述和候选人简历，从专业角度评估其匹配程度，需考虑：
"""
PROMPT_CRITERIA = """        1. 候选人与岗位背景是否相关；
        2. 候选人在经验、教育背景、项目经历、技能、语言等方面是否具备优势；
    如果某些技能不完全匹配，请给出合理的分数，并解释候选人仍然符合岗位要求的理由。
"""
PROMPT_FORMAT = """    请你根据简历与岗位描述评估匹配度，并以如下 JSON 格式输出：
{
  "score": float,
  "reason": string
}
        岗位描述: """
PROMPT_RESUME = "\n        简历: "
PROMPT_END = "\n        "

# Section headers of an instruction record and of a target record, in
# order. The first stands at the beginning; newlines before "Education" may be absent.
RECORD_START = "岗位描述："
SECTION_STARTS = (
    r"\n简历内容：", r"\n*Education: ", r"\n\nWork Experience: ", r"\n\nProjects: ",
    r"\n\nSkills: ", r"\n\nCertifications: ", r"\n\nLanguages: ?",
)
SECTION_FIELDS = (
    "job", "summary", "education", "work_experience", "projects", "skills",
    "certifications", "languages",
)
TARGET_SCORE = r"匹配度[:：][ ]*([0-9.]+)"
TARGET_REASON = r"理由[:：]([\s\S]*)"


def py_strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, rf"\A{WHITESPACE}+|{WHITESPACE}+\z", "")


def py_words(text: Column) -> Column:
    """Words between runs of whitespace, without empty ones."""
    return F.filter(F.split(text, WHITESPACE + "+"), lambda w: w != "")


def last_unit_number(text: Column) -> Column:
    """Last number of the text that lies in [0, 1]; null if there is none."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(1)), lambda x: x.try_cast("double"))
    return F.try_element_at(F.filter(numbers, lambda x: (x >= 0) & (x <= 1)), F.lit(-1))


def reason_tail(text: Column) -> Column:
    """From the first reason marker to the end, stripped; empty if there is none."""
    return py_strip(F.regexp_extract(text, REASON, 0))


def floor_zero_score(score: Column, thr: float = FLOOR_SCORE) -> Column:
    """Lift a score of exactly zero to ``thr``; null stays null."""
    return F.when(score == 0, F.lit(thr)).otherwise(score)


def soften_reason(score: Column, text: Column) -> Column:
    """For a zero score (before the floor) reword a text that holds a harsh term."""
    softer, harsh = text, F.lit(False)
    for term, better in SOFTER_TERMS.items():
        softer = F.replace(softer, F.lit(term), F.lit(better))
        harsh = harsh | F.contains(text, F.lit(term))
    return F.when((score == 0) & harsh, F.concat(softer, F.lit(SOFTER_CLOSING))).otherwise(text)


def render_prompt(instruction: Column, input_text: Column, criteria: bool = True) -> Column:
    """Scoring prompt: the job slot takes ``input_text``, the résumé slot ``instruction``."""
    head = PROMPT_HEAD + (PROMPT_CRITERIA if criteria else "")
    return F.concat(
        F.lit(head + PROMPT_FORMAT), input_text, F.lit(PROMPT_RESUME), instruction, F.lit(PROMPT_END)
    )


def second_score_segment(text: Column) -> Column:
    """From the second score key to before the third; the whole text if there are fewer than two.

    The zero-width split gives one piece per key, after the text before the first
    key (if any), so the second key starts piece ``size - matches + 2`` (1-based).
    """
    matches = F.regexp_count(text, F.lit(SCORE_KEY))
    pieces = F.split(text, f"(?={SCORE_KEY})")
    second = F.try_element_at(pieces, F.size(pieces) - matches + 2)
    return py_strip(F.when(matches >= 2, second).otherwise(text))


def json_score(text: Column, default: float = -1.0) -> Column:
    """Number after the first score key; ``default`` if absent or not a number."""
    found = F.nullif(F.regexp_extract(text, SCORE_VALUE, 1), F.lit(""))
    return F.coalesce(found.try_cast("double"), F.lit(default))


def py_float(x: Column) -> Column:
    """A double as Python prints it (Java switches to exponents at other sizes)."""
    java = x.cast("string")
    plain = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    power = F.concat(
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(~F.contains(java, F.lit("E")), java)
        .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain)
        .otherwise(F.concat(mantissa, power))
    )


def report_block(id_: Column, score: Column, text: Column) -> Column:
    """One report block. The default score is an integer there, so it prints as -1."""
    shown = F.when(score == -1, F.lit("-1")).otherwise(py_float(score))
    return F.concat(
        F.lit("ID: "), id_.cast("string"), F.lit("\nScore: "), shown,
        F.lit("\nGenerated Output:\n"), text, F.lit("\n" + "-" * 80),
    )


def fmt4(x: Column) -> Column:
    """Four decimals, ties decided on the exact binary value as Python does."""
    return F.call_function("format_number", x, F.lit("0.0000"))


def pct(x: Column) -> Column:
    """Percentage with two decimals, ties as in ``fmt4``."""
    return F.concat(F.call_function("format_number", x * 100, F.lit("0.00")), F.lit("%"))


def first_int(name: Column) -> Column:
    """First run of digits as text; empty if there is none."""
    return F.regexp_extract(name, r"(\p{Nd}+)", 1)


# Last extension of the last path part; leading dots belong to the name.
EXTENSION = r"([^/]*[^./][^/]*)(\.[^./]*)$"


def stem(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, EXTENSION, "$1")


def page_key(file_name: Column, page: int | Column = 0) -> Column:
    """Key of a page: stem plus page number (always page 0 unless given)."""
    number = page if isinstance(page, Column) else F.lit(page)
    return F.concat(stem(file_name), F.lit("_page"), number.cast("string"))


def out_path(path: Column, root: str, out_root: str, suffix: str = "_train") -> Column:
    """Output path: other root, same folders, suffix before the extension."""
    moved = F.when(
        F.startswith(path, F.lit(root)), F.concat(F.lit(out_root), F.substring(path, len(root) + 1, 2**31 - 1))
    ).otherwise(path)
    return F.when(
        F.regexp_like(moved, F.lit(EXTENSION)), F.regexp_replace(moved, EXTENSION, f"$1{suffix}$2")
    ).otherwise(F.concat(moved, F.lit(suffix)))


def parse_instruction(text: Column) -> Column:
    """Job, summary and six résumé sections of an instruction record, as a struct.

    The text is cut at the first occurrence of each header in turn, so every part of
    it is searched once. All fields are null if a header is missing.
    """
    body = F.when(F.startswith(text, F.lit(RECORD_START)), F.substring(text, len(RECORD_START) + 1, 2**31 - 1))
    start = F.struct(F.array(F.lit(""), body).alias("parts"), F.array().cast("array<string>").alias("done"))

    def cut(state, header):
        rest = F.try_element_at(state["parts"], F.lit(2))
        done = F.concat(state["done"], F.slice(state["parts"], 1, 1))
        return F.struct(F.split(rest, header, 2).alias("parts"), done.alias("done"))

    def fields(state):
        complete = F.size(state["parts"]) == 2
        values = F.concat(state["done"], state["parts"])
        return F.struct(*[
            F.when(complete, values[i]).alias(name) for i, name in enumerate(SECTION_FIELDS, start=1)
        ])

    return F.aggregate(F.array(*[F.lit(h) for h in SECTION_STARTS]), start, cut, fields)


def list_items(section: Column) -> Column:
    """Items separated by ``"; "``; an empty section gives an empty array."""
    return F.filter(F.split(section, "; "), lambda x: x != "")


def parse_target(text: Column) -> Column:
    """Score and reason of a target record, as a struct."""
    return F.struct(
        F.nullif(F.regexp_extract(text, TARGET_SCORE, 1), F.lit("")).try_cast("double").alias("score"),
        py_strip(F.regexp_extract(text, TARGET_REASON, 1)).alias("reason"),
    )
