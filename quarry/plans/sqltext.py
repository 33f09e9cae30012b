"""DuckDB text for the oracle twins of catalog scalars (same rules as quarry.functions)."""

from __future__ import annotations

# Expected values, written here on their own (not taken from the code they check).
# Digits and blanks are Unicode classes spelled out, since RE2's \d and \s are ASCII.
BLANK = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
DIGIT = r"\p{Nd}"
CLAIM = rf"(?i)\b{DIGIT}+(?:\.{DIGIT}+)?(?:{BLANK}*[%$]|{BLANK}*(?:million|billion|thousand|index|rate|percent))\b"
MASK = rf"(?i)\b{DIGIT}+(?:\.{DIGIT}+)?(?:{BLANK}*[%$]|{BLANK}*(?:million|billion|thousand))\b"
MASKED = "[data available]"
MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"
YMD = rf"\b({DIGIT}{{4}}[-/]{DIGIT}{{1,2}}[-/]{DIGIT}{{1,2}})\b"
DMY = rf"\b({DIGIT}{{1,2}}[-/]{DIGIT}{{1,2}}[-/]{DIGIT}{{4}})\b"
YEAR = rf"\b({DIGIT}{{4}})\b"
MONTH_YEAR = rf"(?i)\b({MONTH}){BLANK}+({DIGIT}{{4}})\b"
DAY_MONTH_YEAR = rf"(?i)\b({DIGIT}{{1,2}}){BLANK}+({MONTH}){BLANK}+({DIGIT}{{4}})\b"
FREQUENCY = rf"(?i)FREQUENCY{BLANK}*={BLANK}*([AQMWD])"
FREQUENCIES = (("A", "annual"), ("Q", "quarterly"), ("M", "monthly"), ("W", "weekly"), ("D", "daily"))
PART_MAX, TEXT_MAX = 64, 100


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+\\z', '', 'g')"


def nonblank(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def first_nonblank(*xs: str) -> str:
    return "coalesce(" + ", ".join(nonblank(x) for x in xs) + ")"


def infer_freq(ann: str) -> str:
    codes = (f"list_filter(list_transform(coalesce({ann}, []), lambda a: regexp_extract("
             f"coalesce({first_nonblank('a.title', 'a.text')}, ''), '{FREQUENCY}', 1)), lambda x: x <> '')")
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FREQUENCIES)
    return f"coalesce(CASE upper(({codes})[1]) {cases} END, '')"


def collect_tags(ann: str) -> str:
    title = nonblank("a.title")
    text = nonblank("a.text")
    parts = (f"list_filter(list_transform(string_split(coalesce({title}, ''), ','), lambda p: {strip('p')}), "
             f"lambda p: p <> '')")
    key = strip("split_part(q, '=', 1)")
    part_tags = (f"flatten(list_transform({parts}, lambda q: [CASE WHEN instr(q, '=') > 0 AND {key} <> '' "
                 f"AND length({key}) <= {PART_MAX} THEN {key} END, "
                 f"CASE WHEN length(q) <= {PART_MAX} THEN q END]))")
    type_tag = f"CASE WHEN a.type IS NOT NULL AND a.type <> '' THEN {strip('a.type')} END"
    text_tag = (f"CASE WHEN {text} IS NOT NULL AND ({title} IS NULL OR {text} <> {title}) "
                f"AND length({text}) <= {TEXT_MAX} THEN {text} END")
    per = f"list_transform(coalesce({ann}, []), lambda a: list_concat([{type_tag}], {part_tags}, [{text_tag}]))"
    return f"list_sort(list_distinct(list_filter(flatten({per}), lambda x: x IS NOT NULL)))"
