"""Text functions as columns: exact Unicode semantics on the JVM, without Python per row.

Java's ``\\W`` and ``trim`` know ASCII only, so classes are spelled out: ``SPACE`` is what Python's ``str.isspace``
takes for white space, and a word character is a letter, a number or ``_`` of any script.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SOURCE_ENDS = "。！？.!?\\n"
OTHER_ENDS = ".!?\\n"
CJK = r"\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}"
NOISE = r"\A[A-Za-z0-9[^\p{L}\p{N}_]]+\z"
TOKEN = r"[\p{L}\p{N}_]{2,}"
# Fixed values.
#: Recognisers report failures in their text, which then begins so.
FAILURE = "Tự Hán ("
#: What recognition is known to get wrong, replaced in this order.
CORRECTIONS = (("廣義脊", "廣義省"), ("四土", "田土"), ("五萬空百", "五萬八百"), ("二十九部", "二十九畝"), ("稅案", "稅粟"))


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def _stripped(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: F.length(x) > 0)


def segment(text: Column, ends: str = SOURCE_ENDS) -> Column:
    """Sentences up to each end mark, which stays with its sentence; what remains after the last one too."""
    return _stripped(F.regexp_extract_all(text, F.lit(f"[^{ends}]*[{ends}]|[^{ends}]+"), F.lit(0)))


def segment_other(text: Column) -> Column:
    """The same for scripts without ideographic end marks; white space after a mark goes."""
    return segment(text, OTHER_ENDS)


def segment_plain(text: Column) -> Column:
    """Sentences between full stops, which go; line ends count as spaces. Stands in for a model."""
    return _stripped(F.split(F.translate(text, "\n", " "), r"\."))


def is_noise(text: Column) -> Column:
    """Only ASCII letters, ASCII digits, white space and signs; an empty text is none."""
    return text.rlike(NOISE)


def count_class(text: Column, chars: str = CJK) -> Column:
    """How many characters are in a class: by default the common ideographs and extension A."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def correct(text: Column, corrections: tuple[tuple[str, str], ...] = CORRECTIONS) -> Column:
    for wrong, right in corrections:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def tokens(text: Column) -> Column:
    """Lower-cased words of at least two characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def is_failure(text: Column, prefix: str = FAILURE) -> Column:
    return F.startswith(text, F.lit(prefix))


def pair_id(number: Column) -> Column:
    """pair_0001 and so on; longer numbers are not cut."""
    return F.format_string("pair_%04d", number)


def unix_lines(text: Column) -> Column:
    """Carriage returns, alone or before a line feed, as line feeds: how text files are read."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def pad_or_cut(items: Column, size: Column) -> Column:
    """A list with exactly ``size`` texts: empty ones at the end, or cut."""
    return F.slice(F.concat(items, F.array_repeat(F.lit(""), size)), F.lit(1), size)


def vision_text(body: Column) -> Column:
    """The text of a vision service's answer (responses[0].fullTextAnnotation.text), or its failure."""
    error = F.get_json_object(body, "$.error.message")
    failed = F.get_json_object(body, "$.error").isNotNull()
    told = F.concat(F.lit(f"{FAILURE}Vision - API Error: "), F.coalesce(error, F.lit("Unknown Error")), F.lit(")"))
    return F.when(failed, told).otherwise(strip(F.coalesce(F.get_json_object(body, "$.responses[0].fullTextAnnotation.text"), F.lit(""))))


def vertical_text(body: Column) -> Column:
    """The lines of a vertical-text service's answer: items of ``data`` that are texts or have one."""
    data = F.coalesce(F.from_json(F.get_json_object(body, "$.data"), "array<string>"), F.array().cast("array<string>"))
    line = lambda x: F.when(F.startswith(x, F.lit("{")), F.get_json_object(x, "$.text")).when(F.rlike(x, F.lit(r"\A(\[|-?\d|true|false|null)")), None).otherwise(x)
    good = (F.get_json_object(body, "$.code") == "0") | (F.get_json_object(body, "$.msg") == "success")
    lines = F.array_join(F.filter(F.transform(data, line), lambda x: x.isNotNull()), "\n")
    told = F.concat(F.lit(f"{FAILURE}Vertical - "), F.coalesce(F.get_json_object(body, "$.msg"), F.lit("API Error")), F.lit(")"))
    return F.when(good, lines).otherwise(told)
