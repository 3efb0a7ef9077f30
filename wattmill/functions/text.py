"""Text expressions: trimming, redaction, sanitising, question classes, markdown pieces.

Everything is a column expression; no text leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattmill.functions.binding import let

# Character classes and patterns that decide results.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_IN_LINE = r"\x{9}\x{1f}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
# The same class behind a cheap range test that letters fail at once.
WS_FAST = rf"[\x00-\x20\x7f-\x{{3000}}&&[{WS}]]"
LINE_BREAK = r"\r\n|[\x{b}\x{c}\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
WORD = r"\p{L}\p{N}_"
RUN_ID_LINE = rf"run[{WS}]*id(?:[{WS}]*mlflow)?[{WS}]*:[{WS}]*[a-f0-9]{{32}}\.?[{WS}]*"
SOURCE_TAG = rf"[{WS}]*\[(?:silver_governance|gold_governance|mlflow_report|mlflow_metadata)\]"
THINKING_TAGS = ("think", "redacted_thinking")
CHANNEL_THOUGHT = r"<\|channel>thought\n(.*?)(?:\n\n|\z)"
TOOL_CALL = r"<tool_call>.*?</tool_call>"
PIPED_TOOL_CALL = r"<\|tool_call>.*?<tool_call\|>"
NEEDS_SEARCH = (
    "modelo|métric|metric|rmse|mae|r²|r2|mape|trein|pipeline|xgboost|feature|hiper|"
    "gold|silver|bronze|mlflow|consume|dados|limpos|limpeza|dataset|"
    "pré-?process|preprocess|transform|encoding|normaliz"
)
ASKS_METRICS = "métric|metric|desempenho|avaliação|rmse|mae|mape|r²|r2"
ASKS_PREPARATION = "pré-?process|preprocess|limpeza|limpos|transform|encoding|normaliz|prepar"
RETRY_PREFIX = "INSTRUÇÃO INTERNA: chame a ferramenta search"
FORCED_PREFIX = "Contexto da busca semântica (use somente isto):"
EMPTY_PHRASE = "Não encontrei essa informação nos dados disponíveis"
EMPTY_ANSWER = EMPTY_PHRASE + ". Posso ajudar com outra pergunta sobre o pipeline?"
BOGUS_ANSWERS = ("search",)
CONTEXT_SEPARATOR = "\n\n---\n\n"
MAX_CHUNK = 750
MAX_TEXT = 1020
MIN_CHUNK = 80
PLACEHOLDER_MARK = "[Aguardando treinamento"
TIMESTAMP_LINE = "processado em:"
MIN_TIMESTAMP_BODY = 50
TITLE_CHARS = 255
AUTO_TITLE_CHARS = 50
PREVIEW_CHARS = 500
DEFAULT_TITLES = ("new chat", "novo chat")


def strip(text: Column) -> Column:
    """Drop every kind of Unicode white space at both ends (``trim`` only drops blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def unify_lines(text: Column) -> Column:
    """All line ends as a newline, without one at the very end."""
    return F.regexp_replace(F.regexp_replace(text, LINE_BREAK, "\n"), r"\n\z", "")


def lines(text: Column) -> Column:
    """Array of lines; empty text has none."""
    return F.when(F.length(text) > 0, F.split(unify_lines(text), "\n")).otherwise(F.array().cast("array<string>"))


def _drop_ids(text: Column) -> Column:
    """Remove run-id mentions, then hex ids that stand alone. Both patterns begin with a
    plain character test; the look-behind only runs where that test holds."""
    text = F.regexp_replace(text, f"(?iu){RUN_ID_LINE}", "")
    return F.regexp_replace(text, f"[a-fA-F0-9](?<![{WORD}].)[a-fA-F0-9]{{31}}(?![{WORD}])", "")


def redact(text: Column) -> Column:
    """Remove run-id mentions and bare 32-digit hex ids, then squeeze white space."""
    return strip(F.regexp_replace(_drop_ids(text), f"{WS_FAST}{{2,}}", " "))


def strip_artifacts(text: Column) -> Column:
    """Remove thinking blocks (closed or cut off) and tool-call blocks."""
    text = F.regexp_replace(text, f"(?s){CHANNEL_THOUGHT}", "")
    for tag in THINKING_TAGS:
        text = F.regexp_replace(text, f"(?s)<{tag}>.*?</{tag}>", "")
        text = F.regexp_replace(text, f"(?s)<{tag}>.*", "")
    text = F.regexp_replace(text, f"(?s){TOOL_CALL}", "")
    return strip(F.regexp_replace(text, f"(?s){PIPED_TOOL_CALL}", ""))


def sanitize(answer: Column) -> Column:
    """Answer text fit to show: no artifacts, source tags, ids, or blanks before punctuation."""
    text = F.regexp_replace(strip_artifacts(answer), f"(?iu){SOURCE_TAG}", "")
    text = F.regexp_replace(_drop_ids(text), f"{WS_FAST}{{2,}}", " ")
    return strip(F.regexp_replace(text, f"{WS_FAST}+([.,;])", "$1"))


def thinking_blocks(text: Column) -> Column:
    """Array of thinking blocks, channel form first, then per tag, blanks dropped."""
    found = [F.regexp_extract_all(text, F.lit(f"(?s){CHANNEL_THOUGHT}"), F.lit(1))]
    for tag in THINKING_TAGS:
        found.append(F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1)))
    blocks = F.transform(F.concat(*found), lambda b: strip(b))
    return F.filter(blocks, lambda b: F.length(b) > 0)


def needs_search(text: Column) -> Column:
    return text.rlike(f"(?iu){NEEDS_SEARCH}")


def asks_metrics(text: Column) -> Column:
    return text.rlike(f"(?iu){ASKS_METRICS}")


def asks_preparation(text: Column) -> Column:
    return text.rlike(f"(?iu){ASKS_PREPARATION}")


def is_internal(text: Column) -> Column:
    """Prompts the application wrote itself, never shown as user turns."""
    return text.startswith(RETRY_PREFIX) | text.startswith(FORCED_PREFIX)


def is_bogus(answer: Column) -> Column:
    """Empty answers, echoed tool names and leaked planning text."""

    def judge(low: Column) -> Column:
        bad = (F.length(low) == 0) | low.isin(*BOGUS_ANSWERS)
        for tag in THINKING_TAGS:
            bad = bad | low.contains(f"<{tag}>")
        bad = bad | (low.contains("chame a ferramenta") & low.contains("search"))
        return bad | low.contains("minha primeira ação") | low.contains("query será")

    return let(F.lower(strip_artifacts(answer)), judge)


def refine_answer(answer: Column) -> Column:
    """Keep the substantive part in front of the stock "not found" phrase, then sanitise."""
    head = F.rtrim(strip(F.substring_index(answer, EMPTY_PHRASE, 1)), F.lit("."))
    kept = F.when(answer.contains(EMPTY_PHRASE) & (F.length(head) > 40), F.concat(head, F.lit("."))).otherwise(answer)
    return sanitize(kept)


def cut_at_word(text: Column, limit: int = MAX_TEXT) -> Column:
    """Stripped text of at most ``limit`` characters, cut at the last blank before the limit."""

    def cut(bare: Column) -> Column:
        from_end = F.instr(F.reverse(F.left(bare, F.lit(limit))), " ")
        place = F.when(from_end == 0, F.lit(limit)).otherwise(F.lit(limit) - from_end)
        return F.when(F.length(bare) <= limit, bare).otherwise(strip(F.left(bare, place)))

    return let(strip(text), cut)


def document_title(text: Column) -> Column:
    """Text of the first ``# `` line, empty when there is none."""
    return strip(F.regexp_extract(unify_lines(text), r"(?md)^# ([^\n]*)", 1))


def section_title(section: Column) -> Column:
    """Text of the first second- or third-level heading, empty when there is none."""
    return strip(F.regexp_extract(unify_lines(section), rf"(?md)^#{{2,3}}[{WS_IN_LINE}]([^\n]*)", 1))


def processed_at(text: Column) -> Column:
    """Timestamp text of the ``## Processado em:`` line, empty when there is none."""
    return strip(F.regexp_extract(unify_lines(text), r"(?md)^## Processado em:([^\n]*)", 1))


def markdown_sections(text: Column) -> Column:
    """Array of sections; a new one starts at each second- or third-level heading."""
    parts = F.split(unify_lines(text), rf"\n(?=#{{2,3}}[{WS_IN_LINE}])")
    return F.when(F.length(text) > 0, parts).otherwise(F.array().cast("array<string>"))


def bounded_pieces(text: Column, limit: int = MAX_CHUNK) -> Column:
    """Array of pieces of at most ``limit`` characters, each cut at the last blank that fits.

    One regular expression walks the text: the remaining text if it fits, else
    the longest run that ends before a blank, else a hard cut. White space
    between two pieces belongs to neither.
    """
    last = rf".{{1,{limit}}}(?=[{WS}]*+\z)"
    at_blank = f".{{1,{limit - 1}}}(?= )"
    hard = f".{{{limit}}}"
    first = rf"\A(?:.{{0,{limit - 1}}}(?= )|{hard})"
    later = rf"(?!\A)[{WS}]*+(?:{last}|{at_blank}|{hard})"
    walked = F.regexp_extract_all(text, F.lit(f"(?s){first}|{later}"), F.lit(0))
    pieces = F.transform(walked, lambda p: strip(p))
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(pieces)


def filled_pieces(text: Column, width: Column) -> Column:
    """Array of stripped, non-empty pieces of at most ``width`` characters, which may differ by row; nothing but white space is lost.

    A piece ends before the last white space that fits, or where the text ends; only a word longer than the width is cut.
    """
    most = width.cast("string")
    walked = F.concat(
        F.lit(rf"(?s)(?![{WS}]).{{1,"), most, F.lit(rf"}}(?=[{WS}]|\z)|(?![{WS}]).{{1,"), most, F.lit("}")
    )
    pieces = F.transform(F.regexp_extract_all(text, walked, F.lit(0)), lambda p: strip(p))
    return F.filter(pieces, lambda p: F.length(p) > 0)


def is_low_value(text: Column) -> Column:
    """Chunks not worth indexing: short, placeholder, lone heading, or hardly more than a timestamp."""

    def judge(bare: Column) -> Column:
        # anchored at line starts, where every match begins: without the anchor each failed line costs the square of its length
        body = F.btrim(F.regexp_replace(bare, rf"(?iudm)^.*{TIMESTAMP_LINE}[^\n-]*", ""), F.lit(" -"))
        stamped = bare.rlike(rf"(?iu){TIMESTAMP_LINE}[{WS}]*\p{{Nd}}{{4}}")
        return (
            (F.length(bare) < MIN_CHUNK)
            | bare.contains(PLACEHOLDER_MARK)
            | bare.rlike(r"\A#+ [^\n]+\z")
            | (stamped & (F.length(body) < MIN_TIMESTAMP_BODY))
        )

    return let(strip(text), judge)
