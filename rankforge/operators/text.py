"""Text extraction over text columns (T1x, T2x) — JVM regex, no Python UDF.

T1x: a fenced code block that contains a named function, with the original's
fallback (from the first ``def <name>`` up to the next fence).
T2x: strip a ```json fence (or any fence), parse; malformed -> NULL + flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES — extraction patterns
FENCE = "```"
JSON_FENCE = "```json"
FUNCTION_NAME = "add_new_features"
FUNCTION_PATTERN = r"```(?:python)?\s*(def\s+add_new_features[\s\S]*?)```"
_WS = r"[ \t\n\r\f\x0B]"


def strip_ws(x: Column) -> Column:
    """Python ``str.strip()`` for ASCII whitespace."""
    return F.regexp_replace(x, rf"^{_WS}+|{_WS}+$", "")


def fenced_function(text: Column) -> tuple[Column, Column]:
    """(code, found): code of the fenced block defining the function or the fallback."""
    fenced = F.regexp_extract(text, FUNCTION_PATTERN, 1)
    marker = f"def {FUNCTION_NAME}"
    pos = F.instr(text, marker)
    tail = F.substring(text, pos, F.length(text))
    fallback = strip_ws(F.try_element_at(F.split(tail, FENCE, 2), F.lit(1)))
    code = (F.when(fenced != "", strip_ws(fenced))
             .when(pos > 0, fallback))
    return code, code.isNotNull()


def fenced_json_text(text: Column) -> Column:
    """The JSON payload: after the first ```json (or first fence), up to the next fence."""
    after_json = F.try_element_at(F.split(text, JSON_FENCE), F.lit(2))
    after_any = F.try_element_at(F.split(text, FENCE), F.lit(2))
    inner = (F.when(F.instr(text, JSON_FENCE) > 0, F.try_element_at(F.split(after_json, FENCE), F.lit(1)))
              .when(F.instr(text, FENCE) > 0, F.try_element_at(F.split(after_any, FENCE), F.lit(1)))
              .otherwise(text))
    return strip_ws(inner)


def parse_fenced_json(df: DataFrame, text_col: str, out: str = "payload") -> DataFrame:
    """Adds ``{out}`` (VARIANT, NULL when malformed) and ``{out}_valid``."""
    clean = fenced_json_text(F.col(text_col))
    parsed = F.try_parse_json(clean)
    return df.withColumns({out: parsed, f"{out}_valid": parsed.isNotNull()})
