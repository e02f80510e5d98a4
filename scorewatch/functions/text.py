"""SQL text for report sentences: number formats and first-match rules."""

from __future__ import annotations


def fixed(c: str, digits: int, sign: bool = False) -> str:
    return f"format_string('%{'+' if sign else ''}.{digits}f', double({c}))"


def percent(c: str, digits: int = 2) -> str:
    return f"format_string('%.{digits}f%%', double({c}) * 100.0D)"


def general(c: str, digits: int) -> str:
    """`digits` significant digits, trailing zeros dropped, exponent form for very small or large values."""
    plain = f"format_string('%.{digits}g', double({c}))"
    sci = f"format_string('%.{digits - 1}e', double({c}))"
    return (
        f"CASE WHEN {c} = 0 THEN '0'"
        f" WHEN abs({c}) >= 1E-4 AND abs({c}) < 1E{digits} THEN regexp_replace(regexp_replace({plain}, '([.][0-9]*?)0+$', '$1'), '[.]$', '')"
        f" ELSE regexp_replace({sci}, '[.]?0*e', 'e') END"
    )


def shortest(c: str) -> str:
    """Shortest decimal form with at least one decimal place; exponent form below 1e-4 only."""
    return (
        f"CASE WHEN {c} = 0 OR (abs({c}) >= 1E-3 AND abs({c}) < 1E7) THEN string({c})"
        f" WHEN abs({c}) >= 1E7 THEN regexp_replace(format_string('%.3f', {c}), '([.][0-9]+?)0+$', '$1')"
        f" WHEN abs({c}) >= 1E-4 THEN regexp_replace(format_string('%.12f', {c}), '([.][0-9]+?)0+$', '$1')"
        f" ELSE lower(regexp_replace(string({c}), '[.]0E', 'e')) END"
    )


def quote(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def sentence(*parts: str) -> str:
    """Concatenate quoted text and SQL expressions."""
    return f"concat({', '.join(parts)})"


def choose(rules, default: str) -> str:
    """First matching (condition, value) pair, all SQL text."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {default} END"
