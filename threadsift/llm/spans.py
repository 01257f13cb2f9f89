"""Places of regular expression matches in texts, with Spark's own functions.

Spark returns matched strings but not where they are, so a text is split by the same
pattern: the lengths of the pieces and of the matches add up to the places. Places
count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: One match: place, end and matched text.
SPAN = "struct<start:int,end:int,value:string>"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_matches(df: DataFrame, text: str, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds a column of spans for each rule: name -> (Java pattern, SQL condition on
    which the text is searched at all). Patterns match at least one character."""
    parts = df.withColumns({
        f"{name}__{part}": F.expr(f"CASE WHEN {when} THEN {call} END")
        for name, (pattern, when) in rules.items()
        for part, call in (
            ("p", f"split({text}, {quoted(pattern)}, -1)"),
            ("m", f"regexp_extract_all({text}, {quoted(pattern)}, 0)"),
        )
    })
    spans = {
        name: F.expr(
            f"""CASE WHEN size({name}__m) > 0 THEN aggregate(
                sequence(0, size({name}__m) - 1),
                named_struct('at', 0, 'out', cast(array() AS array<{SPAN}>)),
                (a, i) -> named_struct(
                    'at', a.at + char_length({name}__p[i]) + char_length({name}__m[i]),
                    'out', concat(a.out, array(named_struct(
                        'start', a.at + char_length({name}__p[i]),
                        'end', a.at + char_length({name}__p[i]) + char_length({name}__m[i]),
                        'value', {name}__m[i])))),
                a -> a.out)
            ELSE cast(array() AS array<{SPAN}>) END"""
        )
        for name in rules
    }
    return parts.withColumns(spans).drop(*(f"{n}__{p}" for n in rules for p in "pm"))


def listed(spans: str) -> Column:
    """``kind:start:end`` of an array of structs with these fields, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
