"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Strict patterns give the base spans, which always stay. High-recall generators propose
further, possibly overlapping spans: loosely written addresses, runs of digits with any
separators. Every candidate has a few features with few values each: its format
(digits, signs, separators, checks) and its context (a telling word before it, the
sign on either side). Nobody labels personal data here, so labels are weak ones that do
not depend on the strict form (``LABELS``): the value without its disguise passes a
check (a top-level domain, parts, a checksum and an issuer's digit), or a telling word
or an international prefix says what it is. Boosted trees of depth two are trained on
how often candidates of each feature combination are labelled, over the whole corpus:
the combinations are counted by Spark, and since the features' values are bounded, so
is the table of counts (``COMBINATIONS`` rows at most) that the trees are fitted to.
Documents whose key's checksum is 0 modulo 5 are held out. On them each kind's scores
are taken from the highest down in groups of at least ``LEAST`` candidates, and each
group by itself must be precise (``PRECISION``), so that many sure candidates cannot
carry a few bad ones; the threshold is the last such group's lowest score. Candidates
that reach it and do not overlap a base span become spans, too. Digits that may be a
card as well as a phone number are proposed as both.

DataFrame functions only, the texts are read once and not shuffled; trees become SQL.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F

from ..session import written
from .common import texts
from .spans import listed, quoted, sha256, with_matches

KINDS = ["email", "ip", "card", "phone"]
ROUNDS, RATE, PRECISION, LEAST = 30, 0.3, 0.95, 20

_LOCAL = "A-Za-z0-9._%+-"
# Patterns of the base spans. They match what the plain patterns would match, written
# so that a long run is walked once: a match starts where a run starts or at the end
# of the match before.
BASE = {
    "email": (
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(__text, '@')",
    ),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", r"__text RLIKE '[0-9]\\.[0-9]'"),
    "card": (
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        "__text RLIKE '[0-9][0-9 -]{14}'",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"__text RLIKE '\\+[0-9]'"),
}
_DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
_LUHN = f"""aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) ->
    CASE WHEN d = '' THEN 0 WHEN i % 2 = 0 THEN cast(d AS int)
         WHEN cast(d AS int) > 4 THEN 2 * cast(d AS int) - 9 ELSE 2 * cast(d AS int) END),
    0, (a, d) -> a + d) % 10 = 0"""
_PARTS = """forall(split(s.value, '\\\\.'), p -> char_length(trim(LEADING '0' FROM p)) < 3
    OR (char_length(trim(LEADING '0' FROM p)) = 3 AND trim(LEADING '0' FROM p) <= '255'))"""
KEEP = {
    "email": "true",
    "ip": _PARTS,
    "card": f"char_length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
    "phone": f"char_length({_DIGITS}) BETWEEN 8 AND 15",
}
# The generators: candidates of a kind, far wider than its base pattern.
WIDE = {
    "email": (
        rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
        r"__text RLIKE '@|(?i)[(\\[]at[)\\]]'",
    ),
    "ip": (r"(?<![0-9.])[0-9]++(?:[.,][0-9]++){3,7}+", r"__text RLIKE '[0-9][.,][0-9]'"),
    "digits": (
        r"\+?\(?(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,24}+(?![0-9])",
        "__text RLIKE '[0-9][0-9 ().-]{6}'",
    ),
}
_TELLING = r"(?i)\b(e-?mail|card|visa|pay|payment|ip|host|server|address|contact)\b"
_CALLING = r"(?iu)\b(t[eé]l[eé]f\w*|t[eé]l[eé]phone|phone|call|tel|mobile?|cell|fax|sms|whatsapp)\b"
_TELLS = f"CASE WHEN s.before RLIKE {quoted(_CALLING)} THEN 2 WHEN s.before RLIKE {quoted(_TELLING)} THEN 1 ELSE 0 END"
_ABROAD = f"s.value RLIKE {quoted(r'^(\+|00[1-9])')}"
#: Whether the value without its disguise looks like one of its kind. An address ends
#: in a top-level domain, an IP address has four parts of at most 255, a card number
#: starts with an issuer's digit.
_PLAIN = f"regexp_replace(s.value, {quoted(r'(?i)[(\[]dot[)\]]|\x20')}, '.')"
_WHOLE = f"""CASE s.kind
    WHEN 0 THEN {_PLAIN} RLIKE {quoted(r'^[^@(\[]*[A-Za-z].*\.([a-z]{2,24}|[A-Z]{2,24})$')}
    WHEN 1 THEN s.value RLIKE {quoted(r'^[0-9]+([.,])[0-9]+(\1[0-9]+){2}$')} AND {_PARTS.replace("s.value", "replace(s.value, ',', '.')")}
    WHEN 2 THEN {_DIGITS} RLIKE '^[3-6]' ELSE false END"""
#: Weak labels by kind, over a candidate ``s``.
LABELS = f"""CASE s.kind
    WHEN 0 THEN {_WHOLE}
    WHEN 1 THEN {_WHOLE} AND (NOT contains(s.value, ',') OR s.before RLIKE {quoted(_TELLING)})
    WHEN 2 THEN {_WHOLE} AND char_length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}
    ELSE char_length({_DIGITS}) BETWEEN 8 AND 15 AND ({_ABROAD} OR s.before RLIKE {quoted(_CALLING)}) END"""
#: Feature -> (SQL over a candidate ``s`` with value, before and after, number of values).
FEATURES = {
    "digits": (
        f"""CASE WHEN char_length({_DIGITS}) < 4 THEN 0 WHEN char_length({_DIGITS}) < 8 THEN 1
        WHEN char_length({_DIGITS}) < 13 THEN 2 WHEN char_length({_DIGITS}) < 16 THEN 3
        WHEN char_length({_DIGITS}) < 20 THEN 4 ELSE 5 END""", 6),
    "abroad": (f"cast({_ABROAD} AS int)", 2),
    "at": ("cast(contains(s.value, '@') AS int)", 2),
    "signs": ("least(size(array_distinct(regexp_extract_all(s.value, '[^A-Za-z0-9+@]', 0))), 3)", 4),
    "dots": ("least(char_length(s.value) - char_length(replace(s.value, '.', '')), 4)", 5),
    "luhn": (f"cast({_LUHN} AS int)", 2),
    "whole": (f"cast({_WHOLE} AS int)", 2),
    "telling": (_TELLS, 3),
    "bare": ("cast((s.before = '' OR s.before RLIKE '[ (:,]$') AND (s.after = '' OR s.after RLIKE '^[ ).,;]') AS int)", 2),
}
COMBINATIONS = len(KINDS) * math.prod(n for _, n in FEATURES.values())


@dataclass
class Tree:
    """Two splits: on a feature at most a value, then on each side on another."""

    feature: str
    cut: int
    sides: tuple[tuple[str, int, float, float], tuple[str, int, float, float]]

    def value(self, row: dict) -> float:
        f, cut, low, high = self.sides[0 if row[self.feature] <= self.cut else 1]
        return low if row[f] <= cut else high

    def sql(self) -> str:
        side = lambda f, cut, low, high: f"CASE WHEN c.{f} <= {cut} THEN {low!r}D ELSE {high!r}D END"
        low, high = (side(*s) for s in self.sides)
        return f"CASE WHEN c.{self.feature} <= {self.cut} THEN {low} ELSE {high} END"


def _split(rows: list[dict], features: dict[str, int]) -> tuple[str, int, float, float]:
    """The split of least loss, by sums of gradients g and hessians h."""
    best, found = -1.0, None
    g_all, h_all = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    for f, n in features.items():
        g, h = [0.0] * n, [0.0] * n
        for r in rows:
            g[r[f]] += r["g"]
            h[r[f]] += r["h"]
        gl = hl = 0.0
        for cut in range(n - 1):
            gl, hl = gl + g[cut], hl + h[cut]
            gain = gl * gl / (hl + 1) + (g_all - gl) ** 2 / (h_all - hl + 1)
            if gain > best + 1e-12:
                best, found = gain, (f, cut, -RATE * gl / (hl + 1), -RATE * (g_all - gl) / (h_all - hl + 1))
    return found


def boost(rows: list[dict], rounds: int = ROUNDS) -> list[Tree]:
    """Trees fitted to counts: each row has features, kind, n and positives."""
    features = {"kind": len(KINDS)} | {f: n for f, (_, n) in FEATURES.items()}
    trees, rows = [], [dict(r, score=0.0) for r in rows]
    for _ in range(rounds if rows else 0):
        for r in rows:
            p = 1 / (1 + math.exp(-r["score"]))
            r["g"], r["h"] = r["n"] * p - r["positives"], r["n"] * p * (1 - p)
        f, cut, _, _ = _split(rows, features)
        sides = tuple(
            _split(own, features) if (own := [r for r in rows if (r[f] <= cut) == low]) else (f, cut, 0.0, 0.0)
            for low in (True, False)
        )
        trees.append(Tree(f, cut, sides))
        for r in rows:
            r["score"] += trees[-1].value(r)
    return trees


def thresholds(trees: list[Tree], rows: list[dict], precision: float = PRECISION) -> dict[int, float]:
    """Kind -> lowest score of the last group, from the highest scores down, that is
    precise enough by itself. Candidates of one score are never parted."""
    by_kind, found = defaultdict(lambda: defaultdict(lambda: [0, 0])), {}
    for r in rows:
        counts = by_kind[r["kind"]][round(sum(t.value(r) for t in trees), 9)]
        counts[0] += r["n"]
        counts[1] += r["positives"]
    for kind, scored in by_kind.items():
        n = positives = 0
        for score in sorted(scored, reverse=True):
            n, positives = n + scored[score][0], positives + scored[score][1]
            if n >= LEAST:
                if positives < precision * n:
                    break
                found[kind], n, positives = score - 1e-8, 0, 0
    return found


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``base`` (kind, start, end) and ``wide``: candidates with kind, place,
    features and weak labels, which base spans have anyway."""
    found = with_matches(docs, text, {f"__{k}": BASE[k] for k in KINDS} | {f"__wide_{k}": w for k, w in WIDE.items()})
    base = ", ".join(
        f"transform(filter(__{k}, s -> {KEEP[k]}), s -> named_struct("
        f"'rank', {i}, 'start', s.start, 'kind', {quoted(k)}, 'end', s.end))"
        for i, k in enumerate(KINDS)
    )
    proposed = [  # pattern, kind and the condition on which it is proposed
        ("email", 0, "true"), ("ip", 1, "true"),
        ("digits", 2, f"char_length({_DIGITS}) >= 13"), ("digits", 3, f"char_length({_DIGITS}) < 16"),
    ]
    wide = ", ".join(
        f"transform(filter(__wide_{w}, s -> {when}), s -> named_struct('kind', {kind}, 'start', s.start, 'end', s.end, "
        f"'value', s.value, 'before', substring({text}, greatest(s.start - 23, 1), least(s.start, 24)), "
        f"'after', substring({text}, s.end + 1, 1)))"
        for w, kind, when in proposed
    )
    found = found.withColumns({"base": F.expr(f"array_sort(concat({base}))"), "__wide": F.expr(f"concat({wide})")})
    features = ", ".join(f"'{f}', {sql}" for f, (sql, _) in FEATURES.items())
    found = found.withColumn("wide", F.expr(
        f"""transform(__wide, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, {features},
        'positive', ({LABELS}) OR exists(base, b -> b.rank = s.kind AND b.start = s.start AND b.end = s.end)))"""
    ))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns), "base", "wide")


def fit(found: DataFrame, key: str) -> tuple[list[Tree], dict[int, float]]:
    """Trees and thresholds from all candidates, counted by feature combination."""
    names = ["kind", *FEATURES]
    counted = (
        found.where("size(wide) > 0")
        .select((F.crc32(F.col(key).cast("string")) % 5 == 0).alias("held"), F.explode("wide").alias("c"))
        .groupBy(F.coalesce("held", F.lit(False)).alias("held"), *(F.col(f"c.{n}").alias(n) for n in names))
        .agg(F.count("*").alias("n"), F.sum(F.col("c.positive").cast("long")).alias("positives"))
    )
    rows: list[Row] = counted.collect()  # twice COMBINATIONS rows at most
    trees = boost([r.asDict() for r in rows if not r["held"]])
    return trees, thresholds(trees, [r.asDict() for r in rows if r["held"]]) if trees else {}


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data of every whole text: counts of the base spans, the digest of
    their places, and all spans by kind and start. A null or empty text has none;
    repeated rows give repeated rows; other columns are not read."""
    own = texts(docs, key, text).withColumnRenamed(text, "__text")
    found = written(with_candidates(own, "__text").drop("__text"), "pii")
    trees, least = fit(found, key)
    cutoffs = " ".join(f"WHEN {k} THEN {v!r}D" for k, v in least.items())
    chosen = f"{' + '.join(t.sql() for t in trees)} >= CASE c.kind {cutoffs} END" if least else "false"
    names = f"array({', '.join(map(quoted, KINDS))})"
    more = f"""transform(filter(wide, c -> ({chosen}) AND NOT exists(base, b -> b.start < c.end AND c.start < b.end)),
        c -> named_struct('rank', c.kind, 'start', c.start, 'kind', {names}[c.kind], 'end', c.end))"""
    found = found.withColumn("every", F.expr(f"array_sort(array_union(base, {more}))"))
    return found.select(
        key,
        *(F.expr(f"cast(size(filter(base, s -> s.kind = {quoted(k)})) AS long)").alias(f"n_{k}") for k in KINDS),
        sha256(listed("base")).alias("base_sha256"),
        listed("every").alias("spans"),
    )
