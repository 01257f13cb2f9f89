"""Quality rules with risk-controlled thresholds.

Each rule compares one statistic of a text with a cutoff. The cutoffs are chosen from
labelled documents, for each stratum (language) on its own: along a fixed path of joint
cutoffs, from lax to strict, the strictest is taken for which, and for all before it, an
exact binomial test shows that fewer than ``RISK`` of the stratum's good documents are
rejected by any of the rules. Testing in a fixed order, up to the first failure, needs
no correction for the number of steps. The strata share the error probability
``DELTA``; one whose path was passed to its end leaves its share to the others (a
Bonferroni-Holm procedure by alpha recycling), so that with probability ``1 - DELTA`` no
stratum exceeds its risk. A stratum with fewer than about 460 good labels rejects nothing
beyond the base rules.

DataFrame functions only. The statistics are one narrow pass, written once; labels meet
them by key without the texts; only counts for each stratum and step (a fixed number)
reach the driver, and the cutoffs return as literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stage import once
from ..session import written
from .spans import quoted

#: Highest share of good documents that may be rejected in a stratum by all rules
#: together, and the probability that this fails anywhere.
RISK, DELTA = 0.01, 0.05
#: Languages with cutoffs of their own; all others, and null, are one more stratum.
STRATA = ("de", "en", "es", "fr")
OTHER = "other"
#: Statistic -> (SQL over the base columns, grid of cutoffs from strict to lax);
#: values above a cutoff are rejected.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", [0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3]),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", [0.1, 0.2, 0.3, 0.5]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.1, 0.15, 0.2, 0.25]),
    "upper": ("n_upper / greatest(word_chars, 1)", [0.2, 0.3, 0.5, 0.7]),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = [*BASE, "n_lines", "n_upper"]

_WHITE = r"[ \t-\r]+"
_SYMBOLS = "#*$%&|<>"
WINDOW = 8


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics of every whole text (null: no words).

    Words in repeated 8-word windows: windows are hashed by doubling (of two words, of
    four, of eight) and only texts with equal hashes go on: the windows are sorted by
    hash, neighbours compared by their words, and the covered places added up.
    """
    out = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({
        "__w": F.expr(f"filter(split(__t, {quoted(_WHITE)}), w -> w != '')"),
        "__l": F.expr(f"filter(split(__t, '\\n', -1), l -> l RLIKE {quoted('[^ ' + chr(92) + 't-' + chr(92) + 'r]')})"),
    })
    out = out.withColumn("__h1", F.expr("transform(__w, w -> xxhash64(w))"))
    for one, two, step in (("__h1", "__h2", 1), ("__h2", "__h4", 2), ("__h4", "__h8", 4)):
        size = f"greatest(size({one}) - {step}, 0)"
        out = out.withColumn(two, F.expr(
            f"zip_with(slice({one}, 1, {size}), slice({one}, {step + 1}, {size}), (a, b) -> xxhash64(a, b))"
        ))
    out = out.withColumn("__s", F.expr(
        """CASE WHEN size(array_distinct(__h8)) < size(__h8)
           THEN array_sort(transform(__h8, (h, i) -> named_struct('h', h, 'p', i))) END"""
    ))
    same = f"__s[{{0}}].h = x.h AND slice(__w, __s[{{0}}].p + 1, {WINDOW}) = slice(__w, x.p + 1, {WINDOW})"
    out = out.withColumn("__r", F.expr(
        f"""array_sort(filter(transform(__s, (x, j) -> CASE
            WHEN j > 0 AND {same.format("greatest(j - 1, 0)")} THEN x.p
            WHEN j + 1 < size(__s) AND {same.format("least(j + 1, size(__s) - 1)")} THEN x.p END),
            p -> p IS NOT NULL))"""
    ))
    bare = "__t"
    for sign in _SYMBOLS:
        bare = f"replace({bare}, '{sign}', '')"
    out = once(out, {
        "n_words": F.expr("cast(size(__w) AS long)"),
        "word_chars": F.expr("cast(char_length(array_join(__w, '')) AS long)"),
        "n_symbols": F.expr(f"cast(char_length(__t) - char_length({bare}) AS long)"),
        "n_dup_lines": F.expr("cast(size(__l) - size(array_distinct(__l)) AS long)"),
        "n_repeat_words": F.expr(
            f"""coalesce(aggregate(__r, named_struct('end', 0, 'n', 0L),
                (a, p) -> named_struct('end', p + {WINDOW}, 'n', a.n + p + {WINDOW} - greatest(p, a.end)),
                a -> a.n), 0L)"""
        ),
        "n_lines": F.expr("cast(size(__l) AS long)"),
        "n_upper": F.expr("cast(regexp_count(__t, '\\\\p{Lu}') AS long)"),
    })
    return out.drop("__t", "__w", "__l", "__h1", "__h2", "__h4", "__h8", "__s", "__r")


BASE_FAILED = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"


def stratum(lang: str) -> str:
    return f"CASE WHEN `{lang}` IN ({', '.join(map(quoted, STRATA))}) THEN `{lang}` ELSE '{OTHER}' END"


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact probability of at most k successes in n."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q
        for i in range(k + 1)
    ]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def path() -> list[dict[str, float]]:
    """Joint cutoffs from lax to strict: each step tightens one rule, in turns."""
    place = {rule: len(grid) - 1 for rule, (_, grid) in RULES.items()}
    steps = [dict(place)]
    while any(place.values()):
        for rule in RULES:
            if place[rule]:
                place[rule] -= 1
                steps.append(dict(place))
    return [{rule: RULES[rule][1][i] for rule, i in step.items()} for step in steps]


def passed(counts: dict[str, list[int]], good: dict[str, int], risk: float = RISK, delta: float = DELTA) -> dict[str, int]:
    """Stratum -> number of steps passed, from the good documents that each step rejects.
    A stratum that passes all its steps leaves its share of ``delta`` to the others."""
    share = {s: delta / (len(STRATA) + 1) for s in (*STRATA, OTHER)}
    done = dict.fromkeys(share, 0)
    open_ = set(share)
    while True:
        for s in open_:
            own = counts.get(s, [])
            while done[s] < len(own) and good.get(s) and binomial_tail(own[done[s]], good[s], risk) <= share[s]:
                done[s] += 1
        ended = {s for s in open_ if counts.get(s) and done[s] == len(counts[s])}
        open_ -= ended
        if not ended or not open_:
            return done
        left = sum(share[s] for s in ended)
        for s in open_:
            share[s] += left / len(open_)


def cutoffs(
    statistics: DataFrame, labels: DataFrame, key: str = "doc_id", lang: str = "lang",
    risk: float = RISK, delta: float = DELTA, label_key: str = "doc_id", label: str = "quality",
) -> dict[str, dict[str, float]]:
    """Stratum -> rule -> cutoff, from the labelled documents that pass the base
    rules. A document with several labels is good if all say so."""
    steps = path()
    good = labels.groupBy(F.col(label_key).alias("label_key")).agg(F.min(label).alias("q")).where("q = 1")
    first = " ".join(
        "WHEN " + " OR ".join(f"{RULES[rule][0]} > {cut}" for rule, cut in step.items()) + f" THEN {i}" for i, step in enumerate(steps)
    )
    narrow = statistics.select(
        F.col(f"`{key}`").alias("key"), F.expr(stratum(lang)).alias("s"), F.expr(BASE_FAILED).alias("failed"),
        F.expr(f"CASE {first} END").alias("step"),
    ).where("NOT failed")
    rows = narrow.join(good, F.col("key") == F.col("label_key"), "left_semi").groupBy("s", "step").count().collect()
    total: dict[str, int] = {}  # the rows: one for each stratum and step at most
    at: dict[str, list[int]] = {}
    for r in rows:
        total[r["s"]] = total.get(r["s"], 0) + r["count"]
        own = at.setdefault(r["s"], [0] * len(steps))
        if r["step"] is not None:  # rejected from this step on, as steps only tighten
            for i in range(r["step"], len(steps)):
                own[i] += r["count"]
    return {s: steps[n - 1] for s, n in passed(at, total, risk, delta).items() if n}


def rejected(chosen: dict[str, dict[str, float]], lang: str = "lang") -> Column:
    """Whether some rule of the document's stratum rejects it."""
    branches = [
        f"({stratum(lang)} = {quoted(s)} AND {RULES[rule][0]} > {cut})"
        for s, rules in chosen.items() for rule, cut in rules.items()
    ]
    return F.expr(" OR ".join(branches) if branches else "false")


def _measured(docs: DataFrame, key: str, text: str, lang: str, columns: list[str]) -> DataFrame:
    """doc (a struct of the columns, so that none clashes), key, lang and the statistics of
    every row, written once."""
    own = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"), F.col(f"`{key}`").alias("key"),
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
    )
    return written(with_statistics(own).drop("text"), "quality")


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """Statistics and verdict of every document. Texts of no words fail the base
    rules; a null language is in the stratum of the others; repeated rows give
    repeated rows; without labels only the base rules decide."""
    own = _measured(docs, key, text, lang, [key])
    chosen = cutoffs(own, labels, "key")
    return own.select(
        F.col("key").alias(key), *BASE, F.expr(BASE_FAILED).alias("base_failed"),
        (~(F.expr(BASE_FAILED) | rejected(chosen))).alias("kept"),
    )


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with their columns. They are written once with their
    statistics, which give the cutoffs and then the verdicts; texts are not shuffled."""
    own = _measured(docs, key, text, lang, docs.columns)
    passing = own.where(~(F.expr(BASE_FAILED) | rejected(cutoffs(own, labels, "key"))))
    return passing.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
