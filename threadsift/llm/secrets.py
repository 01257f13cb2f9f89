"""Secret scans through a trigram inverted index.

Each rule's pattern is read once: the literal parts that every match must hold give a
Boolean query of trigrams (of lower-cased text). The postings of the trigrams that
occur in some query are written as a table (trigram, document); intersecting and
uniting them per document leaves the candidates of each rule, and only those are
searched with the pattern. A rule without mandatory trigrams searches every text.

DataFrame functions only. The index is narrow; the texts are shuffled once, by
document, to meet their candidates. Keys need not be unique: a candidate is only
allowed to be searched, so another row of the same key is searched, too.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _parser as patterns

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .common import texts
from .spans import listed, quoted, sha256, with_matches


@dataclass(frozen=True)
class Rule:
    """keep: SQL condition on a match ``s`` (start, end, value); failing ones are
    dropped without a second try."""

    kind: str
    pattern: str
    keep: str = "true"


_VALUE = r"([A-Za-z0-9+/_.=-]+)"
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""" + _VALUE

# The base rules, and token formats that services publish.
BASE = [
    Rule("assign", _ASSIGN, f"char_length(regexp_extract(s.value, {quoted(_ASSIGN)}, 1)) >= 6"),
    Rule("access", r"AKIA[A-Z0-9]+", "char_length(s.value) >= 20"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
]
# A private key runs to its END line, or, where that is missing, over the lines of base64
# (also where line ends are escaped). Possessive groups need no stack, however long it is.
_BEGIN = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_TO_END = r"[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
_LINES = (
    r"(?:\s*+(?:Proc-Type|DEK-Info):[^\r\n]*+)*+(?:[\s\\]++[A-Za-z0-9+/=]{24,}+)++"
    r"(?:[\s\\]++[A-Za-z0-9+/]++={1,2}|\r?\n[A-Za-z0-9+/]++(?=\s*$|\r?\n))?"
)
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", f"{_BEGIN}(?:{_TO_END}|{_LINES})?"),
]
RULES = BASE + MORE

#: A query: True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple
_MOST_STRINGS, _MOST_CHARS = 16, 8


def _joined(op: str, queries: list[Query]) -> Query:
    if op == "and":
        queries = [q for q in queries if q is not True]
    elif True in queries:
        return True
    flat = list(dict.fromkeys(queries))
    return True if not flat else flat[0] if len(flat) == 1 else (op, *flat)


def _of_strings(strings: set[str]) -> Query:
    """What a text that holds one of the strings must hold."""
    return _joined("or", [
        _joined("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)
    ])


def _strings(op, value) -> set[str] | None:
    """All strings an element of a pattern matches, if they are few."""
    if op is patterns.LITERAL:
        return {chr(value).lower()}
    if op is patterns.IN and all(o in (patterns.LITERAL, patterns.RANGE) for o, _ in value):
        chars = {
            chr(c).lower() for o, v in value for c in (range(v[0], v[1] + 1) if o is patterns.RANGE else [v])
        }
        return chars if len(chars) <= _MOST_CHARS else None
    if op in (patterns.MAX_REPEAT, patterns.MIN_REPEAT, patterns.POSSESSIVE_REPEAT):
        low, high, body = value
        inner = _sequence(body)[0]
        if inner is not None and high == 1:
            return inner | {""} if low == 0 else inner
        return None
    if op is patterns.SUBPATTERN:
        return _sequence(value[3])[0]
    if op is patterns.BRANCH:
        every = [_sequence(b)[0] for b in value[1]]
        return None if None in every else set().union(*every)
    if op in (patterns.ASSERT, patterns.ASSERT_NOT, patterns.AT):
        return {""}
    return None


def _inner(op, value) -> Query:
    """What an element demands that isn't a few strings."""
    if op in (patterns.MAX_REPEAT, patterns.MIN_REPEAT, patterns.POSSESSIVE_REPEAT) and value[0] > 0:
        return _sequence(value[2])[1]
    if op is patterns.SUBPATTERN:
        return _sequence(value[3])[1]
    if op is patterns.BRANCH:
        return _joined("or", [_sequence(b)[1] for b in value[1]])
    return True


def _sequence(items) -> tuple[set[str] | None, Query]:
    """The strings that a sequence matches, if few, and its query."""
    held, exact, found = {""}, True, []
    for op, value in items:
        own = _strings(op, value)
        if own is not None and len(held) * len(own) <= _MOST_STRINGS:
            held = {a + b for a in held for b in own}
            continue
        exact = False
        found.append(_of_strings(held))
        found.append(_inner(op, value) if own is None else True)
        held = own if own is not None else {""}
    found.append(_of_strings(held))
    return (held if exact else None), _joined("and", found)


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match satisfies."""
    return _sequence(patterns.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1:]))


def _condition(query: Query, found: str) -> str:
    """The query as SQL over a document's posted trigrams."""
    if isinstance(query, str):
        return f"array_contains({found}, {quoted(query)})"
    return "(" + f" {query[0]} ".join(_condition(q, found) for q in query[1:]) + ")"


def postings(docs: DataFrame, key: str, text: str, wanted: list[str]) -> DataFrame:
    """The inverted index: a row for each wanted trigram and document that holds it."""
    sought = ", ".join(map(quoted, sorted(wanted)))
    # the lambda's variable keeps the lower-cased text from being made for each trigram
    return docs.selectExpr(
        f"`{key}`",
        f"explode(transform(array(lower({text})), x -> filter(array({sought}), t -> contains(x, t)))[0]) AS trigram",
    )


def candidates(index: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """Documents whose postings satisfy some rule's query, with those rules."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not True}
    found = index.where(f"`{key}` IS NOT NULL").groupBy(key).agg(F.collect_set("trigram").alias("found"))
    kinds = ", ".join(f"CASE WHEN {_condition(q, 'found')} THEN {quoted(k)} END" for k, q in queries.items())
    return found.selectExpr(f"`{key}`", f"array_compact(array({kinds})) AS kinds").where("size(kinds) > 0")


def _found(docs: DataFrame, key: str, text: str, rules: list[Rule]) -> DataFrame:
    """doc (all columns of a row, in a struct, so that none clashes), text (null: empty)
    and secrets of every row."""
    own = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = set().union(*map(trigrams, own.values()))
    body = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    if wanted:
        index = written(postings(body.where("key IS NOT NULL"), "key", "text", list(wanted)), "trigrams")
        found = candidates(index, "key", rules).withColumnRenamed("key", "found_key")
        body = body.join(found, F.col("key") == F.col("found_key"), "left").drop("found_key")
    else:
        body = body.withColumn("kinds", F.lit(None).cast("array<string>"))
    searched = {
        f"of_{r.kind}": (
            r.pattern,
            f"text RLIKE {quoted(r.pattern)}" if own[r.kind] is True
            else f"key IS NULL OR array_contains(kinds, {quoted(r.kind)})",
        )
        for r in rules
    }
    spans = ", ".join(
        f"transform(filter(of_{r.kind}, s -> {r.keep}), s -> named_struct("
        f"'start', s.start, 'rank', {i}, 'kind', {quoted(r.kind)}, 'end', s.end))"
        for i, r in enumerate(rules)
    )
    out = with_matches(body, "text", searched).withColumn("secrets", F.expr(f"array_sort(concat({spans}))"))
    return out.select("doc", "text", "secrets")


def with_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] = RULES, name: str = "secrets",
) -> DataFrame:
    """All columns of the documents and, as ``name``, spans (kind, start, end) by start,
    then kind as listed. A null text has none; documents without a key are searched with
    every rule. A ``name`` that the documents have already is refused."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name}; give another name")
    found = _found(docs, key, text, rules)
    return found.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns), F.col("secrets").alias(name))


def redact(
    docs: DataFrame, mark: str, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars", rules: list[Rule] = RULES,
) -> DataFrame:
    """The documents, with their columns, with every secret replaced by a mark, and
    ``n_chars``, where there is such a column, that of the new text. Rows without secrets
    stay as they are, null texts too."""
    found = _found(docs, key, text, rules)
    clean = found.withColumn("clean", F.when(F.size("secrets") > 0, redacted("text", "secrets", mark)))
    changed = {text: F.coalesce("clean", f"doc.`{text}`")}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        changed[n_chars] = F.coalesce(F.char_length("clean").cast(kind), F.col(f"doc.`{n_chars}`"))
    return clean.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every whole text: counts of the base rules, the digest of their
    spans, and all spans. Repeated rows give repeated rows; other columns are not read."""
    found = with_secrets(texts(docs, key, text), key, text)
    base = [r.kind for r in BASE]
    of_base = "filter(secrets, s -> s.kind IN (" + ", ".join(map(quoted, base)) + "))"
    return found.select(
        key,
        *(F.expr(f"cast(size(filter(secrets, s -> s.kind = {quoted(k)})) AS long)").alias(f"n_{k}") for k in base),
        sha256(listed(of_base)).alias("base_sha256"),
        listed("secrets").alias("spans"),
    )


def redacted(text: str, spans: str, mark: str) -> Column:
    """A text with every span (overlapping ones together) replaced by a mark."""
    return F.expr(
        f"""CASE WHEN size({spans}) = 0 THEN {text} ELSE aggregate({spans},
            named_struct('at', 0, 'out', ''),
            (a, s) -> named_struct('at', greatest(a.at, s.end), 'out',
                CASE WHEN s.start >= a.at
                     THEN concat(a.out, substring({text}, a.at + 1, s.start - a.at), {quoted(mark)})
                     ELSE a.out END),
            a -> concat(a.out, substring({text}, a.at + 1))) END"""
    )

