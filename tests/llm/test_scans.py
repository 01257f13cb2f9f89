"""Secrets, personal data and quality rules against plain Python."""

import hashlib
import math
import re
import unicodedata
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from threadsift.llm import pii, quality_rules, secrets
from threadsift.llm.spans import with_matches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CASE = "|".join(
    "".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token")
)
ASSIGN = re.compile(
    rf"""({_CASE}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def plain_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(0, m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, m.start(), "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(3, m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 8 <= len(digits(m)) <= 15]
    return [(k, a, b) for _, a, k, b in sorted(found)]


HARD = [
    "", "password=abcdef passwd: 'abc' TOKEN = \"x1y2z3\" secret==abcdefg api_key:=abcdef apikey='a.b/c='",
    "xAKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 12 + " AKIA123", "é😀" + "0f" * 12 + " " + "0f" * 11 + "A" + "ab" * 30,
    "tokentoken:abcdef;secret  :  'zz+/_.=-yy' password : \n abcdefgh", "ghp_" + "a1" * 20 + " -----BEGIN RSA PRIVATE KEY-----",
    "a@b.c_d@e.f a.b@c a@b.c.d.@x.y 😀x%y@q-r.s-t.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111 1111 1111 1 4111111111111111",
    "+1 (555) 010-9999 +12 3 +123456789012345 +1234567890123456 ++4912345678 +1-2-3-4-5-6-7-8.",
    "7" * 5000, "a" * 20_000 + "@", "1 " * 3000, "1." * 3000, "- " * 500,
]


def test_private_keys_are_found_whole(spark):
    line = "MIIEvQ+/" * 8
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    head = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0F0F\n"
    keys = [
        f"{begin}\n{line}\n{line}\nab12==\n{end}", f"{begin}{head}\n{line}\nab1\n{end}",
        rf"{begin}\n{line}\nab12=\n{end}\n".removesuffix(r"\n"), f"{begin}\r\n{line}\r\n{line}\r\nab==",
        f"{begin}{head}\n{line}\nab12", begin + f"\n{line}" * 20_000, begin + "\n-x" * 20_000 + end, begin,
    ]
    texts = [f"é {k}\n\nSome words after it, {begin}. More." for k in keys]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pem = [r for r in secrets.RULES if r.kind == "pem"]
    for r in secrets.with_secrets(df, rules=pem).collect():
        spans, text = [(s["start"], s["end"]) for s in r["secrets"]], r["text"]
        assert spans[0] == (2, 2 + len(keys[r["doc_id"]])), r["doc_id"]
        assert [text[a:b] for a, b in spans[1:]] == [begin]
    assert secrets.trigram_query(pem[0].pattern) == secrets.trigram_query("-----BEGIN [A-Z ]*PRIVATE KEY-----")


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")


def test_places_count_code_points(spark):
    df = spark.createDataFrame([("😀ab é ab",), ("",), ("ab",)], "t string")
    rows = with_matches(df, "t", {"m": ("ab", "true")}).collect()
    assert [[(s["start"], s["end"]) for s in r["m"]] for r in rows] == [[(1, 3), (6, 8)], [], [(0, 2)]]


@pytest.mark.parametrize("which", ["documents", "hard"])
def test_secrets(request, which):
    table = request.getfixturevalue(which)
    df, texts = table if which == "documents" else (table, dict(enumerate(HARD)))
    for r in secrets.scan(df).collect():
        base = plain_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base), r
        counts = Counter(k for k, _, _ in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in ("assign", "access", "hex"))
        assert set(r["spans"].split(",")) >= {f"{k}:{a}:{b}" for k, a, b in base}
    if which == "hard":
        assert "github:" in secrets.scan(df).where("doc_id = 5").first()["spans"]


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == ("and", "aki", "kia")
    assert secrets.trigram_query("[0-9a-f]{24,}") is True
    assert secrets.trigram_query("ab?cd") == ("or", ("and", "abc", "bcd"), "acd")
    assert secrets.trigram_query("(abc|x)y+") is True
    assert secrets.trigram_query("(?:abcd)+z") == ("and", "abc", "bcd")


def test_every_match_satisfies_its_rules_query(documents):
    texts = [*HARD, *documents[1].values()]
    holds = lambda q, t: q is True or (q in t if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x, t) for x in q[1:]))
    for rule in secrets.RULES:
        query, pattern = secrets.trigram_query(rule.pattern), re.compile(rule.pattern)
        assert all(holds(query, t.lower()) for t in texts if pattern.search(t))


def test_redaction(spark):
    df = spark.createDataFrame([("a secret: abcdef b " + "0f" * 12 + "!",), ("token=" + "0f" * 12,), ("none",)], "text string")
    found = secrets.with_secrets(df.selectExpr("monotonically_increasing_id() AS doc_id", "text"))
    got = [r[0] for r in found.select(secrets.redacted("text", "secrets", "[X]")).collect()]
    assert got == ["a [X] b [X]!", "[X]", "none"]


@pytest.mark.parametrize("which", ["documents", "hard"])
def test_pii(request, which):
    table = request.getfixturevalue(which)
    df, texts = table if which == "documents" else (table, dict(enumerate(HARD)))
    for r in pii.find(df).collect():
        base = plain_pii(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base), (r, base)
        counts = Counter(k for k, _, _ in base)
        assert tuple(r[f"n_{k}"] for k in pii.KINDS) == tuple(counts[k] for k in pii.KINDS)
        assert set(r["spans"].split(",")) >= {f"{k}:{a}:{b}" for k, a, b in base}


def test_boosting_learns_counts_and_thresholds():
    zero = {f: 0 for f in pii.FEATURES}
    row = lambda kind, plus, n, positives: {**zero, "kind": kind, "abroad": plus, "n": n, "positives": positives}
    rows = [row(3, 1, 100, 99), row(3, 0, 100, 2), row(0, 0, 50, 10)]
    trees = pii.boost(rows)
    score = lambda r: sum(t.value(r) for t in trees)
    assert score(rows[0]) > 1 > -1 > score(rows[1])
    least = pii.thresholds(trees, rows)
    assert 3 in least and 0 not in least and score(rows[1]) < least[3] <= score(rows[0])
    assert pii.boost([]) == []
    many = [row(3, 1, 2000, 2000), row(3, 0, 40, 2)]  # many sure candidates don't carry a few bad ones
    least = pii.thresholds(trees, many)
    assert score(many[1]) < least[3] <= score(many[0])


def test_added_spans_follow_the_model(spark):
    texts = [f"call +1 555 010 {i:04d} now, ref 20240{i % 10}1" for i in range(400)] + ["call +1 555 010"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert all(r["n_phone"] == 1 for k, r in rows.items() if k < 400)
    assert all(s.split(":")[0] == "phone" for r in rows.values() for s in r["spans"].split(",") if s)


def planted(i):
    """Disguised personal data and look-alikes: text, kind or None, the value."""
    card = f"{400000 + i:06d}{7 * i % 10**8:08d}"  # 14 digits, then its check digit
    card += next(d for d in "0123456789" if luhn(card + d))
    forms = [
        ("write to {} soon", "email", f"ann.{i} (at) mail{i % 9} (dot) example (dot) org"),
        ("mail {}", "email", f"bob{i}[at]post[dot]net"), ("ask {} today", "email", f"eve{i} @ mail.example.com"),
        ("please call {} today", "phone", f"555 01{i % 10} {1000 + i % 9000}"),
        ("Telefon {}, bitte", "phone", f"030.{100 + i % 900}.{1000 + i % 9000}"),
        ("paid by {} once", "card", f"{card[:4]} {card[4:10]} {card[10:]}"),
        ("the server {} is down", "ip", f"192,168,{i % 256},{i % 200}"),
        ("order {} is late", None, f"555 01{i % 10} {1000 + i % 9000}"), ("we met {} then", None, f"x{i} (at) 5.{i % 60}"),
        ("sums of {} then", None, f"120,{i % 256},{i % 99},7"), ("stamp {} ends", None, f"17{i:011d}"),
        ("see {} there", None, f"v{i} @ 2.{i % 40}.{i % 7}"),
    ]
    frame, kind, value = forms[i % len(forms)]
    return frame.format(value), kind, value


def test_disguised_personal_data_is_found(spark):
    rows = [planted(i) for i in range(12 * 150)]
    df = spark.createDataFrame([(i, f"é {t}") for i, (t, _, _) in enumerate(rows)], "doc_id long, text string")
    hit = Counter()
    for r in pii.find(df).collect():
        text, kind, value = rows[r["doc_id"]]
        start = 2 + text.index(value)
        spans = [s for s in r["spans"].split(",") if s]
        right = f"{kind}:{start}:{start + len(value)}"
        hit[kind, right in spans] += 1
        hit["wrong"] += len([s for s in spans if s != right])
    for kind in pii.KINDS:
        assert hit[kind, True] >= 0.95 * (hit[kind, True] + hit[kind, False]), hit
    found = sum(hit[k, True] for k in pii.KINDS)
    assert hit["wrong"] <= 0.05 * found, hit


def statistics(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_and_verdicts(documents, labels):
    df, texts = documents
    for r in quality_rules.judge(df, labels).collect():
        own = statistics(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality_rules.BASE) == own
        assert r["base_failed"] == (own[0] < 20 or 100 * own[4] > 30 * own[0])
        assert not (r["base_failed"] and r["kept"])


def test_kept_documents_are_those_judged_so(documents, labels):
    df, _ = documents
    judged = {r["doc_id"] for r in quality_rules.judge(df, labels).where("kept").collect()}
    kept = quality_rules.kept(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == judged


def test_binomial_bounds():
    assert quality_rules.binomial_tail(0, 10, 0.1) == pytest.approx(0.9**10)
    assert quality_rules.binomial_tail(3, 3, 0.1) == 1


def exact_tail(k, n, p):
    return sum(Fraction(math.comb(n, i)) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))


def plain_verdicts(rows, good, risk=Fraction(1, 100), delta=Fraction(1, 20)):
    """Strata's cutoffs with exact fractions; rows: key -> (stratum, values by rule, base_failed)."""
    steps = quality_rules.path()
    share = {s: delta / 5 for s in (*quality_rules.STRATA, "other")}
    own = {s: [v for k, (t, v, failed) in rows.items() if t == s and k in good and not failed] for s in share}
    done, open_ = dict.fromkeys(share, 0), set(share)
    while open_:
        for s in open_:
            while own[s] and done[s] < len(steps):
                bad = sum(any(v[r] > c for r, c in steps[done[s]].items()) for v in own[s])
                if exact_tail(bad, len(own[s]), risk) > share[s]:
                    break
                done[s] += 1
        ended = {s for s in open_ if done[s] == len(steps)}
        open_ -= ended
        if not ended:
            break
        for s in open_:
            share[s] += sum(share[e] for e in ended) / len(open_)
    cut = {s: steps[n - 1] for s, n in done.items() if n}
    return {k: not failed and not any(v[r] > c for r, c in cut.get(s, {}).items()) for k, (s, v, failed) in rows.items()}, cut


def test_steps_only_tighten():
    steps = quality_rules.path()
    assert len(steps) == 1 + sum(len(grid) - 1 for _, grid in quality_rules.RULES.values())
    for a, b in zip(steps, steps[1:]):
        assert sum(b[r] < a[r] for r in a) == 1 and all(b[r] <= a[r] for r in a)


def test_a_stratum_that_ends_leaves_its_share():
    all_ = {"en": [0, 0], "de": [0, 0]}
    assert quality_rules.passed(all_, {"en": 459, "de": 458}) == {"de": 2, "en": 2, "es": 0, "fr": 0, "other": 0}
    assert quality_rules.passed({"en": [0, 9], "de": [0, 0]}, {"en": 459, "de": 458})["de"] == 0
    assert quality_rules.passed(all_, {"en": 458, "de": 458})["en"] == 0
    assert quality_rules.passed({}, {}) == dict.fromkeys([*quality_rules.STRATA, "other"], 0)


def test_verdicts_come_from_the_cutoffs(spark):
    """The whole of a larger table: the method acts there, and each verdict is that of a plain
    computation with exact fractions."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    good = {}
    for r in labels.collect():
        good[r["doc_id"]] = min(good.get(r["doc_id"], 1), r["quality"])
    good = {k for k, q in good.items() if q == 1}
    texts, rows = {r["doc_id"]: r for r in docs.collect()}, {}
    for k, r in texts.items():
        text = r["text"] or ""
        n, chars, symbols, dup, repeat = statistics(text)
        lines = sum(bool(WORD.search(line)) for line in text.split("\n"))
        upper = sum(unicodedata.category(c) == "Lu" for c in text)
        values = {"symbols": symbols / max(chars, 1), "dup_lines": dup / max(lines, 1), "repeats": repeat / max(n, 1), "upper": upper / max(chars, 1)}
        rows[k] = (r["lang"] if r["lang"] in quality_rules.STRATA else "other", values, n < 20 or 100 * repeat > 30 * n)
    want, cut = plain_verdicts(rows, good)
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    assert "en" in cut and {k: r["kept"] for k, r in judged.items()} == want
    added = [k for k, r in judged.items() if not r["kept"] and not r["base_failed"]]
    assert len(added) > 50 and sum(k in good for k in added) <= 0.01 * len(good)


def test_cutoffs_keep_the_risk_by_stratum(spark):
    """English documents are good up to 5 % symbols, German ones have too few labels."""
    rows = [(i, "en", 100, 500, (i % 20) if i < 19_000 else 150, 0, 0, 10, 0) for i in range(20_000)]
    rows += [(30_000 + i, "de", 100, 500, 0, 0, 0, 10, 0) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in quality_rules.STATISTICS))
    labels = df.selectExpr("doc_id", "cast(doc_id < 19000 OR doc_id >= 30000 AS int) AS quality")
    chosen = quality_rules.cutoffs(df, labels)
    assert "de" not in chosen and chosen["en"]["symbols"] == 0.04
    assert quality_rules.cutoffs(df, labels.where("false")) == {}


CLASHES = ["n_words", "n_lines", "secrets", "kinds", "key", "doc", "__kinds", "__text", "found_key", "lang2", "step", "clean"]


def test_columns_of_the_caller_stay(spark, odd, no_labels):
    """Names that the operators use inside: their values come back as they were."""
    plain = (30, " ".join(f"w{i}" for i in range(40)), "en", "a", 5, "x", 1, "k")
    df = odd.where("doc_id IS NULL OR doc_id <> 8").unionByName(spark.createDataFrame([plain], odd.schema))
    for i, name in enumerate(CLASHES):
        df = df.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")))
    given = {str(r) for r in df.collect()}
    clean = secrets.redact(df, "[X]")
    assert clean.columns == df.columns and {str(r) for r in clean.collect()} == given
    kept = quality_rules.kept(df, no_labels)
    assert kept.columns == df.columns and [str(r) for r in kept.collect()] == [str(df.where("doc_id = 30").first())]
    with pytest.raises(ValueError):
        secrets.with_secrets(df)
    named = secrets.with_secrets(df, name="found")
    assert named.columns == [*df.columns, "found"] and {str(r) for r in named.drop("found").collect()} == given
    hidden = spark.createDataFrame([(1, "x", "a token: abcdefg!", 17), (None, "y", None, 3)], "doc_id long, secrets string, text string, n_chars int")
    assert [tuple(r) for r in secrets.redact(hidden, "[X]").orderBy("n_chars").collect()] == [(None, "y", None, 3), (1, "x", "a [X]!", 6)]
    assert secrets.redact(hidden.limit(0), "[X]").count() == 0


def test_odd_rows(odd, empty, no_labels):
    rows = {(r["doc_id"], r["n_words"]) for r in quality_rules.judge(odd, no_labels).collect()}
    assert rows == {(1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (6, 30_001), (7, 5), (None, 60), (8, 1)}
    assert secrets.scan(odd).count() == pii.find(odd).count() == 10
    assert quality_rules.kept(odd, no_labels).columns == odd.columns
    for made in (secrets.scan(empty), pii.find(empty), quality_rules.judge(empty, no_labels)):
        assert made.count() == 0
