"""String expressions shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import refdata

# Every character that counts as white space, not only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_RUN_OF_SPACE = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_nonempty(*cs: Column) -> Column:
    """The first argument that is neither NULL nor '' (blanks do count)."""
    return F.coalesce(*[empty_to_null(c) for c in cs])


def title(c: Column, chars: int = refdata.TITLE_CHARS) -> Column:
    return F.left(strip(c), F.lit(chars))


def html_snippet(c: Column, chars: int = refdata.SNIPPET_CHARS) -> Column:
    """Markup and runs of white space become one space; then the first ``chars``."""
    bare = F.regexp_replace(strip(c), r"<[^>]+>", " ")
    return F.left(strip(F.regexp_replace(bare, _RUN_OF_SPACE, " ")), F.lit(chars))


def tag_snippet(tags: Column, most: int = 8) -> Column:
    """``Tags: a, b`` of the first tags; NULL where there are none."""
    return F.when(
        F.size(tags) > 0,
        F.concat(F.lit("Tags: "), F.array_join(F.slice(tags, 1, most), ", ")),
    )


def at_handle(c: Column) -> Column:
    return F.concat(F.lit("@"), c)


def story_link(object_id: Column) -> Column:
    return F.concat(F.lit("https://news.ycombinator.com/item?id="), object_id)


def micro_link(uri: Column, handle: Column) -> Column:
    return F.concat(
        F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"),
        F.substring_index(uri, "/", -1),
    )


def is_latin(
    c: Column,
    limit: float = refdata.NON_LATIN_LIMIT,
    latin_end: int = refdata.LATIN_END,
) -> Column:
    """True where less than ``limit`` of the letters lie above ``latin_end``, or
    there are no letters at all."""
    letters = F.regexp_replace(c, r"[^\p{L}]+", "")
    beyond = F.regexp_replace(letters, rf"[\x{{0}}-\x{{{latin_end:X}}}]+", "")
    share = F.length(beyond) / F.nullif(F.length(letters), F.lit(0))
    # As many bytes as characters: plain ASCII, nothing to count.
    return F.when(F.octet_length(c) == F.length(c), F.lit(True)).otherwise(
        F.coalesce(share < F.lit(limit), c.isNotNull())
    )


def label(c: Column, labels: dict[str, str]) -> Column:
    """The label of a key, or the key itself where it has none."""
    return F.coalesce(F.try_element_at(_literal_map(labels), c), c)


def _literal_map(pairs: dict[str, str]) -> Column:
    flat = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.create_map(*flat)


def fingerprint(message: Column, stack: Column) -> Column:
    """Letters and digits of base64("message|second line of the stack"), 64 at most."""
    frame = F.coalesce(F.split_part(stack, F.lit("\n"), F.lit(2)), F.lit(""))
    raw = F.concat(F.coalesce(message, F.lit("")), F.lit("|"), frame)
    coded = F.base64(F.encode(raw, "UTF-8"))
    # All that base64 has besides letters and digits.
    return F.left(F.translate(coded, "+/=\r\n", ""), F.lit(refdata.FINGERPRINT_CHARS))
