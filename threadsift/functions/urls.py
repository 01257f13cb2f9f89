"""Canonical form of a URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import refdata
from .sqltext import listed, quote, stripped
from .stage import once

# Schemes that are written with // even when the host is empty.
_HOST_SCHEMES = ["http", "https", "ftp", "sftp", "file", "ws", "wss"]


def _decoded(segment: str) -> str:
    """Form decoding; a percent sign that starts no escape stands for itself."""
    return f"url_decode(regexp_replace({segment}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"


def _encoded(field: str) -> str:
    return f"replace(replace(url_encode({field}), '*', '%2A'), '%7E', '~')"


def _kept_query(raw: str, tracking: list[str]) -> str:
    """The query without tracking parameters, in its order, encoded anew."""
    key = "substring_index(s, '=', 1)"
    pairs = f"""transform(filter(split({raw}, '&'), s -> s <> ''), s -> named_struct(
        'k', {_decoded(key)}, 'v', {_decoded(f"substr(s, length({key}) + 2)")}))"""
    kept = f"filter({pairs}, p -> lower(p.k) NOT IN ({listed(tracking)}))"
    return f"array_join(transform({kept}, p -> concat({_encoded('p.k')}, '=', {_encoded('p.v')})), '&')"


def normal_url_steps(
    source: str, target: str, tracking: list[str] = refdata.TRACKING_PARAMS
) -> list[str]:
    """Lower-case scheme, host as given, no fragment, no tracking parameters and
    no trailing slash (one slash only, and never the root). Empty stays empty;
    a host with an unbalanced bracket gives NULL."""
    bare = f"regexp_replace({stripped(f"coalesce({source}, '')")}, {quote('^[\\x00-\\x20]+')}, '')"
    slashes = f"""_host <> '' OR startswith(_path, '//')
        OR (_scheme IN ({listed(_HOST_SCHEMES)}) AND (_path = '' OR startswith(_path, '/')))"""
    return [
        f"translate({bare}, '\\t\\r\\n', '') AS _given",
        "substring_index(_given, '#', 1) AS _whole",
        "substring_index(_whole, '?', 1) AS _base",
        f"regexp_extract(_base, {quote('^([A-Za-z][A-Za-z0-9+.-]*:)')}, 1) AS _prefix",
        "lower(rtrim(':', _prefix)) AS _scheme",
        "substr(_base, length(_prefix) + 1) AS _rest",
        "if(startswith(_rest, '//'), substring_index(substr(_rest, 3), '/', 1), '') AS _host",
        "if(startswith(_rest, '//'), substr(_rest, length(_host) + 3), _rest) AS _path",
        f"""CASE WHEN length(_whole) > length(_base) + 1
            THEN {_kept_query("substr(_whole, length(_base) + 2)", tracking)}
            ELSE '' END AS _query""",
        f"""CASE WHEN contains(_host, '[') <> contains(_host, ']') THEN NULL ELSE concat(
            if(_scheme <> '', concat(_scheme, ':'), ''),
            if({slashes}, concat('//', _host), ''),
            if(length(_path) > 1 AND endswith(_path, '/'), left(_path, length(_path) - 1), _path),
            if(_query <> '', concat('?', _query), '')) END AS {target}""",
    ]


def with_normal_url(
    df: DataFrame, source: str, tracking: list[str] = refdata.TRACKING_PARAMS
) -> DataFrame:
    """``df`` with the URL column in canonical form. Filters on it do not build
    it again."""
    staged = df.selectExpr("*", *normal_url_steps(source, "_normal", tracking))
    kept = [c for c in df.columns if c != source]
    return once(staged.select(*kept, "_normal"), {source: F.col("_normal")}).select(*df.columns)


def is_web_url(c: Column) -> Column:
    return c.startswith("https://") | c.startswith("http://")
