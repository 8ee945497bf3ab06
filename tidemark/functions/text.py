"""Text columns: connection URLs and credentials."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# What replaces a secret, where a key's value ends, and the key
# that is masked by default.
URL_MASK = "*****"
VALUE_MASK = "***"
VALUE_END = "&) "
SECRET_KEYS = ("password",)

# user and password of a URL inside any text; the password ends at the last @
# of the authority part
_USER_INFO = r"""(://[^/?#@:\s"'<>]*:)[^/?#\s"'<>]*@"""


def _key_value(keys: Iterable[str]) -> str:
    return f"((?:{'|'.join(map(re.escape, keys))})=)[^{VALUE_END}]*"


def redact(text: str | Column, keys: Sequence[str] = SECRET_KEYS) -> Column:
    """Mask every URL password and every ``key=value`` of the given keys."""
    text = F.col(text) if isinstance(text, str) else text
    masked = F.regexp_replace(text, _USER_INFO, f"$1{URL_MASK}@")
    return F.regexp_replace(masked, _key_value(keys), f"$1{VALUE_MASK}")


def count_redactions(text: str | Column, keys: Sequence[str] = SECRET_KEYS) -> Column:
    """How many replacements :func:`redact` makes."""
    text = F.col(text) if isinstance(text, str) else text
    masked = F.regexp_replace(text, _USER_INFO, f"$1{URL_MASK}@")
    in_urls = F.regexp_count(text, F.lit(_USER_INFO))
    return in_urls + F.regexp_count(masked, F.lit(_key_value(keys)))


def redact_columns(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SECRET_KEYS
) -> DataFrame:
    """Redact several columns and add ``n_redacted``, the number of masks per row."""
    total = sum((F.coalesce(count_redactions(c, keys), F.lit(0)) for c in columns), F.lit(0))
    return df.withColumn("n_redacted", total).withColumns({c: redact(c, keys) for c in columns})


def _group(text: Column, pattern: str) -> Column:
    """First group of the pattern, NULL instead of '' where nothing is found."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def _percent_decode(text: Column) -> Column:
    """Decode what is an escape; other percent signs and plus signs stand for themselves."""
    literal = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(literal, F.lit("+"), F.lit("%2B"))), text)


def _port(text: Column) -> Column:
    """A 16-bit number; anything larger is no port."""
    port = text.try_cast("int")
    return F.when(port <= 65535, port)


def split_url(url: str | Column, scheme: str | None = None) -> Column:
    """A struct with the parts of a URL and ``error``, the first part missing.

    ``error`` is NULL for a complete connection URL and else one of
    ``invalid_url``, ``wrong_scheme`` (only with ``scheme``), ``missing_host``,
    ``missing_port``, ``missing_user``, ``missing_password``, ``missing_path``.
    """
    url = F.col(url) if isinstance(url, str) else url
    authority = F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)
    user_info = F.regexp_extract(authority, r"^(.*)@", 1)
    host_port = F.regexp_extract(authority, r"([^@]*)$", 1)
    parts = {
        "scheme": F.lower(_group(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://")),
        "user": _group(user_info, r"^([^:]*)"),
        "password": _percent_decode(_group(user_info, r"^[^:]*:(.*)$")),
        "host": _group(host_port, r"^(\[[^\]]*\]|[^:]*)"),
        "port": _port(_group(host_port, r":([0-9]+)$")),
        "path": _group(url, r"^[^:/?#]+://[^/?#]*([^?#]*)"),
        "query": _group(url, r"^[^?#]*\?([^#]*)"),
    }
    database = F.ltrim(F.coalesce(parts["path"], F.lit("")), F.lit("/"))
    checks = [
        (parts["scheme"].isNull(), "invalid_url"),
        (parts["host"].isNull(), "missing_host"),
        (parts["port"].isNull(), "missing_port"),
        (parts["user"].isNull(), "missing_user"),
        (parts["password"].isNull(), "missing_password"),
        (database == "", "missing_path"),
    ]
    if scheme is not None:
        checks.insert(1, (parts["scheme"] != scheme, "wrong_scheme"))
    error = F.coalesce(*(F.when(bad, F.lit(name)) for bad, name in checks))
    return F.struct(*(c.alias(n) for n, c in parts.items()), error.alias("error"))
