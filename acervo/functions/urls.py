"""URL expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def domain(url: Column) -> Column:
    """Lower-case host (port kept) without a leading `www.`; bad URL gives empty text."""
    return F.coalesce(
        F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), r"^www\.", ""), F.lit("")
    )


def domain_or_unknown(url: Column) -> Column:
    found = domain(url)
    return F.when(found == "", F.lit("desconhecido")).otherwise(found)


def root(url: Column) -> Column:
    """`scheme://host`, empty text where there is no host."""
    host = F.try_parse_url(url, F.lit("AUTHORITY"))
    scheme = F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit(""))
    return F.when(host.isNotNull(), F.concat(scheme, F.lit("://"), host)).otherwise(F.lit(""))


@F.pandas_udf(T.StringType())
def absolute(base: pd.Series, href: pd.Series) -> pd.Series:
    """RFC 3986 join, in Arrow batches."""
    from urllib.parse import urljoin

    def join(b: str | None, h: str | None) -> str | None:
        if h is None:
            return None
        try:
            return urljoin(b or "", h)
        except ValueError:
            return None

    return pd.Series([join(b, h) for b, h in zip(base, href)], dtype="object")


def is_navigable(href: Column) -> Column:
    return (href != "") & ~href.rlike("^(#|javascript:|mailto:|tel:)")


def is_pdf(href: Column) -> Column:
    return F.lower(href).endswith(".pdf")


def file_title(url: Column) -> Column:
    """Title from a file name: decoded, without `.pdf`, dashes and underscores as blanks."""
    name = F.element_at(F.split(url, "/"), -1)
    # a plus sign is literal in a path, unlike in a form
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.translate(F.regexp_replace(decoded, r"(?i)\.pdf$", ""), "-_", "  ")
