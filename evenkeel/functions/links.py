"""Column expressions over links: normal form, website, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions import patterns as P


def strip_scheme(url: Column) -> Column:
    return F.regexp_replace(url, P.RX_SCHEME, "")


def www_link(link: Column) -> Column:
    """The link with a leading `www.`; case-sensitive, null stays null."""
    return F.when(link.startswith("www."), link).otherwise(F.concat(F.lit("www."), link))


def website_of(link: Column, strict_host: bool = False) -> Column:
    """Website of a link, null when there is none.

    The default runs to the last suffix followed by a slash, so a path such as
    `/x/b.php/y` is part of the website. `strict_host` stops at the host.
    """
    pattern = P.RX_WEBSITE_STRICT if strict_host else P.RX_WEBSITE
    return F.nullif(F.regexp_extract(link, pattern, 0), F.lit(""))


def link_hash(link: Column) -> Column:
    """Key of a link: join key and file stem, stable across versions."""
    return F.sha2(link, 256)


def fetch_url(link: Column) -> Column:
    return F.concat(F.lit(P.FETCH_SCHEME), link)


def page_file(key: Column) -> Column:
    return F.concat(key, F.lit(P.PAGE_SUFFIX))


def legacy_file(link: Column) -> Column:
    """File name under the old scheme: md5 of the fetch URL."""
    return page_file(F.md5(fetch_url(link)))


def file_stem(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*)\.html$", 1)
