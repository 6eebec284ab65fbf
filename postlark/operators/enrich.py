"""Contacts of the page a post links to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.functions.contacts import emails, phones
from postlark.operators.joins import count_rows, lookup


def page_contacts(pages: DataFrame, html: str = "html", *keys: str) -> DataFrame:
    """(keys, phone, email) as arrays; the page text itself goes no further."""
    return pages.select(*keys, phones(F.col(html)).alias("phone"), emails(F.col(html)).alias("email"))


def with_page_contacts(
    posts: DataFrame, pages: DataFrame, link: str = "link", spread: str = "id"
) -> DataFrame:
    """Left join of posts to the contacts of the linked page.

    Contacts are parsed before the join, so no html is shuffled. ``pages`` has one row per url. A
    link shared by much of the posts is spread over tasks; posts without a link never match.
    """
    contacts = page_contacts(pages, "html", "url").withColumnRenamed("url", link)
    return lookup(posts, contacts, [link], [spread], count_rows(posts, [link]))
