"""Row predicates: Columns in, boolean Column out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page namespaces, file endings and titles that are not articles.
NAMESPACES = (
    "MediaWiki_talk", "MediaWiki", "Media", "Special", "Talk", "User_talk", "User",
    "Project_talk", "Project", "File_talk", "File", "Template_talk", "Template", "Help_talk",
    "Help", "Category_talk", "Category", "Portal", "Wikipedia_talk", "Wikipedia",
)
FILE_ENDINGS = ("jpg", "gif", "png", "JPG", "GIF", "PNG", "txt", "ico")
RESERVED_TITLES = ("404_error/", "Main_Page", "Hypertext_Transfer_Protocol", "Search")


def is_article(title: Column | str) -> Column:
    """Content pages only.  Plain string tests, so the predicate stays in generated code."""
    title = F.col(title) if isinstance(title, str) else title
    first = F.substring(title, 1, 1)
    in_namespace = title.contains(":") & F.substring_index(title, ":", 1).isin(*NAMESPACES)
    is_file = title.contains(".") & F.substring_index(title, ".", -1).isin(*FILE_ENDINGS)
    return (
        (title != "")
        & ~first.between("a", "z")
        & ~in_namespace
        & ~is_file
        & ~title.isin(*RESERVED_TITLES)
    )


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def whole_number(text: Column | str) -> Column:
    """Text as BIGINT, null when it is not an integer."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("bigint")
