"""Column functions on strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character references resolved by html_text, "&amp;" last so nothing is resolved twice.
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def join_path(folder: Column, name: Column) -> Column:
    return F.concat(folder, F.lit("/"), name)


def output_name(path: Column, source_ext: str = ".pdf", target_ext: str = ".txt") -> Column:
    """Name of the text file made from a source file: every source extension in the base name is replaced."""
    return F.replace(base_name(path), F.lit(source_ext), F.lit(target_ext))


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    """Split on a literal separator, keeping empty pieces."""
    return F.split(text, "\\Q" + separator + "\\E", -1)


def split_list(text: Column, empty_as_null: bool = False) -> Column:
    """Comma text to a list; an empty text gives ``[""]``, or null with ``empty_as_null``."""
    parts = F.split(text, ",", -1)
    return F.when(text != "", parts) if empty_as_null else parts


def digest(text: Column) -> Column:
    return F.md5(text)


def html_text(html: Column) -> Column:
    """Visible text of markup: scripts, styles, comments and tags removed, references resolved."""
    text = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, "<[^>]*>", " ")
    for reference, character in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return F.trim(F.regexp_replace(text, "[ \\t\\r\\n\\f]+", " "))


def csv_fields(line: Column) -> Column:
    """Comma-separated fields without surrounding blanks."""
    return F.transform(F.split(line, ",", -1), lambda f: F.trim(f))


def digits(text: Column) -> Column:
    """Keep the digits only, for values printed with a unit."""
    return F.regexp_replace(text, "[^0-9]", "")
