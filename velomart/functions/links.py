"""Tags of a page, what their attributes say, and character references."""

from __future__ import annotations

import html.entities
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that holds no markup of the page itself.
_OPAQUE = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
)

# Inside a tag, a closing angle bracket may stand in a quoted value. Possessive, so
# that long pages are matched without backtracking.
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_REST_OF_TAG = rf"(?:[^>=]++|=\s*+{_QUOTED}?+)*+>"
_ATTRIBUTE = rf"[^\s=/>]++(?:\s*+=\s*+(?:{_QUOTED}|[^\s>]++))?+"

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*+(?:;|(?![=;])))"


def _up_to(tag: str, attribute: str) -> str:
    """Pattern of an opening tag up to the value of its first such attribute."""
    return (
        rf"(?is)^<{re.escape(tag)}(?:[\s/]++(?!{attribute}\s*=){_ATTRIBUTE})*+"
        rf"[\s/]++{attribute}\s*=\s*"
    )


_HREF = _up_to("a", "href") + r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def tags(page: Column, names: list[str]) -> Column:
    """Opening and closing tags of these names, in order, as they are written."""
    either = "|".join(re.escape(n) for n in sorted(set(names)))
    pattern = rf"(?is)</?(?:{either})(?=[\s/>]){_REST_OF_TAG}"
    return F.regexp_extract_all(
        F.regexp_replace(page, _OPAQUE, ""), F.lit(pattern), F.lit(0)
    )


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^</?([^\s/>]+)", 1))


def has_class(tag: Column, name: str, css_class: str | None) -> Column:
    """Whether an opening tag has the class: one among several, or several in that order.

    Without a class any tag of the name will do.
    """
    if css_class is None:
        return F.lit(True)
    several = [re.escape(c) for c in css_class.split()]
    quoted, bare = r"\s+".join(several), r"(?!)"
    if len(several) == 1:
        bare = quoted + r"(?=[\s>])"
        quoted = rf"(?:[^\"']*\s)?{quoted}(?:\s[^\"']*)?"
    value = rf"""(?:"\s*{quoted}\s*"|'\s*{quoted}\s*'|{bare})"""
    return F.rlike(tag, F.lit(_up_to(name, "class") + value))


def has_href(tag: Column) -> Column:
    return F.rlike(tag, F.lit(_HREF))


def href(tag: Column) -> Column:
    """``href`` of an anchor that has one, with its character references resolved."""
    return resolve_references(
        F.concat(*(F.regexp_extract(tag, _HREF, g) for g in (1, 2, 3)))
    )


def resolve_references(text: Column) -> Column:
    """The text of an attribute with named and numeric character references resolved.

    A name without a semicolon counts where neither a letter, a digit nor an equals
    sign follows. Numbers that are no character give the replacement character.
    """
    names = F.from_json(
        F.lit(json.dumps(html.entities.html5)), "map<string,string>"
    )
    parts = F.regexp_extract_all(text, F.lit(rf"{_REFERENCE}|[^&]++|&"), F.lit(0))

    def resolved(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#[xX]?([0-9a-fA-F]+)", 1)
        base = F.when(F.rlike(part, F.lit("^&#[xX]")), 16).otherwise(10)
        # Eight digits hold every character; what is longer is none.
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        in_hex = F.when(base == 16, F.conv(short, 16, 16)).otherwise(F.conv(short, 10, 16))
        in_hex = F.when(F.length(short) <= 8, in_hex).otherwise(F.lit("FFFFFFFF"))
        return (
            F.when(F.startswith(part, F.lit("&#")), _character(in_hex))
            .when(F.startswith(part, F.lit("&")), F.coalesce(names[F.substring(part, 2, 64)], part))
            .otherwise(part)
        )

    whole = F.array_join(F.transform(parts, resolved), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def _character(in_hex: Column) -> Column:
    """The character of a code point written in upper-case base 16 without leading zeros.

    By the rules of HTML the codes 80 to 9F, in base 16, stand for those of Windows-1252.
    """
    moved = {f"{i:X}": bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)}
    moved = F.from_json(F.lit(json.dumps(moved)), "map<string,string>")
    none = F.rlike(in_hex, F.lit("^(0|D[89A-F][0-9A-F]{2}|1[1-9A-F][0-9A-F]{4}|[2-9A-F][0-9A-F]{5}|[0-9A-F]{7,})$"))
    plain = F.decode(F.unhex(F.lpad(in_hex, 8, "0")), "UTF-32")
    return F.when(none, F.lit("�")).otherwise(F.coalesce(moved[in_hex], plain))
