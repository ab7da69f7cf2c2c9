"""Links of web pages held in a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions.links import has_class, has_href, href, tag_name, tags

#: Found links are gathered in parts of this many bytes, so that adding one copies few others.
_PART = 4096
# Digits of a number in the bytes of a state. Bytes are passed on as they are, where the
# elements of an array would be copied with each tag.
_DIGITS = 8

# What a tag means, as bits: the container begins; an element of the container's kind, a
# list or an item opens or closes; an anchor with a link.
_BEGINS, _OPENS, _CLOSES, _LIST, _LIST_END, _ITEM, _ITEM_END, _ANCHOR = (1 << i for i in range(8))

# One open element in the upper half of a number, one tag read in the lower.
_ONE = 1 << 32


def extract_links(
    pages: DataFrame,
    tag: str,
    css_class: str | None = None,
    key: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """One row per list item with a link: page key, item position, ``href``.

    Reads the first ``ul`` of the page's first container: the first ``tag`` element,
    of class ``css_class`` if one is given. Items of lists nested in the list are items
    too, after the item that holds them; an item's link is its first anchor with a
    ``href``. Positions count all items, also those without a link, which give no row.

    The tags of the four kinds that matter are folded in the page's own row. A count of
    open elements says where the container and its list end; over the list's tags, the
    open items without a link wait for the next anchor. Nothing is shuffled, a page is
    read once, and the rows that come out are the links.
    """
    tag = tag.lower()


    def links(found: Column) -> Column:
        events = F.transform(found, lambda t, at: _event(t, at, tag, css_class))
        inside = _with(events, lambda e: _element(e, _BEGINS, _OPENS, _CLOSES))
        listed = _with(inside, lambda e: _element(e, _LIST, _LIST, _LIST_END))
        parts = F.aggregate(listed, _start(), _step, lambda end: F.concat(end["full"], F.array(end["part"])))
        return F.flatten(F.transform(parts, lambda part: _links(part, found)))

    found = tags(F.col(html), [tag, "ul", "li", "a"])
    return pages.select(F.col(key), F.inline(_with(found, links))).select(key, "pos", href(F.col("tag")).alias("href"))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _event(tag: Column, at: Column, container: str, css_class: str | None) -> Column:
    """The meaning of a tag, and where it stands among the tags."""

    def of(name: Column) -> Column:
        opens = ~F.startswith(tag, F.lit("</"))
        either = lambda kind, yes, no: F.when(name != kind, 0).when(opens, yes).otherwise(no)
        begins = F.when((name != container) | ~opens, 0).when(has_class(tag, container, css_class), _BEGINS).otherwise(0)
        link = F.when((name != "a") | ~opens, 0).when(has_href(tag), _ANCHOR).otherwise(0)
        code = begins + either(container, _OPENS, _CLOSES) + either("ul", _LIST, _LIST_END) + either("li", _ITEM, _ITEM_END) + link
        return F.struct(code.alias("code"), at.alias("at"))

    return _with(tag_name(tag), of)


def _is(event: Column, bit: int) -> Column:
    return event["code"].bitwiseAND(bit) != 0


def _element(events: Column, first: int, opens: int, closes: int) -> Column:
    """The events between the first opening tag of that meaning and the end of its element."""

    def behind(begin: Column) -> Column:
        return F.slice(events, begin + 1, F.when(begin > 0, F.size(events)).otherwise(0))

    def step(state: Column, event: Column) -> Column:
        read = state + F.when(_is(event, opens), _ONE + 1).when(_is(event, closes), 1 - _ONE).otherwise(F.lit(1).cast("long"))
        # Negative: as many tags were read until the count of open elements fell to none.
        return F.when(state < 0, state).when(read < _ONE, -read).otherwise(read)

    def within(rest: Column) -> Column:
        end = F.aggregate(rest, F.lit(_ONE).cast("long"), step)
        return _with(end, lambda n: F.when(n < 0, F.slice(rest, F.lit(1), (-n - 1).cast("int"))).otherwise(rest))

    flags = F.transform(events, lambda e: e["code"].bitwiseAND(first))
    return _with(_with(F.array_position(flags, first).cast("int"), behind), within)


def _digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), _DIGITS, "0").cast("binary")


def _number(data: Column, nth: Column) -> Column:
    """The nth number among digits, counted from 0."""
    return F.substring(data, nth * _DIGITS + 1, F.lit(_DIGITS)).cast("string").cast("int")


def _count(data: Column) -> Column:
    return (F.length(data) / _DIGITS).cast("int")


def _start() -> Column:
    return F.struct(
        F.lit(-1).alias("pos"),
        F.lit(b"").alias("waiting"),  # positions of open items without a link, outermost first
        F.lit(b"").alias("part"),  # position and place of the anchor, for each item with a link
        F.array().cast("array<binary>").alias("full"),
    )


def _step(state: Column, event: Column) -> Column:
    """The state after a tag of the list: an item opens or closes, or an anchor serves who waits."""
    pos, waiting, part, full = (state[c] for c in ("pos", "waiting", "part", "full"))

    def made(pos: Column, waiting: Column, part: Column, full: Column) -> Column:
        return F.struct(pos.alias("pos"), waiting.alias("waiting"), part.alias("part"), full.alias("full"))

    opened = made(pos + 1, F.concat(waiting, _digits(pos + 1)), part, full)
    # The innermost open item closes. One that has its link does not wait any more.
    closed = made(pos, F.substring(waiting, F.lit(1), F.length(waiting) - _DIGITS), part, full)

    def each(i: Column) -> Column:
        return F.concat(_digits(_number(waiting, i)), _digits(event["at"])).cast("string")

    def linked(served: Column) -> Column:
        many = F.length(part) >= _PART
        return made(
            pos, F.lit(b""), F.when(many, served).otherwise(F.concat(part, served)),
            F.when(many, F.concat(full, F.array(part))).otherwise(full),
        )

    several = F.array_join(F.transform(F.sequence(F.lit(0), _count(waiting) - 1), each), "").cast("binary")
    served = F.when(F.length(waiting) == _DIGITS, F.concat(waiting, _digits(event["at"]))).otherwise(several)
    waits = F.length(waiting) > 0
    return (
        F.when(_is(event, _ITEM), opened)
        .when(_is(event, _ITEM_END) & waits, closed)
        .when(_is(event, _ANCHOR) & waits, _with(served, linked))
        .otherwise(state)
    )


def _links(part: Column, found: Column) -> Column:
    """Positions of items and the tags of their links."""

    def link(i: Column) -> Column:
        return F.struct(_number(part, 2 * i).alias("pos"), F.get(found, _number(part, 2 * i + 1)).alias("tag"))

    return F.transform(F.slice(F.sequence(F.lit(0), _count(part)), F.lit(1), (_count(part) / 2).cast("int")), link)
