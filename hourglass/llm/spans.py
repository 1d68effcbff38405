"""Matches and spans of a text as arrays, in DataFrame functions only.

Everything here takes time near the text's length and the number of its
matches.  A fold copies what it has gathered at every step, so none of these
gathers a list: running sums and maxima come from a tree of ``FAN``-fold
blocks, whose folds hold one number each.  A text is cut through blocks of
``TEXT_BLOCK`` characters, since taking characters from the middle of a long
string walks from its start.

Offsets are code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FAN, TEXT_BLOCK = 32, 1024
NONE = "cast(array() as array<int>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.aggregate(F.expr(NONE), value, lambda held, _: held, body)


def before(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each of the integers what ``combine`` makes of those before it."""
    def over(level: Column, first: Column, end: Column, start: Column) -> Column:
        some = F.sequence(first, F.greatest(end - 1, first))
        return F.when(end > first, F.aggregate(some, start, lambda held, i: combine(held, F.get(level, i)))).otherwise(start)

    def up(level: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int"))
        return F.transform(blocks, lambda b: over(level, b * FAN, F.least((b + 1) * FAN, F.size(level)), F.lit(zero)))

    def down(level: Column, starts: Column) -> Column:
        block = lambda i: F.floor(i / FAN).cast("int")
        return F.transform(level, lambda _, i: over(level, block(i) * FAN, i, F.get(starts, block(i))))

    def top(level: Column) -> Column:
        return F.transform(level, lambda _, i: over(level, F.lit(0), i, F.lit(zero)))

    made = let(values, lambda a: let(up(a), lambda b: let(up(b), lambda c: let(top(c), lambda z: let(down(b, z), lambda y: down(a, y))))))
    return F.when(F.size(values) > 0, made).otherwise(F.expr(NONE))


def largest_before(values: Column) -> Column:
    return before(values, lambda a, b: F.greatest(a, b), -1)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """array<struct<start, value, part>> of the pattern's matches, leftmost
    and without overlap; ``part`` is the group's text, if one is asked for."""
    item = "struct<start:int,value:string,part:string>"

    def located(found: Column) -> Column:
        pieces, parts = F.split(text, pattern, -1), found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        zipped = F.slice(F.arrays_zip(pieces.alias("piece"), found.alias("value"), parts.alias("part")), F.lit(1), F.size(found))
        sized = F.transform(zipped.cast("array<struct<piece:string,value:string,part:string>>"), lambda x: F.struct(
            F.char_length(x["piece"]).alias("gap"), F.char_length(x["value"]).alias("length"), x["value"].alias("value"), x["part"].alias("part")))

        def placed(held: Column) -> Column:
            ends = before(F.transform(held, lambda x: x["gap"] + x["length"]), lambda a, b: a + b, 0)
            return let(ends, lambda at: F.transform(held, lambda x, i: F.struct(
                (F.get(at, i) + x["gap"]).alias("start"), x["value"].alias("value"), x["part"].alias("part"))))

        return F.when(F.size(found) > 0, let(sized, placed)).otherwise(F.expr(f"cast(array() as array<{item}>)"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def end_of(match: Column) -> Column:
    return match["start"] + F.char_length(match["value"])


def text_blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}+"), F.lit(0))


def piece(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text in blocks."""
    def part(k: Column) -> Column:
        at = F.greatest(start - k * TEXT_BLOCK, F.lit(0))
        return F.substring(F.get(blocks, k), at + 1, F.least(end - k * TEXT_BLOCK, F.lit(TEXT_BLOCK)) - at)

    over = F.sequence(F.floor(start / TEXT_BLOCK).cast("int"), F.floor((end - 1) / TEXT_BLOCK).cast("int"))
    return F.when(end > start, F.array_join(F.transform(over, part), "")).otherwise(F.lit(""))


def runs(spans: Column, kind_of: Callable[[Column], Column]) -> Column:
    """array<struct<start, end, kind>>: the maximal runs of overlapping spans,
    which come by start, each with the kind of its first span."""
    def joined(held: Column) -> Column:
        own, reach = held["spans"], held["reach"]
        first = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: F.get(own, i)["start"] >= F.get(reach, i))

        def each(at: Column) -> Column:
            last = lambda k: F.coalesce(F.get(at, k + 1), F.size(own)) - 1
            return F.transform(at, lambda i, k: F.struct(
                F.get(own, i)["start"].alias("start"), F.greatest(F.get(reach, last(k)), F.get(own, last(k))["end"]).alias("end"),
                kind_of(F.get(own, i)).alias("kind")))

        return let(first, each)

    reach = largest_before(F.transform(spans, lambda s: s["end"]))
    return F.when(F.size(spans) > 0, let(F.struct(spans.alias("spans"), reach.alias("reach")), joined))


def gaps(text: Column, found: Column) -> Column:
    """The texts before, between and behind the runs ``found``."""
    def cut(held: Column) -> Column:
        n = F.size(held["runs"])
        start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(held["runs"], k - 1)["end"])
        end = lambda k: F.when(k == n, held["length"]).otherwise(F.get(held["runs"], k)["start"])
        return F.transform(F.sequence(F.lit(0), n), lambda k: piece(held["blocks"], start(k), end(k)))

    return let(F.struct(found.alias("runs"), text_blocks(text).alias("blocks"), F.char_length(text).alias("length")), cut)


def replaced(text: Column, found: Column) -> Column:
    """The text with each run replaced by its kind."""
    def build(held: Column) -> Column:
        kinds = F.transform(held["runs"], lambda r: r["kind"])
        zipped = F.arrays_zip(held["gaps"].alias("gap"), kinds.alias("mark")).cast("array<struct<gap:string,mark:string>>")
        return F.array_join(F.transform(zipped, lambda x: F.concat(x["gap"], F.coalesce(x["mark"], F.lit("")))), "")

    return F.when(F.size(found) > 0, let(found, lambda own: let(F.struct(own.alias("runs"), gaps(text, own).alias("gaps")), build))).otherwise(text)


def beside(base: Column, added: Column, covered_only: bool, item: str) -> Column:
    """Of ``added`` those that no span of ``base`` meets, or, with
    ``covered_only``, that no single one covers.  ``item``: their type, with
    start and end.  By start, the base spans before one reach furthest where
    their largest end is, and the base span behind it begins nearest."""
    tagged = lambda spans, own: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s.alias("span"))).cast(f"array<{row}>")
    row = f"struct<start:int,own:int,end:int,span:{item}>"
    both = F.array_sort(F.concat(tagged(base, 0), tagged(added, 1)))

    def chosen(held: Column) -> Column:
        rows, n = held["rows"], F.size(held["rows"])

        def free(s: Column, i: Column) -> Column:
            if covered_only:
                return F.get(held["reach"], i) < s["end"]
            return (F.get(held["reach"], i) <= s["start"]) & (-F.get(held["next"], n - 1 - i) >= s["end"])

        return F.transform(F.filter(rows, lambda s, i: (s["own"] == 1) & free(s, i)), lambda s: s["span"])

    def bounds(rows: Column) -> Column:
        reach = largest_before(F.transform(rows, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(-1)))
        later = before(F.transform(F.reverse(rows), lambda s: F.when(s["own"] == 0, -s["start"]).otherwise(-(1 << 30))),
                       lambda a, b: F.greatest(a, b), -(1 << 30))
        return let(F.struct(rows.alias("rows"), reach.alias("reach"), later.alias("next")), chosen)

    return F.when(F.size(added) > 0, let(both, bounds)).otherwise(F.expr(f"cast(array() as array<{item}>)"))
