"""Text functions of the resolver, as column expressions wherever Spark has the semantics."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit words of the administrative levels, as they stand before a name, in order of preference.
WARD_LEVELS = ["phường", "xã", "thị trấn"]
DISTRICT_LEVELS = ["thị xã", "thành phố", "huyện", "quận"]
PROVINCE_LEVELS = ["thành phố", "tỉnh"]

_STRIP = r"(?U)^\s+|\s+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it (also inside its own lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_total(sizes: Column) -> Column:
    """An array as long as `sizes` of the sums of all numbers before each place.

    From sums over blocks of 128 places, as a fold that appends to an array would copy it at every step.
    """
    total = lambda numbers: F.aggregate(numbers, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / 128).cast("int")), lambda b: total(F.slice(sizes, b * 128 + 1, 128)))

    def before(sums: Column) -> Column:
        return let(F.transform(sums, lambda x, i: total(F.slice(sums, F.lit(1), i))), lambda starts: F.transform(sizes, lambda x, i: F.get(starts, F.floor(i / 128).cast("int")) + total(F.slice(sizes, F.floor(i / 128).cast("int") * 128 + 1, i % 128))))

    return F.when(F.size(sizes) > 0, let(blocks, before))


def normalized(c: Column) -> Column:
    """Lower case, no Unicode white space at the ends, runs of U+0020 (only) as one."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), _STRIP, ""), " +", " ")


def normalize_strings(df: DataFrame) -> DataFrame:
    """Every string column normalised, the others as they are."""
    return df.select([normalized(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`") for f in df.schema.fields])


def strip_prefix(c: Column, levels: list[str], ignore_case: bool = True) -> Column:
    """Without one leading unit word and its space, in any case of letters (Unicode: Java's (?i) alone is ASCII) or as given."""
    return F.regexp_replace(c, ("(?iu)" if ignore_case else "") + "^(?:" + "|".join(f"{x} " for x in levels) + ")", "")


def level_of(c: Column, levels: list[str]) -> Column:
    """The first of the unit words that stands anywhere in the text; null if none does."""
    out = F.lit(None).cast("string")
    for x in reversed(levels):
        out = F.when(c.rlike(f"(?iu){x}"), F.lit(x)).otherwise(out)
    return out


def first_match(c: Column, pattern: str, ignore_case: bool = True) -> Column:
    """The first match of a pattern, or null."""
    return F.nullif(F.regexp_extract(c, ("(?iu)" if ignore_case else "") + pattern, 0), F.lit(""))


def _unaccented(s: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", s.replace("đ", "d").replace("Đ", "D")) if not unicodedata.combining(x))


#: The Hangul syllables are laid out by rule: 28 for each of 21 vowels, for each of 19 leading consonants.
_HANGUL, _VOWELS, _TAILS = 0xAC00, 21, 28


class _Table(NamedTuple):
    single: str  # characters that become one other character, and then those that go
    to: str
    several: str  # characters that become several
    becoming: tuple[str, ...]
    pattern: str  # one of several or a Hangul syllable, or a stretch of others


@cache
def _table() -> _Table:
    """What each character becomes, from the rule of _unaccented(), but for Hangul syllables."""
    one, gone, more = {}, [], {}
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)]):
        # What has no decomposition and isn't a combining character stays as it is, but for đ and Đ.
        if _HANGUL <= ord(c) <= 0xD7A3 or not (unicodedata.decomposition(c) or unicodedata.combining(c) or c in "đĐ"):
            continue
        plain = _unaccented(c)
        if plain == "":
            gone.append(c)
        elif len(plain) > 1:
            more[c] = plain
        elif plain != c:
            one[c] = plain
    codes, ranges = sorted([*map(ord, more), *range(_HANGUL, 0xD7A4)]), []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    several = "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in ranges)
    return _Table("".join([*one, *gone]), "".join(one.values()), "".join(more), tuple(more.values()), f"[{several}]|[^{several}]+")


def _decomposed(c: Column) -> Column:
    """What one character of those that become several becomes; anything else as it is."""
    t = _table()
    code = F.ascii(c) - _HANGUL
    letter = lambda first, i: F.substring(F.lit("".join(map(chr, range(first, first + 30)))), i.cast("int") + 1, F.lit(1))
    tail = F.when(code % _TAILS > 0, letter(0x11A7, code % _TAILS)).otherwise(F.lit(""))
    syllable = F.concat(letter(0x1100, F.floor(code / (_VOWELS * _TAILS))), letter(0x1161, F.floor(code / _TAILS) % _VOWELS), tail)
    at = F.when(F.length(c) == 1, F.instr(F.lit(t.several), c)).otherwise(F.lit(0))
    # The values as one constant, which is split once.
    values = F.split(F.lit("\x01".join(t.becoming)), "\x01")
    return F.when((F.length(c) == 1) & code.between(0, 0xD7A3 - _HANGUL), syllable).when(at > 0, F.get(values, at - 1)).otherwise(c)


def remove_accents(c: Column | str) -> Column:
    """đ to d, then NFKD without combining characters, by Spark's own functions.

    What becomes one character (or none) is mapped by one translation; texts with characters that become several, such as
    ligatures, are cut at these, Hangul syllables are taken apart by their layout.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = _table()
    several = t.pattern.split("|")[0]
    cut = F.regexp_extract_all(c, F.lit(t.pattern), F.lit(0))
    whole = F.when(c.rlike(several), F.array_join(F.transform(cut, _decomposed), "")).otherwise(c)
    return F.translate(whole, t.single, t.to)
