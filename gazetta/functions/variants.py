"""Spelling variants of area names, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may stand before a name for each level.
LEVEL_PREFIXES = {
    "phuong": ["p.", "p ", "p", "phuong "],
    "xa": ["xa ", "x.", "x "],
    "thi tran": ["thi tran ", "tt.", "tt "],
    "quan": ["quan ", "q.", "q ", "q"],
    "huyen": ["huyen ", "h.", "h "],
    "thi xa": ["thi xa ", "tx.", "tx "],
    "thanh pho": ["tp ", "tp.", "thanh pho "],
    "tinh": ["tinh ", "t.", "t "],
}
# Names with a further name of their own.
ALSO_NAMED = {"bac tu liem": ["tu liem", "tl"], "nam tu liem": ["tu liem", "tl"]}
#: Fixed value: names of more words are worth a warning.
LONGEST = 5


def _none() -> Column:
    return F.array().cast("array<string>")


def name_variants(name: Column, shorten: Column | bool) -> Column:
    """Distinct spellings of a name; by its words: joined, spaced and, if shortened, with initials."""
    w = F.split(F.lower(name), " ")
    a, b, c = (F.get(w, F.lit(i)) for i in range(3))
    a1, b1, c1, a2, b2 = F.left(a, F.lit(1)), F.left(b, F.lit(1)), F.left(c, F.lit(1)), F.left(a, F.lit(2)), F.left(b, F.lit(2))
    cat, sp, dot = F.concat, F.lit(" "), F.lit(".")
    if_short = lambda spelled: F.when(F.lit(shorten) if isinstance(shorten, bool) else shorten, spelled).otherwise(_none())
    longer = F.when(F.length(a) > 2, F.array(cat(a2, dot, b), cat(a2, sp, b))).otherwise(_none())
    two = cat(F.array(cat(a, b), cat(a, sp, b)), if_short(cat(F.array(cat(a1, b1), cat(a1, b), cat(a1, b2), cat(a1, dot, b), cat(a1, dot, b2)), longer)))
    three = cat(F.array(cat(a, sp, b, sp, c)), if_short(F.array(cat(a1, b1, c1))))
    also = _none()
    for known, others in ALSO_NAMED.items():
        also = F.when(name == known, F.array(*map(F.lit, others))).otherwise(also)
    by_words = F.when(F.size(w) == 1, F.array(a)).when(F.size(w) == 2, two).when(F.size(w) == 3, three).otherwise(_none())
    return F.array_distinct(cat(F.array(name), by_words, also))


def level_prefixes(level: Column) -> Column:
    out = _none()
    for known, prefixes in LEVEL_PREFIXES.items():
        out = F.when(level == known, F.array(*map(F.lit, prefixes))).otherwise(out)
    return out


def area_variants(name: Column, level: Column, shorten: Column | bool = True) -> Column:
    """Spellings of the name, and each of them behind each prefix of its level; an unknown level has none."""
    names = name_variants(name, shorten)
    prefixed = F.flatten(F.transform(level_prefixes(level), lambda p: F.transform(names, lambda n: F.concat(p, n))))
    return F.array_distinct(F.concat(names, prefixed))


def well_formed(name: Column) -> Column:
    """Whether a name has no empty word (double or outer spaces)."""
    return name.isNotNull() & ~F.exists(F.split(name, " "), lambda w: w == "")


def checked(name: Column) -> Column:
    """The name; one with an empty word is refused by an error, as its spellings would match nothing."""
    wrong = F.raise_error(F.concat(F.lit("a name has an empty word: "), name)).cast("string")
    return F.when(name.isNull() | well_formed(name), name).otherwise(wrong)


def long_name(name: Column) -> Column:
    """Whether a name has more words than there are rules for (it is then spelled as it stands)."""
    return F.size(F.split(name, " ")) > LONGEST
