"""Text rules: trimming, name normalisation and geographic codes, as JVM-side expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that counts as whitespace, built from the Unicode property.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_ASCII_SPACE_RUN = r"[\s\x1c-\x1f]+"


def trim_ws(c: Column) -> Column:
    """Trim Unicode whitespace; plain ``trim`` would leave tabs and no-break blanks.

    Trimming a set of characters costs five times a plain trim, so it only runs where plain
    trimming leaves something other than a visible ASCII character at either end.
    """
    plain = F.trim(c)
    last = F.substring(plain, -1, 1)
    done = (plain >= "!") & (plain < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(done, plain).otherwise(F.trim(c, F.lit(WHITESPACE)))


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trim_all(df: DataFrame) -> DataFrame:
    """Trim header names and every value; columns that no one reads are pruned later."""
    return df.select(
        [trim_ws(F.col(f"`{name}`")).alias(name.strip()) for name in df.columns]
    )


def _base_letters(char: str) -> str:
    return "".join(
        d for d in unicodedata.normalize("NFKD", char) if not unicodedata.combining(d)
    )


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, str]:
    """(characters to replace, their one-letter bases then nothing for marks, expanding characters).

    Built from the Unicode database: a compatibility decomposition without combining marks
    either is one letter, vanishes (a mark itself), or expands to several letters.
    """
    single, bases, marks, expanding = [], [], [], []
    # Planes from 3 on hold neither decompositions nor combining marks.
    for char in map(chr, range(0x80, 0x30000)):
        if "\ud800" <= char <= "\udfff":
            continue
        folded = _base_letters(char)
        if folded == char:
            continue
        if not folded:
            marks.append(char)
        elif len(folded) == 1:
            single.append(char)
            bases.append(folded)
        else:
            expanding.append(char)
    return "".join(single + marks), "".join(bases), "".join(expanding)


def _ranges(chars: str) -> str:
    """A regex character class over code points, as ranges."""
    codes = sorted(map(ord, chars))
    parts, start = [], codes[0]
    for prev, code in zip(codes, codes[1:] + [None]):
        if code != prev + 1:
            parts.append(rf"\x{{{start:X}}}-\x{{{prev:X}}}")
            start = code
    return "[" + "".join(parts) + "]"


def normalize_name(c: Column) -> Column:
    """Upper case, trimmed, without accents, with single blanks; null gives ''.

    Runs in the JVM only. Characters whose decomposition has several letters (ligatures,
    fractions, Hangul) are kept as they are; ``normalize_name_exact`` expands those too.
    """
    replace, bases, _ = _folding()
    base = trim_ws(F.upper(null_to_empty(c)))
    ascii_only = F.octet_length(base) == F.length(base)
    folded = F.when(ascii_only, base).otherwise(F.translate(base, replace, bases))
    return F.regexp_replace(folded, _SPACE_RUN, " ")


_SYLLABLES = (0xAC00, 0xD7A3)


def _syllables_apart(c: Column) -> Column:
    """Hangul syllables by their letters, which follow from the code point."""
    def part(first: int, count: int, number: Column) -> Column:
        signs = "".join(map(chr, range(first, first + count)))
        return F.substr(F.lit(signs), number.cast("int") + 1, F.lit(1))

    def letters(char: Column) -> Column:
        n = F.ascii(char) - _SYLLABLES[0]
        last = F.when(n % 28 > 0, part(0x11A8, 27, n % 28 - 1)).otherwise(F.lit(""))
        syllable = F.concat(
            part(0x1100, 19, F.floor(n / 588)), part(0x1161, 21, F.floor(n % 588 / 28)), last)
        return F.when(n.between(0, _SYLLABLES[1] - _SYLLABLES[0]), syllable).otherwise(char)

    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    return F.array_join(F.transform(chars, letters), "")


def _let(value: Column, result: Callable[[Column], Column]) -> Column:
    """The result for a value that is made once, however often the result names it."""
    return F.element_at(F.transform(F.array(value), result), 1)


def _beyond_ascii(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x7F]+", "")


def _expand(c: Column, beyond: Column) -> Column:
    """Each expanding character by its letters. Those that a text holds are looked for among its few
    characters ``beyond`` ASCII, looked up once each and replaced everywhere."""
    others = [x for x in _folding()[2] if not _SYLLABLES[0] <= ord(x) <= _SYLLABLES[1]]
    pairs = "\x01".join(f"{x}\x02{_base_letters(x)}" for x in others)
    known = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    found = F.array_distinct(
        F.regexp_extract_all(beyond, F.lit(_ranges("".join(others))), F.lit(0)))
    # No letters of one hold another, so the order does not matter.
    replaced = F.aggregate(
        found, c, lambda text, x: F.replace(text, x, F.coalesce(F.try_element_at(known, x), x)))
    syllables = beyond.rlike(r"[\x{AC00}-\x{D7A3}]")
    return F.when(syllables, _syllables_apart(replaced)).otherwise(replaced)


def normalize_name_exact(c: Column) -> Column:
    """``normalize_name`` for any script. ASCII text meets no rule for other characters, and only
    names with expanding characters are looked through for them."""
    replace, bases, expanding = _folding()

    def unfolded(text: Column, beyond: Column) -> Column:
        expands = F.length(F.translate(beyond, expanding, "")) < F.length(beyond)
        return F.when(expands, _expand(text, beyond)).otherwise(text)

    upper = F.upper(null_to_empty(c))
    letters = _let(upper, lambda u: _let(trim_ws(u), lambda text: _let(
        _beyond_ascii(text), lambda beyond: unfolded(text, beyond))))
    base = trim_ws(upper)
    ascii_only = F.octet_length(base) == F.length(base)
    return F.when(ascii_only, F.regexp_replace(base, _ASCII_SPACE_RUN, " ")).otherwise(
        F.regexp_replace(F.translate(letters, replace, bases), _SPACE_RUN, " "))


def normalize_geo_code(c: Column) -> Column:
    """Digits only, left-padded to six; '' stays '' and longer codes stay longer."""
    digits = F.regexp_replace(null_to_empty(c), r"(?U)\D", "")
    short = (digits != "") & (F.length(digits) < 6)
    return F.when(short, F.lpad(digits, 6, "0")).otherwise(digits)


def is_six_digits(c: Column) -> Column:
    return c.rlike(r"(?U)\A\d{6}\z")


def columns_containing(df: DataFrame, *words: str) -> list[str]:
    """Names of the columns that contain one of the words, whatever the case."""
    return [name for name in df.columns if any(w.upper() in name.upper() for w in words)]
