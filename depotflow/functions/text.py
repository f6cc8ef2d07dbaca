"""Text expressions with case-insensitive matching and blank-padded comparison rules."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F, types as T

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def same_text(value: ColumnOrName, other: Column | str) -> Column:
    """Equality that ignores letter case and trailing blanks; a str ``other`` is a literal."""
    right = F.lit(other.rstrip().lower()) if isinstance(other, str) else F.lower(F.rtrim(other))
    return F.lower(F.rtrim(_col(value))) == right


def text_in(value: ColumnOrName, *options: str) -> Column:
    return F.lower(F.rtrim(_col(value))).isin([o.rstrip().lower() for o in options])


def comparable(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as a key: texts that differ in letter case or trailing blanks alone are equal."""
    return _comparable(F.col(name), df.schema[name].dataType)


def _comparable(value: Column, kind: T.DataType) -> Column:
    return F.lower(F.rtrim(value)) if isinstance(kind, T.StringType) else value


# Fixed value: letters follow German order, case and trailing blanks do not count.
GERMAN = "de_CI_RTRIM"


def text_between(value: ColumnOrName, low: str, high: str) -> Column:
    """Between two texts in German order, bounds included."""
    own = alphabetic(value)
    return (own >= F.collate(F.lit(low), GERMAN)) & (own <= F.collate(F.lit(high), GERMAN))


def _accented_within(low: str, high: str) -> str:
    """Accented letters sort right after their base letter, so a range of letters holds them too."""
    found = []
    for code in range(0xDF, 0x180):
        letter = chr(code)
        base = "s" if letter == "ß" else unicodedata.normalize("NFD", letter)[0]
        if base != letter and letter.islower() and low <= base < high:
            found.append(letter)
    return "".join(found)


def _class_regex(body: str) -> str:
    negated = body.startswith("^")
    if negated:
        body = body[1:]
    out = []
    position = 0
    while position < len(body):
        first = body[position]
        if position + 2 < len(body) and body[position + 1] == "-":
            last = body[position + 2]
            out.append(f"{re.escape(first)}-{re.escape(last)}")
            if first.isalpha() and last.isalpha():
                out.append(_accented_within(first.lower(), last.lower()))
            position += 3
        else:
            # Escape what a Java character class reads as syntax.
            out.append("\\" + first if first in "[]\\^-&" else first)
            position += 1
    return f"[{'^' if negated else ''}{''.join(out)}]"


def like_regex(pattern: str, escape: str | None = None) -> str:
    """Java regex for a LIKE pattern with ``%``, ``_``, ``[a-c]``, ``[abc]`` and ``[^abc]``."""
    out = []
    position = 0
    while position < len(pattern):
        letter = pattern[position]
        if escape and letter == escape and position + 1 < len(pattern):
            out.append(re.escape(pattern[position + 1]))
            position += 2
            continue
        if letter == "%":
            out.append(".*")
        elif letter == "_":
            out.append(".")
        elif letter == "[" and "]" in pattern[position + 1:]:
            end = pattern.index("]", position + 1)
            out.append(_class_regex(pattern[position + 1:end]))
            position = end
        else:
            out.append(re.escape(letter))
        position += 1
    return f"(?isu)^{''.join(out)}\\z"


def like(value: ColumnOrName, pattern: str, escape: str | None = None) -> Column:
    """Case-insensitive LIKE; plain patterns keep Spark's own LIKE and its prefix rewrites."""
    # Spark matches patterns in plain strings only; for those the cast is dropped.
    plain = _col(value).cast("string")
    if "[" in pattern:
        return plain.rlike(like_regex(pattern, escape))
    if escape:
        return F.like(F.lower(plain), F.lit(pattern.lower()), F.lit(escape.lower()))
    return F.lower(plain).like(pattern.lower().replace("\\", "\\\\"))


def alphabetic(value: ColumnOrName) -> Column:
    """Sort key in German order: letter case does not count, an umlaut follows its base letter."""
    return F.collate(_col(value).cast("string"), GERMAN)


def first_in_alphabet(value: ColumnOrName) -> Column:
    """Aggregate: the text that comes first when letter case is ignored."""
    return F.min(F.struct(alphabetic(value), _col(value).alias("_text")))["_text"]


def byte_length(value: ColumnOrName) -> Column:
    """Bytes of national text, two for each UTF-16 unit."""
    return F.octet_length(F.encode(_col(value), "UTF-16LE"))


def char_count(value: ColumnOrName) -> Column:
    """Characters without trailing blanks."""
    return F.char_length(F.rtrim(_col(value)))


def replace_text(value: ColumnOrName, old: str, new: str) -> Column:
    """Replace every ``old``, whatever its letter case."""
    quoted = new.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_col(value), f"(?iu){re.escape(old)}", quoted)


def joined_with_blanks(left: ColumnOrName, blanks: int, right: ColumnOrName) -> Column:
    return F.concat(_col(left), F.repeat(F.lit(" "), blanks), _col(right))


def quoted(value: ColumnOrName) -> Column:
    """Text between single quotation marks."""
    mark = F.char(F.lit(39))
    return F.concat(mark, _col(value), mark)


def shifted_code(value: ColumnOrName, prefix: str, shift: int, start: int = 2) -> Column:
    """Code with a new prefix and its number raised by ``shift``: L01 to K101."""
    number = F.substring(_col(value).cast("string"), start, 2147483647).cast("int")
    return F.concat(F.lit(prefix), (number + shift).cast("string"))


def valid_postcode(value: ColumnOrName) -> Column:
    """True for exactly five digits, false for everything else, NULL too."""
    return F.coalesce(_col(value).rlike("^[0-9]{5}\\z"), F.lit(False))


def supplier_sentence(name: ColumnOrName, number: ColumnOrName, place: ColumnOrName, status: ColumnOrName) -> Column:
    """One sentence about a supplier; NULL as soon as one of its parts is NULL."""
    return F.concat(
        F.lit("Der Lieferant "), _col(name), F.lit(" ("), _col(number).cast("string"), F.lit("), wohnt in "),
        _col(place), F.lit(" und hat einen Status von "), _col(status).cast("string"),
    )
