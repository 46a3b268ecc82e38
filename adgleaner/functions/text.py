"""Column functions on plain text."""

import html.entities
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# All characters that count as blank when a text is stripped.
BLANKS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Character references common enough to replace without splitting the text.
# The ampersand comes last, so that no text is unescaped twice.
COMMON_REFERENCES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\xa0"),
    ("&copy;", "\xa9"),
    ("&middot;", "\xb7"),
    ("&amp;", "&"),
)
_OTHER_REFERENCE = r"&(?!(?:lt|gt|quot|apos|nbsp|copy|middot|amp|#39);)(?:#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z])"

# Names with their characters; those that also hold without a semicolon have at most six letters.
_NAMED = html.entities.html5
# Numbers of the C1 range mean Windows-1252.
_C1 = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}


def strip(c: Column) -> Column:
    """Remove blanks of every kind from both ends."""
    return F.btrim(c, F.lit(BLANKS))


def text_key(c: Column) -> Column:
    """Key under which two texts count as the same: blanks around and case are ignored."""
    return F.sha2(F.lower(strip(c)).cast("binary"), 256)


def _character(code_point: Column) -> Column:
    """The character of a code point; the replacement character if there is none, nothing for a control."""
    valid = (code_point.between(1, 0xD7FF)) | (code_point.between(0xE000, 0x10FFFF))
    safe = F.when(valid, code_point).otherwise(F.lit(0xFFFD))
    plain = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    high = F.element_at(F.array(*[F.lit(c) for c in _C1.values()]), (code_point - 0x7F).cast("int"))
    control = code_point.between(1, 0x1F) & ~code_point.isin(0x09, 0x0A, 0x0C, 0x0D) | (code_point == 0x7F)
    return F.when(code_point.between(0x80, 0x9F), high).when(control, "").otherwise(plain)


def _unescape_all(c: Column) -> Column:
    """General form: cut at each ampersand, resolve the reference each piece starts with."""
    # One literal that is folded into a map, instead of a node per name.
    text = "\x01".join(f"{k}\x02{v}" for k, v in _NAMED.items())
    names = F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))

    def resolve(piece: Column, i: Column) -> Column:
        number = F.regexp_extract(piece, r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)
        decimal = F.regexp_extract(number, r"^#([0-9]+)", 1).try_cast("bigint")
        hexa = F.conv(F.regexp_extract(number, r"^#[xX]0*([0-9a-fA-F]{1,8});?$", 1), 16, 10).try_cast("bigint")
        numbered = _character(F.coalesce(decimal, hexa, F.lit(0).cast("bigint")))
        name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,31};?)", 1)
        # The whole name, else the longest start of it that is a name without a semicolon.
        lengths = F.array(F.length(name), *[F.lit(n) for n in range(6, 1, -1)])
        known = F.transform(
            lengths,
            lambda n: F.struct(
                F.try_element_at(names, F.substr(name, F.lit(1), n)).alias("text"), F.least(F.length(name), n).alias("used")
            ),
        )
        best = F.get(F.filter(known, lambda k: k["text"].isNotNull()), 0)
        resolved = F.when(number != "", F.concat(numbered, F.substr(piece, F.length(number) + 1))).otherwise(
            F.concat(best["text"], F.substr(piece, best["used"] + 1))
        )
        return F.when(i == 0, piece).otherwise(F.coalesce(resolved, F.concat(F.lit("&"), piece)))

    return F.array_join(F.transform(F.split(c, "&"), resolve), "")


def unescape(c: Column) -> Column:
    """Resolve HTML character references once."""
    simple = c
    for reference, character in COMMON_REFERENCES:
        simple = F.replace(simple, F.lit(reference), F.lit(character))
    return (
        F.when(~F.contains(c, F.lit("&")), c)
        .when(c.rlike(_OTHER_REFERENCE), _unescape_all(c))
        .otherwise(simple)
    )


# What Windows-1252 shows for the bytes that are control characters in Latin-1.
_WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_WINDOWS_BYTES = "".join(chr(c.encode("cp1252")[0]) for c in _WINDOWS)
# UTF-8 that was read wrongly and written again, so many times at most.
_LAYERS = 3


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 bytes read as Latin-1 or Windows-1252, up to three times over.

    A layer is undone only where every character of the text stands for a byte and the bytes are
    valid UTF-8: a text with one letter that was right all along stays as it is. Bytes that
    Windows-1252 leaves open count as the control characters that readers make of them.
    """

    def undone(text: Column) -> Column:
        as_read = F.translate(text, _WINDOWS, _WINDOWS_BYTES)
        suspect = as_read.rlike(r"[\x{80}-\x{FF}]") & ~as_read.rlike(r"[^\x{0}-\x{FF}]")
        # Text that does not fit Latin-1 must never reach encode, which rejects it.
        again = F.encode(F.when(suspect, as_read), "ISO-8859-1").cast("string")
        return F.when(suspect & F.is_valid_utf8(again), again).otherwise(text)

    layers = F.aggregate(F.sequence(F.lit(1), F.lit(_LAYERS)), c, lambda text, _: undone(text))
    # Only what begins a sequence of bytes can be repaired; most texts hold none of it.
    return F.when(c.rlike(r"[\x{C2}-\x{F4}]"), layers).otherwise(c)


def phrases_pattern(phrases: Sequence[str]) -> str:
    """Pattern that finds the words of any of the phrases in order, in any case, as whole words."""
    gap = r"[^\p{L}\p{N}_]"
    forms = [f"{gap}+".join(p.replace(":", " ").split()) for p in phrases]
    return rf"(?iu)(?:^|{gap})(?:{'|'.join(forms)})(?:$|{gap})"
