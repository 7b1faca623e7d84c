"""Text and JSON expressions. All are Spark built-ins, so they stay inside code generation."""

from __future__ import annotations

import html.entities
import json
import unicodedata
from collections.abc import Callable, Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The locale key of translated texts and the hashtag reference inside bodies.
LOCALE = "pt-BR"
HASHTAG_PATTERN = r"(?U)gid://decide/Decidim::Hashtag/\d/\w*|\n(?=\n?\z)"

# Letters without a canonical decomposition that still have an ASCII spelling.
_SPELLED_OUT = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "Th", "þ": "th",
    "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "ı": "i",
    "ª": "a", "º": "o", "¼": "1/4", "½": "1/2", "¾": "3/4", "€": "EUR",
    "А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ж": "Zh", "З": "Z", "И": "I", "Й": "I", "К": "K", "Л": "L",
    "М": "M", "Н": "N", "О": "O", "П": "P", "Р": "R", "С": "S", "Т": "T", "У": "U", "Ф": "F", "Х": "Kh", "Ц": "Ts", "Ч": "Ch",
    "Ш": "Sh", "Щ": "Shch", "Ъ": "", "Ы": "Y", "Ь": "", "Э": "E", "Ю": "Iu", "Я": "Ia",
}


def last_segment(col: Column, separator: str = "::") -> Column:
    """Text after the last separator, lower-cased (``A::B::Cd`` gives ``cd``)."""
    return F.lower(F.element_at(F.split(col, separator), -1))


def lower_first(col: Column) -> Column:
    return F.concat(F.lower(F.substring(col, 1, 1)), F.substr(col, F.lit(2)))


def last_segment_lower_first(col: Column, separator: str = "::") -> Column:
    """Text after the last separator with only its first letter lower-cased."""
    return lower_first(F.element_at(F.split(col, separator), -1))


def snake_case(col: Column) -> Column:
    words = F.regexp_replace(col, r"(\p{Lu}+)(\p{Lu}\p{Ll})", "$1_$2")
    words = F.regexp_replace(words, r"([\p{Ll}\d])(\p{Lu})", "$1_$2")
    return F.lower(F.replace(words, F.lit("-"), F.lit("_")))


def last_word_of_camel(col: Column) -> Column:
    """``ParticipatoryProcess`` gives ``process``."""
    return F.element_at(F.split(snake_case(col), "_"), -1)


def plural(col: Column) -> Column:
    """Regular English plural, which covers the space types used in links."""
    return (
        F.when(col.rlike("(s|x|z|ch|sh)$"), F.concat(col, F.lit("es")))
        .when(col.rlike("[^aeiou]y$"), F.regexp_replace(col, "y$", "ies"))
        .otherwise(F.concat(col, F.lit("s")))
    )


def component_link(api_url: str, space_type: Column, space_slug: Column, component_id: Column,
                   component_type: Column) -> Column:
    """Base link of a component: site root, plural space type, slug, component id and type."""
    root = api_url if "/" in api_url.split("://", 1)[-1] else api_url + "/"
    root = root[: root.rfind("/") + 1]
    return F.concat(
        F.lit(root), plural(last_word_of_camel(F.element_at(F.split(space_type, "::"), -1))), F.lit("/"),
        space_slug, F.lit("/f/"), component_id.cast("string"), F.lit("/"), F.lower(component_type),
    )


def link_to(base: Column, item_id: Column) -> Column:
    return F.concat_ws("/", F.rtrim(base, F.lit("/")), item_id.cast("string"))


def localized(col: Column, locale: str = LOCALE) -> Column:
    """Text of one locale in a JSON document; NULL for other locales and for invalid JSON."""
    return F.get_json_object(col, f"$.{locale}")


def invalid_json(col: Column) -> Column:
    """True where a non-null text does not parse, to count what ``localized`` turns into NULL."""
    return col.isNotNull() & F.try_parse_json(col).isNull()


def url_part(url: Column, segment: str, parity: bool = True) -> Column:
    """The path part that follows ``/segment/`` in a URL.

    With ``parity`` the guard ignores case while the replacement does not, the last occurrence wins
    and a query string stays attached. Otherwise case is ignored throughout and the part ends at
    ``/``, ``?`` or ``#``.
    """
    if parity:
        guard = url.rlike(f"(?i)/{segment}/([^/]+)/?")
        return F.when(guard, F.regexp_replace(url, rf"(?s)^.*/{segment}/([^/]+)/?.*\z", "$1"))
    part = F.regexp_extract(url, rf"(?is)^.*/{segment}/([^/?#]+)", 1)
    return F.nullif(part, F.lit(""))


def is_digits(col: Column) -> Column:
    return col.rlike(r"^\d+\z")


def strip_tags(col: Column) -> Column:
    """Markup removed: script and style bodies, comments and declarations, then every tag.

    A ``>`` inside a quoted attribute value ends no tag. A script, style or comment that is never closed takes the rest of the text.
    """
    attributes = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
    out = F.regexp_replace(col, rf"(?is)<(script|style)\b{attributes}>.*?(?:</\1\s*>|\z)", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?(?:-->|\z)", "")
    return F.regexp_replace(out, rf"(?s)</?[A-Za-z]{attributes}>|<![A-Za-z][^>]*>|<\?[^>]*>", "")


#: Names of character references that are looked up first, as they make up nearly all.
_USUAL = ("amp", "quot", "lt", "gt", "nbsp", "apos")


def decode_entities(col: Column) -> Column:
    """Named and numeric character references decoded once, left to right.

    The closing semicolon may be absent; an unknown name stays, without its semicolon. A number that is no
    character gives the replacement character, as a browser does.
    """
    every = {name[:-1]: char for name, char in html.entities.html5.items() if name.endswith(";")}
    # A map is searched from its start, so names are looked up in the map of their first letter.
    by_letter: dict[str, dict[str, str]] = {}
    for name, char in every.items():
        by_letter.setdefault(name[0], {})[name] = char

    def named(token: Column) -> Column:
        usual = F.create_map(*[F.lit(x) for name in _USUAL for x in (name, every[name])])
        others = None
        for letter, names in sorted(by_letter.items()):
            table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")
            value, here = F.try_element_at(table, token), F.substring(token, 1, 1) == letter
            others = F.when(here, value) if others is None else others.when(here, value)
        return F.coalesce(F.try_element_at(usual, token), others)

    def piece(part: Column) -> Column:
        token = F.regexp_extract(part, r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", 1)
        whole = F.regexp_extract(part, r"^&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", 0)
        rest = F.substr(part, F.length(whole) + 1)
        is_hex = token.rlike("^#[xX]")
        digits = F.regexp_replace(token, "^#[xX]?0*", "")
        # Any number has digits; more of them than the last character's number has are too many.
        number = F.when(F.length(digits) <= 7, F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"))
        number = F.when(is_hex, number).otherwise(F.when(F.length(digits) <= 7, F.when(digits == "", "0").otherwise(digits).cast("long")))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(F.coalesce(valid, F.lit(False)), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        return (
            F.when(token == "", part)
            .when(token.startswith("#"), F.concat(char, rest))
            .otherwise(F.concat(F.coalesce(named(token), F.concat(F.lit("&"), token)), rest))
        )

    parts = F.split(col, "(?=&)")
    decoded = F.array_join(F.transform(parts, piece), "")
    return F.when(col.contains("&"), decoded).otherwise(col)


def html_to_text(col: Column) -> Column:
    """Text content of an HTML fragment; no blank is put in for block tags."""
    # A reference without semicolon ends where a tag starts, which must be kept when the tag goes.
    closed = F.regexp_replace(col, "(&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*))(?=<)", "$1;")
    return decode_entities(strip_tags(closed))


def drop_hashtags(col: Column) -> Column:
    """Hashtag references and a trailing line break removed."""
    return F.regexp_replace(col, HASHTAG_PATTERN, "")


def evaluated_once(col: Column, of: Callable[[Column], Column]) -> Column:
    """``of(col)`` with the value of ``col`` worked out once, however often ``of`` names it."""
    return F.get(F.transform(F.array(col), of), F.lit(0))


@lru_cache(maxsize=1)
def _unmarked() -> tuple[str, str]:
    """Latin letters with marks, and the letters without them."""
    source, target = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(point))[0]
        if base.isascii() and base.isalpha() and base != chr(point):
            source.append(chr(point))
            target.append(base)
    return "".join(source), "".join(target)


def _spelled_out(col: Column) -> Column:
    """Letters that have a spelling of their own, spelled. Those of one letter go in one pass with the marks."""
    source, target = _unmarked()
    single = {c: s for c, s in _SPELLED_OUT.items() if len(s) == 1}
    out = F.translate(col, source + "".join(single), target + "".join(single.values()))
    longer = {c: s for c, s in _SPELLED_OUT.items() if len(s) != 1}
    spelled = out
    for char, text in longer.items():
        spelled = F.replace(spelled, F.lit(char), F.lit(text))
    return F.when(col.rlike("[" + "".join(longer) + "]"), spelled).otherwise(out)


def to_ascii(col: Column) -> Column:
    """Latin letters without their marks, letters with a known spelling spelled; other characters stay as they are."""
    return evaluated_once(col, lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), _spelled_out(t)).otherwise(t))


def identifier(*parts: Column) -> Column:
    """Upper-case ASCII identifier of several texts joined by ``_``.

    A letter or digit without a spelling here is put as its code point, as in ``U5317``, so that names in other scripts don't all
    become one; every other character is ``_``.
    """
    other = r"[\p{L}\p{N}&&[^\x00-\x7F]]"

    def coded(text: Column) -> Column:
        """Each letter without a spelling as its code point; what stands between them is passed over in one piece."""
        pieces = F.split(text, f"(?={other})|(?<={other})")
        code = F.transform(pieces, lambda p: F.when(p.rlike(f"^{other}"), F.concat(F.lit("U"), F.lpad(F.hex(F.encode(p, "UTF-16BE")), 4, "0"))).otherwise(p))
        return F.when(text.rlike(other), F.array_join(code, "")).otherwise(text)

    def whole(text: Column) -> Column:
        return F.when(text.rlike(r"[^\x00-\x7F]"), evaluated_once(_spelled_out(text), coded)).otherwise(text)

    joined = F.concat_ws("_", *[F.upper(part) for part in parts])
    cleaned = F.regexp_replace(evaluated_once(joined, whole), r"[^A-Za-z0-9_]", "_")
    return F.trim(cleaned, F.lit("_"))


def smallest_match(col: Column, pattern: str) -> Column:
    """Aggregate: the smallest text that matches a pattern; NULL without one."""
    return F.min(F.when(col.rlike(pattern), col))


def title_from_identifier(col: Column) -> Column:
    """``AB_2CD`` gives ``Ab 2Cd``: every letter after a non-letter is a capital."""
    words = F.lower(F.replace(col, F.lit("_"), F.lit(" ")))
    starts = F.split(words, r"(?<=[^\p{L}])(?=\p{L})")
    capital = F.transform(starts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.trim(F.array_join(capital, ""))


def blank_to_dash(col: Column) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit("-"))


def first_filled(*cols: Column, default: str = "-") -> Column:
    """First of several texts that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(default))


def blank_where(col: Column, values: Iterable[str]) -> Column:
    """Given values replaced by an empty text."""
    return F.when(col.isin(*values), F.lit("")).otherwise(col)


def lookup(col: Column, table: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Value of a small fixed table, or the default."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(entries, col), fallback)


def first_matching_column(columns: Iterable[str], pattern: str) -> str | None:
    """First column name that matches a pattern, ignoring case; other key types are skipped."""
    import re

    found = re.compile(pattern, re.IGNORECASE)
    return next((c for c in columns if isinstance(c, str) and found.search(c)), None)


def first_matching_key(keys: Column, pattern: str) -> Column:
    """The same over an array of names held as data."""
    return F.try_element_at(F.filter(keys, lambda k: k.rlike(f"(?i){pattern}")), F.lit(1))
