"""Text expressions: localisation, cleaning, labels."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference_data as ref

LOCALES = ("es_GT", "en_US")


def localized(c: Column | str, locales: tuple[str, ...] = LOCALES) -> Column:
    """Translated text in the first locale present, else the text as stored."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.get_json_object(c, f"$.{name}") for name in locales], c)


def localized_only(c: Column | str, locale: str = "es_GT") -> Column:
    """Translated text in one locale; null when that locale is absent."""
    return F.get_json_object(c, f"$.{locale}")


def localized_nonblank(c: Column | str, locales: tuple[str, ...] = LOCALES) -> Column:
    """Like ``localized``, but an empty translation also falls through; null becomes ''."""
    c = F.col(c) if isinstance(c, str) else c
    parts = [F.nullif(F.get_json_object(c, f"$.{name}"), F.lit("")) for name in locales]
    return F.coalesce(*parts, c, F.lit(""))


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def present(c: Column) -> Column:
    """True when the text is neither null nor empty."""
    return or_blank(c) != ""


def fill_text(df, value: str = ""):
    """Replace null by ``value`` in every text column."""
    return df.na.fill(value, [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])


def map_text(df, clean):
    """Apply ``clean`` to every text column, in one projection."""
    return df.select(*[
        clean(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
        for f in df.schema.fields
    ])


# --- control characters and whitespace -------------------------------------------------------

# Any Unicode whitespace, with the four separator controls that also split words.
BLANK = r"(?U:[\s\x1C-\x1F])"

_CONTROL = {
    # mode: characters removed
    "all": r"[\x00-\x1F\x7F]",
    "keep_layout": r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]",
    "one_line": r"[\x00-\x08\x0B\x0C\x0E-\x1F]",
    "xml": r"[\x00-\x08\x0B\x0C\x0E-\x1F]",
}


def strip_control(c: Column, mode: str = "all") -> Column:
    """Remove control characters.

    ``all`` drops every one including line ends; ``keep_layout`` keeps tab, LF and CR;
    ``one_line`` also turns each line end into a space; ``xml`` keeps DEL and the layout.
    """
    out = F.regexp_replace(c, _CONTROL[mode], "")
    if mode == "one_line":
        out = F.regexp_replace(out, r"\r\n|\n|\r", " ")
    return out


def trim_blank(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{BLANK}+|{BLANK}+\z", "")


# Anything ``squash_lines`` would change: control characters, whitespace that is not one inner space.
_UNTIDY = r"[\x00-\x1F]|(?U:[\s&&[^ ]])|  |\A | \z"


def squash_lines(c: Column) -> Column:
    """Collapse whitespace inside each line and drop the blank lines; null becomes ''."""
    text = F.regexp_replace(strip_control(c, "xml"), r"\r\n?", "\n")
    text = F.regexp_replace(text, r"(?U)[\s&&[^\n]]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    text = F.regexp_replace(text, r"\A[ \n]+|[ \n]+\z", "")
    return or_blank(F.when(F.rlike(c, F.lit(_UNTIDY)), text).otherwise(c))


# --- HTML ------------------------------------------------------------------------------------

# The five entities of the plain mode.
COMMON_ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'))


# A reference behind its ampersand: decimal, hexadecimal or named, with or without a semicolon.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_BAD_CHARACTER = "\ufffd"


def _letter(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numbered_reference(ref: Column) -> Column:
    """Text of a decimal or hexadecimal reference by the rules of HTML: some codes have a fixed text, some have none."""
    digits = F.regexp_extract(ref, r"^#[xX]?0*([0-9a-fA-F]*);?$", 1)
    base = F.when(F.lower(F.substring(ref, 2, 1)) == "x", 16).otherwise(10)
    # More than seven digits lie beyond every character; longer ones would not fit a number.
    code = F.when(F.length(digits) > 7, 0x7FFFFFFF).otherwise(
        F.coalesce(F.conv(F.nullif(digits, F.lit("")), 16, 10).cast("bigint"), F.lit(0)))
    decimal = F.when(F.length(digits) > 7, 0x7FFFFFFF).otherwise(F.coalesce(digits.try_cast("bigint"), F.lit(0)))
    code = F.when(base == 16, code).otherwise(decimal)
    # Codes 128 to 159 mean the characters of the Windows code page; zero has no character.
    fixed = {0: _BAD_CHARACTER, 13: "\r"}
    fixed |= {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    table = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])
    silent = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
              | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (
        F.when(F.map_contains_key(table, code.cast("int")), F.element_at(table, code.cast("int")))
        .when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), _BAD_CHARACTER)
        .when(silent, "").otherwise(_letter(code))
    )


def _named_reference(ref: Column) -> Column:
    """Text of a named reference: the whole name, else the longest name it begins with, else itself."""
    names = F.create_map(*[F.lit(x) for pair in html5.items() for x in pair])
    starts = F.filter(F.transform(F.sequence(F.length(ref), F.lit(1), F.lit(-1)), lambda n: F.substr(ref, F.lit(1), n)),
                      lambda s: F.map_contains_key(names, s))
    known = F.try_element_at(starts, F.lit(1))
    return F.coalesce(F.concat(F.element_at(names, known), F.substr(ref, F.length(known) + 1)), F.concat(F.lit("&"), ref))


def decode_entities(c: Column) -> Column:
    """Decode every HTML reference, numeric ones included. Texts without an ampersand are left alone."""
    def piece(text: Column) -> Column:
        ref = F.regexp_extract(text, _REFERENCE, 1)
        said = F.when(ref == "", "&").when(F.startswith(ref, F.lit("#")), _numbered_reference(ref)).otherwise(_named_reference(ref))
        return F.concat(said, F.substr(text, F.length(ref) + 1))

    pieces = F.split(c, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), piece)
    return F.when(F.contains(c, F.lit("&")), F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))).otherwise(c)


def decode_common_entities(c: Column) -> Column:
    for entity, char in COMMON_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def html_to_lines(c: Column, decode=decode_entities, squeeze_spaces: bool = True) -> Column:
    """HTML to plain lines: decode first, breaks become line ends, then tags go."""
    text = decode(or_blank(c))
    text = F.regexp_replace(text, rf"(?i)<br{BLANK}*/?>|</p>", "\n")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    text = F.regexp_replace(text, rf"\n{BLANK}*\n", "\n")
    text = trim_blank(text)
    if squeeze_spaces:
        text = F.regexp_replace(text, r" +", " ")
    return text


def html_to_summary(c: Column, longest: int = 200) -> Column:
    """HTML to one line: tags go first, then five entities are decoded; long text is shortened."""
    text = F.regexp_replace(or_blank(c), r"(?d)<.*?>", "")
    text = F.regexp_replace(F.regexp_replace(text, rf"{BLANK}+", " "), r"\A | \z", "")
    text = F.regexp_replace(decode_common_entities(text), r"[\n\r]", " ")
    short = F.concat(F.substring(text, 1, longest - 3), F.lit("..."))
    return trim_blank(F.when(F.length(text) > longest, short).otherwise(text))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


# --- numbers and labels ----------------------------------------------------------------------

_NUMBER_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def number_or_zero(c: Column) -> Column:
    """The number a text starts with, else 0."""
    return F.coalesce(F.regexp_extract(c, _NUMBER_PREFIX, 1).try_cast("double"), F.lit(0.0))


def thousands_label(c: Column, symbol: str = "Q") -> Column:
    """Compact amount: ``Q12K``."""
    return F.concat(F.lit(symbol), F.format_string("%d", F.floor(c / 1000 + 0.5)), F.lit("K"))


def _one_decimal(c: Column) -> Column:
    return F.format_string("%.1f", F.floor(c * 10 + 0.5) / 10)


def file_size_label(c: Column) -> Column:
    kb, mb = 1024, 1024 * 1024
    return (
        F.when(F.coalesce(c, F.lit(0)) == 0, "N/A")
        .when(c < kb, F.concat(c.cast("string"), F.lit(" B")))
        .when(c < mb, F.concat(_one_decimal(c / kb), F.lit(" KB")))
        .otherwise(F.concat(_one_decimal(c / mb), F.lit(" MB")))
    )


def stable_file_name(c: Column) -> Column:
    """File name without its ``_YYYYMMDD_HHMM[SS]`` suffix and trailing underscores."""
    stem = F.regexp_replace(c, r"(\.[^.]*)$", "")
    ext = F.regexp_extract(c, r"(\.[^.]*)$", 1)
    return F.concat(F.regexp_replace(F.regexp_replace(stem, r"_\d{8}_\d{4,6}$", ""), r"_+$", ""), ext)


def haystack(*cols: Column | str) -> Column:
    """Lower-cased, space-joined text of several columns; a null counts as empty."""
    parts = [or_blank((F.col(c) if isinstance(c, str) else c).cast("string")) for c in cols]
    return F.lower(F.concat_ws(" ", *parts))


def label_of(c: Column, labels: dict[str, str]) -> Column:
    """Label of a code from a fixed map, the code itself when it is not listed."""
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return out.otherwise(c)


def sentence(*fragments: Column) -> Column:
    """Join the fragments that are not null by one space."""
    return F.concat_ws(" ", *fragments)


def fragment(condition: Column, *parts: Column | str) -> Column:
    """A piece of a sentence, null unless the condition holds."""
    return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else or_blank(p) for p in parts]))


def erp_link(base_url: str, entity_id: Column, *, project: bool, project_id: Column | None = None) -> Column:
    """Deep link to a project or task page; an id that is not a number becomes 0."""
    number = F.coalesce(
        F.replace(entity_id.cast("string"), F.lit("P"), F.lit("")).try_cast("bigint"), F.lit(0)
    ).cast("string")
    if project:
        action, active, model = ref.PROJECT_FORM_ACTION, number, "project.project"
    else:
        action, model = ref.TASK_FORM_ACTION, "project.task"
        active = number if project_id is None else F.coalesce(project_id.cast("string"), number)
    return F.concat(
        F.lit(base_url + "id="), number,
        F.lit(f"&cids=1&menu_id={ref.ERP_MENU_ID}&action={action}&active_id="), active,
        F.lit(f"&model={model}&view_type=form"),
    )
