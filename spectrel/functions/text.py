"""Text and XML column functions built from Spark's own string functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import AMINO_ACIDS, DECOY_LABEL, DECOY_PREFIXES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_elements(xml: Column | str, tag: str) -> Column:
    """Every ``<tag ...>...</tag>`` substring, in order."""
    pattern = rf"(?s)<{re.escape(tag)}\b.*?</{re.escape(tag)}>"
    return F.regexp_extract_all(_col(xml), F.lit(pattern), F.lit(0))


def require_closed(xml: Column | str, tag: str) -> Column:
    """The text itself; raises when an element of this name is left open."""
    xml = _col(xml)
    name = re.escape(tag)
    opened = F.regexp_count(xml, F.lit(rf"<{name}\b(?![^>]*/>)"))
    closed = F.regexp_count(xml, F.lit(rf"</{name}>"))
    message = F.lit(f"element {tag} is not closed")
    return F.when(opened > closed, F.raise_error(message).cast("string")).otherwise(xml)


def extract_attr(xml: Column | str, name: str, required: bool = False) -> Column:
    """First ``name="value"``, exact case before any case; null (or an error) if absent."""
    xml = _col(xml)
    # the name first: looking back at every character is many times slower
    exact = rf'{re.escape(name)}(?<![\w:.-]{re.escape(name)})="([^"]*)"'
    has_exact = xml.rlike(exact)
    has_any = xml.rlike("(?i)" + exact)
    missing = (
        F.raise_error(F.lit(f"attribute {name} not found")).cast("string")
        if required
        else F.lit(None).cast("string")
    )
    return (
        F.when(has_exact, F.regexp_extract(xml, exact, 1))
        .when(has_any, F.regexp_extract(xml, "(?i)" + exact, 1))
        .otherwise(missing)
    )


def substitute_attr(xml: Column | str, name: str, value: Column | str) -> Column:
    """Replace the value of the first ``name="..."``; other text is unchanged."""
    xml = _col(xml)
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    marker = f'{name}="'
    at = F.instr(xml, marker)
    start = at + F.lit(len(marker))
    rest = F.substring(xml, start, F.length(xml))
    close = F.instr(rest, '"')
    changed = F.concat(F.substring(xml, F.lit(1), start - 1), value, F.substring(rest, close, F.length(rest)))
    return F.when((at > 0) & (close > 0), changed).otherwise(xml)


def clean_xml(text: Column | str) -> Column:
    """Drop ISO control characters."""
    return F.regexp_replace(_col(text), r"[\x00-\x1F\x7F-\x9F]", "")


def escape_xml(text: Column | str) -> Column:
    """Escape the five XML specials; characters outside 0x20..0xFE become hex references."""
    text = out = _col(text)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&apos;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    # runs of plain text stay whole; only the odd characters are handled one by one
    runs = F.regexp_extract_all(out, F.lit(r"[\x20-\xFE]+|[^\x20-\xFE]"), F.lit(0))
    coded = F.transform(
        runs,
        lambda c: F.when(c.rlike(r"^[\x20-\xFE]"), c).otherwise(
            F.concat(F.lit("&#x"), F.lower(F.conv(F.hex(F.encode(c, "UTF-32")), 16, 16)), F.lit(";"))
        ),
    )
    # most texts have nothing to escape
    special = text.rlike(r"[^\x20\x21\x23-\x25\x28-\x3B\x3D\x3F-\xFE]")
    return F.when(~special, text).when(text.rlike(r"[^\x20-\xFE]"), F.array_join(coded, "")).otherwise(out)


def condition_label(label: Column | str) -> Column:
    """Protein label safe to store and split: printable ASCII, no pipes, quotes or list marks."""
    printable = F.regexp_replace(_col(label), r"[^\x20-\x7E]", "")
    return F.translate(printable, "|\"'!;:,", "_      ")


def is_ambiguous(sequence: Column | str) -> Column:
    """True when any letter is not one of the twenty amino acids."""
    return F.upper(_col(sequence)).rlike(f"[^{AMINO_ACIDS}]")


def decoy_label(label: Column | str) -> Column:
    """Label with a known decoy prefix rewritten to the standard one; null if not a decoy."""
    label = _col(label)
    out = F.when(label.startswith(DECOY_LABEL), label)
    for prefix in DECOY_PREFIXES:
        body = F.substring(label, F.lit(len(prefix) + 1), F.length(label))
        checked = F.when(
            body == "", F.raise_error(F.lit("the label is only a decoy prefix")).cast("string")
        ).otherwise(F.concat(F.lit(DECOY_LABEL), body))
        out = out.when(label.startswith(prefix), checked)
    return out.otherwise(F.lit(None).cast("string"))


def alphabetical_id(value: Column | str) -> Column:
    """Digit-only ids padded to eight places so that they sort as text; others trimmed."""
    value = _col(value)
    number = F.regexp_replace(value, "^0+(?=.)", "")
    padded = F.when(F.length(number) >= 8, number).otherwise(F.lpad(number, 8, "0"))
    return F.when(value.rlike("^[0-9]+$"), padded).otherwise(F.trim(value))


def natural_order(value: Column | str) -> list[Column]:
    """Sort keys: numbers by value first, then everything else as text."""
    value = _col(value)
    return [value.try_cast("bigint").asc_nulls_last(), value.asc()]


def wrap_sequence(sequence: Column | str, width: int = 80) -> Column:
    """Break a sequence into lines of ``width``; the header is never part of it."""
    return F.regexp_replace(_col(sequence), f"(.{{{width}}})(?=.)", "$1\n")


def fasta_record(accession: Column | str, description: Column | str, sequence: Column | str, width: int = 80) -> Column:
    header = F.concat_ws(" ", _col(accession), F.nullif(_col(description), F.lit("")))
    return F.concat(F.lit(">"), header, F.lit("\n"), wrap_sequence(sequence, width))


# Control characters, and white space other than the non-breaking kinds.
_SPACE_OR_CONTROL = (
    r"\x{00}-\x{20}\x{7F}-\x{9F}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"
)


def printing_only(text: Column | str) -> Column:
    """Text without white space and control characters; non-breaking spaces stay."""
    return F.regexp_replace(_col(text), f"[{_SPACE_OR_CONTROL}]", "")


def equal_except_space(a: Column | str, b: Column | str) -> Column:
    return printing_only(a) == printing_only(b)


def pep_mass(line: Column | str) -> Column:
    """First number of a ``PEPMASS=`` line; later fields (space or tab) are intensity."""
    return F.regexp_extract(_col(line), r"PEPMASS=[ ]*([^\s]+)", 1).try_cast("double")


def mgf_title(line: Column | str) -> Column:
    """Title of a ``TITLE=`` line: the spot id when the second item carries one, else all of it."""
    line = _col(line)
    spot = r"^TITLE=[^,]*,\s*Spot_Id: ([^,]*)"
    return F.when(line.rlike(spot), F.trim(F.regexp_extract(line, spot, 1))).otherwise(
        F.regexp_extract(line, "^TITLE=(.*)$", 1)
    )


_PAIR = r'([^\s="]+)=((?:"(?:[^"\\]|\\.)*"|[^\s"])*)'


def comment_map(line: Column | str) -> Column:
    """``Comment:`` line of key=value items to a map; quoted values keep their spaces and quotes."""
    body = F.regexp_replace(_col(line), "^Comment: ", "")
    keys = F.regexp_extract_all(body, F.lit(_PAIR), F.lit(1))
    values = F.regexp_extract_all(body, F.lit(_PAIR), F.lit(2))
    pairs = F.arrays_zip(keys.alias("key"), values.alias("value"))
    # the last of equal keys wins, as in an ordinary map
    kept = F.filter(
        F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("at"))),
        lambda p: p["at"] == F.size(keys) - F.array_position(F.reverse(keys), p["key"]).cast("int"),
    )
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"], p["value"])))
