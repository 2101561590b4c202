"""String expressions: folding, slugs, keys, template and escape helpers."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import params as P


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition to ASCII, generated from the Unicode database.

    One-to-one mappings become a translate table; the few characters that
    expand to several ASCII characters (ligatures, fractions) a small map.
    """
    source, target, expanding = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if not unicodedata.decomposition(chr(code)):
            continue
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(chr(code))
            target.append(plain)
        elif plain:
            expanding[chr(code)] = plain
    return "".join(source), "".join(target), expanding


def fold(text: Column) -> Column:
    """NFKD without the non-ASCII rest, entirely in the JVM."""
    source, target, expanding = _fold_tables()
    chars = "".join(expanding)
    expanded = F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c: F.when(
                F.lit(chars).contains(c) & (F.octet_length(c) > 1),
                F.try_element_at(F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in expanding.items())),
                                              F.lit("\n"), F.lit("\t")), c),
            ).otherwise(c),
        ),
        "",
    )
    # pure ASCII needs nothing; only texts that may hold an expanding character go by character
    wide = F.when(text.rlike("[" + _screen(chars) + "]"), expanded).otherwise(text)
    folded = F.regexp_replace(F.translate(wide, source, target), r"[^\x00-\x7F]+", "")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _screen(chars: str, common: int = 0x2000) -> str:
    """Short regex class that covers the characters: exact below `common`, all above it.

    A class of hundreds of ranges would be walked for every character of a text.
    """
    codes = sorted(ord(c) for c in chars if ord(c) < common)
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    ranges.append([common, sys.maxunicode])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def fold_upper(text: Column) -> Column:
    return F.upper(F.trim(fold(text)))


def fold_lower(text: Column) -> Column:
    return F.lower(fold(text))


def slugify(text: Column, max_len: int = 80) -> Column:
    dashed = F.lower(F.btrim(F.regexp_replace(fold(text), "[^a-zA-Z0-9]+", "-"), F.lit("-")))
    named = let(
        F.substring(dashed, 1, max_len),
        lambda cut: F.btrim(F.when(cut == "", F.lit("sem-titulo")).otherwise(cut), F.lit("-")))
    return F.coalesce(named, F.lit("sem-titulo"))


def short_hash(text: Column, n: int = 8) -> Column:
    return F.substring(F.md5(text), 1, n)


def synthetic_key(*fields: Column) -> Column:
    """MD5 of the fields joined by a bar, null as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]))


def document_id(source: Column, title: Column, url: Column) -> Column:
    """`slug(source)_slug(title)_hash(url or title)`: same input, same name."""
    seed = F.when(F.coalesce(url, F.lit("")) == "", F.coalesce(title, F.lit(""))).otherwise(url)
    return F.concat_ws("_", slugify(source, 40), slugify(title, 60), short_hash(seed))


def title_key(title: Column) -> Column:
    """Folded, alphanumeric and blank only, lower case: the form titles are compared in."""
    return F.trim(F.lower(F.regexp_replace(fold(F.coalesce(title, F.lit(""))), "[^a-zA-Z0-9 ]", "")))


def escape_html(value: Column, multiline: bool = False, quotes: bool = False) -> Column:
    text = F.when(F.lower(F.trim(value)).isin("none", "nan", "nat", ""), F.lit("")).otherwise(value)
    text = F.coalesce(text, F.lit(""))
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    if quotes:
        text = F.replace(text, F.lit('"'), F.lit("&quot;"))
    return F.replace(text, F.lit("\n"), F.lit("<br>")) if multiline else text


def cut_before(text: Column, title: Column) -> Column:
    """Text from the first occurrence of the title; the whole text if it is absent."""
    at = F.instr(text, title)
    return F.trim(F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(text))


def insert_before_body_end(report: Column, block: Column) -> Column:
    marker = F.lit("</body>")
    return F.when(
        report.contains("</body>"), F.replace(report, marker, F.concat(block, marker))
    ).otherwise(F.concat(report, block))


def render_template(config: Column, name: str, value: Column) -> Column:
    """Replace `{name}` in every value of a string map."""
    return F.transform_values(config, lambda _, v: F.replace(v, F.lit("{" + name + "}"), value))


def append_to_list(current: Column, item: Column) -> Column:
    """Comma list with `item` added once, items trimmed, blanks dropped."""
    parts = F.filter(
        F.transform(F.split(F.coalesce(current, F.lit("")), ","), lambda x: F.trim(x)),
        lambda x: x != "",
    )
    return F.array_join(
        F.when(F.array_contains(parts, item), parts).otherwise(F.array_append(parts, item)), ", "
    )


def append_note(notes: Column, reason: Column) -> Column:
    blank = F.coalesce(F.trim(notes), F.lit("")) == ""
    return F.when(blank, reason).otherwise(F.concat(notes, F.lit(" | "), reason))


def labelled_fields(pairs: list[tuple[str, Column]]) -> Column:
    """`label: value` texts of the non-blank fields, in order."""
    fields = F.array(*[
        F.struct(F.lit(label).alias("label"), escape_html(value.cast("string")).alias("value"))
        for label, value in pairs
    ])
    return F.filter(fields, lambda f: f["value"] != "")


def tickers(aliases: Column, limit: int = 2) -> Column:
    """First aliases that look like tickers: upper case, no blank, at most 8 characters."""
    return F.slice(
        F.filter(
            aliases,
            lambda a: (a == F.upper(a)) & (a != F.lower(a)) & ~a.contains(" ") & (F.length(a) <= 8),
        ),
        1, limit,
    )


def entity_line(name: Column, aliases: Column) -> Column:
    short = tickers(aliases)
    return F.concat(
        F.lit("- "), name,
        F.when(F.size(short) > 0, F.concat(F.lit(" ("), F.array_join(short, ", "), F.lit(")"))).otherwise(""),
    )


def contains_any(text: Column, markers: list[str]) -> Column:
    found = F.lit(False)
    for marker in markers:
        found = found | text.contains(marker)
    return found


def looks_paywalled(text: Column, markers: list[str] | None = None) -> Column:
    head = F.lower(F.substring(text, 1, P.PAYWALL_SCAN_CHARS))
    return let(head, lambda h: contains_any(h, markers or P.PAYWALL_MARKERS))


def matched_terms(text: Column, terms: list[str] | None = None) -> Column:
    """Terms found in the text without regard to accents or case, in list order."""
    wanted = [(t, _fold_literal(t).upper()) for t in terms or P.GAZETTE_TERMS]
    found = let(F.upper(fold(text)), lambda f: F.array(*[F.when(f.contains(n), F.lit(t)) for t, n in wanted]))
    return F.filter(found, lambda t: t.isNotNull())


def _fold_literal(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
