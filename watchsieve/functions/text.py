"""Normalisers as column expressions; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables

# Patterns of remarks.
LINKED_TO = r"(?i)Linked\s+to:\s*(.+?)(?=\s*[;.]|\s*Linked\s+to:|$)"
PHONE = r"(?i)(?:Tel(?:ephone)?|Phone|Fax)[.\s:]*([+\d][\d\s\-\(\)\.\/+]{5,})"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Without line ends and outer white space; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(col(c), r"[\r\n]", "")), F.lit(""))


def normalize(c: Column | str, keep: str = "-#") -> Column:
    """Only ASCII letters, digits, kept characters and single spaces, in upper case; never null."""
    kept = "".join(f"\\{x}" for x in keep)
    return F.coalesce(F.upper(F.trim(F.regexp_replace(F.regexp_replace(col(c), rf"(?U)[^A-Za-z0-9\s{kept}]", ""), r"(?U)\s+", " "))), F.lit(""))


def ph_to_f(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("PH"), F.lit("F"))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\D", "")


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(values: Mapping[str, str]) -> Column:
    """A map as one expression that is parsed at once; many literals by themselves take longer than a query."""
    return F.expr("map(" + ", ".join(_quoted(x) for pair in sorted(values.items()) for x in pair) + ")")


def lookup_word(values: Mapping[str, str], word: Column) -> Column:
    """As lookup, for many values: first by the first character, so that few are compared."""
    by: dict[str, list[str]] = {}
    for k, v in sorted(values.items()):
        by.setdefault(k[:1], []).append(f"{_quoted(k)}, {_quoted(v)}")
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, map({', '.join(some)})" for k, some in sorted(by.items())) + ")")[F.left(word, F.lit(1))][word]


def expand_code(c: Column | str, values: Mapping[str, str], keep: str = "-#") -> Column:
    clean = normalize(c, keep)
    return F.coalesce(lookup(values)[clean], clean)


def state(c: Column | str, keep: str = "-#") -> Column:
    return expand_code(c, tables.STATES, keep)


def country(c: Column | str, keep: str = "-#") -> Column:
    return expand_code(c, tables.COUNTRIES, keep)


def address(c: Column | str, abbreviations: Iterable[tuple[str, str, int]] = tuple(tables.ADDRESS_ABBREVIATIONS), keep: str = "-#") -> Column:
    """Abbreviations written out, then normalized. One with several full forms is, as the first word with a letter, the one not barred there; later the first that is."""
    forms: dict[str, list[tuple[int, str]]] = {}
    for short, full, skip in abbreviations:
        forms.setdefault(short.upper(), []).append((int(skip), full))
    first, later = {}, {}
    for short, found in forms.items():
        found.sort(key=lambda x: x[0])
        first[short] = found[0][1]
        later[short] = found[0][1] if len(found) == 1 else next((f for s, f in found if s == 1), found[0][1])
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[.,;\-/\\]+", " "), r"(?U)\s+", " ")), " ")
    start = F.array_position(F.transform(words, lambda w: w.rlike("[A-Za-z]")), F.lit(True)) - 1
    full = F.transform(words, lambda w, i: F.coalesce(F.when(i == start, lookup_word(first, F.upper(w))).otherwise(lookup_word(later, F.upper(w))), w))
    return normalize(F.array_join(F.filter(full, lambda w: w != ""), " "), keep)


def entity(c: Column | str, types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES), keep: str = "-#") -> Column:
    """The abbreviated form of an organisation at the end, and at the beginning, written out, then normalized."""
    types = list(types)
    suffix, prefix = ({a.upper(): f for a, f, p in reversed(types) if p in (at, "BOTH")} for at in ("SUFFIX", "PREFIX"))
    words = F.split(F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " ")), " ")
    plain = lambda w: F.upper(F.replace(w, F.lit("."), F.lit("")))
    n = F.size(words)
    tail = lookup(suffix)[plain(F.element_at(words, -1))]
    head = lookup(prefix)[plain(F.element_at(words, 1))] if prefix else F.lit(None).cast("string")
    head = F.when(tail.isNull() | (n > 1), head)
    made = F.transform(words, lambda w, i: F.when((i == n - 1) & tail.isNotNull(), tail).when((i == 0) & head.isNotNull(), head).otherwise(w))
    return normalize(F.array_join(made, " "), keep)


def person_name(c: Column | str, keep: str = "-#") -> Column:
    return ph_to_f(normalize(c, keep))


def org_name(c: Column | str, types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES), keep: str = "-#") -> Column:
    return ph_to_f(entity(ph_to_f(F.upper(F.coalesce(col(c), F.lit("")))), types, keep))


def joined(*parts: Column | str, sep: str = " ") -> Column:
    """The parts that are not blank."""
    return F.concat_ws(sep, *[F.nullif(F.trim(col(p)), F.lit("")) for p in parts])


def words(c: Column | str) -> Column:
    """Words in lower case without those that do not count."""
    return F.filter(F.split(F.trim(F.lower(F.coalesce(col(c), F.lit("")))), r"\s+"), lambda w: (w != "") & ~w.isin(*tables.STOP_WORDS))


def linked_to(c: Column | str) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(LINKED_TO), 1), lambda x: F.trim(x)), lambda x: x != "")


def phones(c: Column | str) -> Column:
    """Phone numbers in free text that have seven digits or more."""
    return F.filter(F.transform(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(PHONE), 1), lambda x: F.trim(x)), lambda x: F.length(F.regexp_replace(x, r"\D", "")) >= 7)


def country_at_end(c: Column | str) -> Column:
    """street and country of a one-line address, whose end names a country as the list spells it; line ends and runs of spaces count as one space."""
    raw = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\r\n]+", " "), r"\s{2,}", " "))
    found = F.coalesce(*[F.when(raw.endswith(x), F.lit(x)) for x in tables.ADDRESS_COUNTRIES])
    rest = F.regexp_replace(F.substring(raw, F.lit(1), F.length(raw) - F.length(found)), r"[, ]+$", "")
    return F.struct(F.nullif(F.when(found.isNull(), raw).otherwise(rest), F.lit("")).alias("street"), found.alias("country"))
