"""Text normalisation, ticket classification and entity extraction as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskstar import vocab

# Every white-space character of Unicode, and the four separators that text processing adds to them.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space at both ends (the plain ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")


def normalise_text(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def normalise_lower(c: Column) -> Column:
    return F.lower(normalise_text(c))


def normalise_key(c: Column) -> Column:
    """Upper-cased text with single blanks: the form of server names and keys."""
    return collapse_spaces(F.upper(normalise_text(c)))


def blank_to_default(c: Column, default: str | None) -> Column:
    """NULL or blank becomes ``default``; with ``None`` blanks become NULL."""
    return F.coalesce(F.nullif(strip(c.cast("string")), F.lit("")), F.lit(default).cast("string"))


def combine_first(*cols: Column) -> Column:
    return F.coalesce(*cols)


def dict_lookup(mapping: Mapping, key: Column, default: Column | None = None) -> Column:
    """Literal dictionary as a folded map expression; an absent or NULL key gives ``default``."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.create_map(*entries)[key]
    return found if default is None else F.coalesce(found, default)


def _first_match(rules: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    """CASE WHEN over (condition, label) in order."""
    start = F.when(rules[0][0], F.lit(rules[0][1]))
    return reduce(lambda acc, r: acc.when(r[0], F.lit(r[1])), rules[1:], start).otherwise(otherwise)


def _has(c: Column, *words: str) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


# --- status ------------------------------------------------------------------------------------
def map_status(code: Column, labels: Mapping[int, str] = vocab.STATUS_LABELS) -> Column:
    number = code.try_cast("bigint")
    return (
        F.when(code.isNull(), F.lit(vocab.STATUS_FALLBACK))
        .when(number.isNotNull(), dict_lookup(labels, number, F.lit(vocab.STATUS_FALLBACK)))
        .otherwise(strip(code.cast("string")))
    )


def map_status_legacy(code: Column, numeric: bool = True) -> Column:
    """Numeric columns go through the dictionary, text columns pass through lower-cased."""
    if not numeric:
        return normalise_lower(code)
    return dict_lookup(vocab.STATUS_LABELS_LEGACY, code.try_cast("bigint"), F.lit(""))


# --- customer ----------------------------------------------------------------------------------
def map_company(
    company_id: Column,
    subject: Column,
    codes: Mapping[int, str] = vocab.CUSTOMER_CODES,
    patterns: Sequence[tuple[str, str]] = vocab.CUSTOMER_PATTERNS,
) -> Column:
    return company_from(dict_lookup(codes, company_id.try_cast("bigint")), subject, patterns)


def company_from(
    code: Column, subject: Column, patterns: Sequence[tuple[str, str]] = vocab.CUSTOMER_PATTERNS
) -> Column:
    """The customer that the id stands for, wherever that was looked up, else the first one that the subject names."""
    by_id = F.nullif(code, F.lit(""))
    subject = F.coalesce(subject, F.lit(""))
    by_word = _first_match(
        [(subject.rlike(f"(?iU){pattern}"), code) for code, pattern in patterns], F.lit("")
    )
    return F.upper(strip(F.coalesce(by_id, by_word)))


def map_company_legacy(
    company_id: Column,
    names: Mapping[int, str] = vocab.CUSTOMER_NAMES_LEGACY,
    aliases: Mapping[str, str] = vocab.CUSTOMER_ALIASES_LEGACY,
) -> Column:
    name = F.upper(strip(dict_lookup(names, company_id.try_cast("bigint"))))
    return dict_lookup(aliases, name, F.lit(""))


# --- type --------------------------------------------------------------------------------------
def classify_ticket(subject: Column, lowered: Column | None = None) -> Column:
    """``lowered`` is the trimmed lower-case subject where a plan already holds it."""
    s = normalise_lower(subject) if lowered is None else lowered
    incident = (
        s.contains("incidente") | s.startswith("alert:") | s.startswith("clear:")
        | s.contains("alerta de restart")
    )
    return _first_match(
        [
            (s.contains("csi"), "CSI"),
            (s.contains("crise"), "CRISE"),
            (_has(s, "checklist", "health check", "server summary"), "Checklist"),
            (incident, "Incidente"),
        ],
        F.lit("Outros"),
    )


def classify_ticket_legacy(ticket_type: Column, subject: Column) -> Column:
    declared = normalise_lower(ticket_type)
    s = normalise_lower(subject)
    from_subject = _first_match(
        [
            (s.startswith("csi"), "CSI"),
            (_has(s, "checklist", "health check", "server summary"), "Checklist"),
            (
                s.startswith("alert:") | s.startswith("clear:") | s.contains("alerta de restart"),
                "Incidentes",
            ),
        ],
        declared,
    )
    return dict_lookup(vocab.TYPE_ALIASES_LEGACY, declared, from_subject)


# --- title -------------------------------------------------------------------------------------
def _drop_prefixes(s: Column, customers: Sequence[str]) -> Column:
    """Strip the three leading marks in order; a text without the mark's sign skips its pattern."""
    rest = s
    for sign, pattern in (
        (":", r"(INFO(?:\s+\w+)?)\s*:\s*"),
        (":", r"(ALERT|CLEAR)\s*:\s*"),
        ("-", rf"({'|'.join(customers)})\s*-\s*"),
    ):
        # What is left is a part of ``s``, so ``s`` decides for every step.
        shorter = F.regexp_replace(rest, f"(?iU)^{pattern}", "")
        rest = F.when(s.contains(sign), shorter).otherwise(rest)
    return rest


def clean_title(
    subject: Column,
    ticket_type: Column,
    customers: Sequence[str] = vocab.TITLE_CUSTOMERS,
    trimmed: bool = False,
) -> Column:
    """``trimmed`` says that the subject is normalised text already."""
    s = subject if trimmed else normalise_text(subject)
    kept = F.when(ticket_type == "CSI", s).otherwise(_drop_prefixes(s, customers))
    return strip(collapse_spaces(kept))


def clean_title_legacy(
    subject: Column,
    ticket_type: Column,
    customers: Sequence[str] = vocab.TITLE_CUSTOMERS_LEGACY,
    trimmed: bool = False,
) -> Column:
    s = subject if trimmed else normalise_text(subject)
    return F.when(normalise_lower(ticket_type) == "csi", s).otherwise(
        strip(_drop_prefixes(s, customers))
    )


# --- improvement status --------------------------------------------------------------------------
def _is_csi(ticket_type: Column) -> Column:
    return F.upper(normalise_text(ticket_type)) == "CSI"


def csi_status_gate(status: Column, ticket_type: Column) -> Column:
    return F.when(_is_csi(ticket_type), normalise_text(status)).otherwise("na")


def csi_status_gate_legacy(status: Column, ticket_type: Column) -> Column:
    kept = _is_csi(ticket_type) & status.isNotNull()
    return F.when(kept, normalise_lower(status)).otherwise("na")


# --- technology and environment --------------------------------------------------------------------
def detect_dbms(field: Column, subject: Column, uppered: Column | None = None) -> Column:
    s = F.upper(normalise_text(subject)) if uppered is None else uppered
    from_subject = _first_match(
        [(_has(s, *words), label) for label, words in vocab.DBMS_KEYWORDS], F.lit("")
    )
    return F.coalesce(F.nullif(F.upper(normalise_text(field)), F.lit("")), from_subject)


def normalise_environment(c: Column) -> Column:
    text = normalise_text(c)
    labels = {word: label for label, words in vocab.ENVIRONMENT_SYNONYMS.items() for word in words}
    return dict_lookup(labels, F.upper(text), text)


def environment_macro(c: Column) -> Column:
    """Two-way class by the substring ``prod``, so a label that negates it is production too."""
    text = normalise_lower(c)
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .when(text.contains("prod"), vocab.ENVIRONMENT_MACROS[0])
        .otherwise(vocab.ENVIRONMENT_MACROS[1])
    )


# --- server and instance ---------------------------------------------------------------------------
def extract_instance(subject: Column, trimmed: bool = False) -> Column:
    s = subject if trimmed else normalise_text(subject)
    found = F.upper(strip(F.regexp_extract(s, r"\(([^)]+)\)", 1)))
    return F.when(s.contains("("), found).otherwise("")


def extract_server(
    subject: Column,
    patterns: Sequence[tuple[str, str]] = vocab.SERVER_PATTERNS,
    stop_words: Sequence[str] = (),
    min_length: int = 5,
    lowered: Column | None = None,
) -> Column:
    """First valid candidate: patterns in order, every match of a pattern in text order.

    ``coalesce`` stops at the first pattern that yields a valid name, and a pattern is tried only
    where its literal occurs. Four letters outside ASCII fold to letters of the literals, so a text
    that has one of them is always tried. ``stop_words`` (upper case) are no names; plain words need
    not be listed, as a name holds a digit, dot, underscore or hyphen. ``lowered`` is given where a plan holds the subject
    trimmed and in lower case already.
    """
    s = normalise_text(subject) if lowered is None else subject
    low = F.lower(s) if lowered is None else lowered
    folding = (F.octet_length(s) > F.char_length(s)) & _has(s, "\u017f", "\u212a", "\u0131", "\u0130")

    def candidate_ok(x: Column) -> Column:
        technical = x.rlike(r"[0-9._\-]")
        ok = (F.length(x) >= min_length) & technical
        return ok & ~x.isin(*stop_words) if stop_words else ok

    def first_valid(literal: str, pattern: str) -> Column:
        matches = F.regexp_extract_all(s, F.lit(f"(?iU){pattern}"), F.lit(1))
        found = F.filter(F.transform(matches, lambda m: normalise_key(m)), candidate_ok)
        return F.when(low.contains(literal) | folding, F.get(found, 0))

    return F.coalesce(*[first_valid(*p) for p in patterns], F.lit(""))


def logical_server(subject: Column, lowered: Column | None = None, **options) -> Column:
    """Struct (nome_servidor, instancia); without a name the instance stands for both."""
    name = extract_server(subject, lowered=lowered, **options)
    instance = extract_instance(subject, trimmed=lowered is not None)
    return F.struct(
        F.coalesce(F.nullif(name, F.lit("")), instance).alias("nome_servidor"),
        instance.alias("instancia"),
    )


def server_natural_key(host: Column, instance: Column) -> Column:
    return normalise_key(F.coalesce(F.nullif(normalise_text(host), F.lit("")), instance))
