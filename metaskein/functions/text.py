"""Text, identity and formatting expressions (built-in functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cardinality assumed when a column pair carries none, the schemas
# left out when no schema pattern is given, and the id of a nameless set.
DEFAULT_CARDINALITY = "1,1,0,-1"
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")
MISSING_SET_ID = "___DOES_NOT_EXIST___"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(c: Column | str) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and spaces-only text; never NULL."""
    return F.length(F.trim(or_empty(c))) == 0


def blank_to_null(c: Column | str) -> Column:
    """The untrimmed value, or NULL when it is blank."""
    return F.when(~is_blank(c), col(c))


def first_filled(*cols: Column | str) -> Column:
    """First value that is not blank, untrimmed."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def default_to(c: Column | str, value) -> Column:
    return F.coalesce(col(c), F.lit(value))


def norm(c: Column | str) -> Column:
    """Lower-cased and trimmed: the form in which names are compared."""
    return F.lower(F.trim(col(c)))


def folded(c: Column | str) -> Column:
    """``norm`` with NULL as the empty string."""
    return F.lower(F.trim(or_empty(c)))


def strip_array_prefix(c: Column | str) -> Column:
    """Type name without leading underscores: ``_int4`` and ``int4`` compare equal."""
    return F.ltrim(col(c), F.lit("_"))


def yes_flag(c: Column | str) -> Column:
    """'YES' is true; anything else, also NULL, is false."""
    return F.coalesce(col(c) == "YES", F.lit(False))


# --- names -----------------------------------------------------------------


def fqdn(*parts: Column | str) -> Column:
    """Dotted name in which a NULL part counts as empty text."""
    return F.concat(*_dotted([or_empty(p) for p in parts]))


def fqdn_strict(*parts: Column | str) -> Column:
    """Dotted name that is NULL as soon as one part is."""
    return F.concat(*_dotted([col(p) for p in parts]))


def _dotted(parts: list[Column]) -> list[Column]:
    out = parts[:1]
    for p in parts[1:]:
        out += [F.lit("."), p]
    return out


def fqdn_part(c: Column | str, index: int) -> Column:
    """Zero-based part of a dotted name, NULL when there are fewer parts."""
    return F.get(F.split(col(c), "\\."), F.lit(index))


def set_id(name: Column | str) -> Column:
    return F.coalesce(F.lower(col(name)), F.lit(MISSING_SET_ID))


def item_id(name: Column | str) -> Column:
    return norm(name)


def endpoint_stub(full: Column | str, schema, set_nm, item) -> Column:
    """Id of a foreign-key endpoint: its full name, else schema.set.item."""
    own = F.when(F.length(col(full)) > 0, col(full))
    return F.lower(F.coalesce(own, fqdn(schema, set_nm, item)))


def pair_id(parent_stub: Column | str, child_stub: Column | str) -> Column:
    return F.concat(F.lower(col(parent_stub)), F.lit("::"), F.lower(col(child_stub)))


# --- filters ---------------------------------------------------------------


def schema_matches(c: Column | str, patterns: list[str] | None = None) -> Column:
    """OR of case-sensitive LIKE patterns with ``*`` as wildcard.

    Without patterns: everything outside the system schemas. ``_`` keeps its
    LIKE meaning of one arbitrary character.
    """
    if not patterns:
        return ~col(c).isin(*SYSTEM_SCHEMAS)
    likes = [col(c).like(p.replace("*", "%")) for p in patterns]
    return reduce(lambda a, b: a | b, likes)


def is_view(type_col: Column | str) -> Column:
    return F.upper(or_empty(type_col)).contains("VIEW")


def is_primary(key_type: Column | str) -> Column:
    return F.lower(or_empty(key_type)).contains("primary")


# --- cardinality, percentages ----------------------------------------------


def cardinality_array(c: Column | str) -> Column:
    """'1,1,0,-1' as an int array; a part that is no number counts as 0."""
    text = F.coalesce(F.when(F.length(col(c)) > 0, col(c)), F.lit(DEFAULT_CARDINALITY))
    return F.transform(
        F.split(text, ","),
        lambda e: F.coalesce(F.trim(e).try_cast("int"), F.lit(0)),
    )


def cardinality_text(numbers: Column | str) -> Column:
    """Array of numbers as comma-separated integers."""
    return F.array_join(F.transform(col(numbers), lambda e: e.cast("int").cast("string")), ",")


def null_percentage_text(c: Column | str) -> Column:
    """Two decimals, or '0' when the integer part is zero."""
    return F.when(col(c).cast("int") == 0, F.lit("0")).otherwise(F.format_number(col(c), 2))


# --- keys held by an item ---------------------------------------------------


def primary_key_of(keys: Column | str) -> Column:
    """First primary key by name out of array<struct<name,type,...>>, or NULL."""
    by_name = F.array_sort(
        F.filter(col(keys), lambda k: is_primary(k["type"])),
        lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0),
    )
    return F.get(by_name, F.lit(0))
