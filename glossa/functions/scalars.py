"""Scalar functions as Column -> Column expressions (no Python UDFs).

Whitespace follows Python's ``str.split()`` / ``str.strip()``: the loader that
defines the corpus semantics splits and trims on Unicode whitespace, while
Spark's ``trim`` only removes spaces and Java's ``\\s`` is ASCII-only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossa.schemas import EXPORT_MIN_CONFIDENCE

# The characters Python treats as whitespace in str.split()/str.strip()
# (Java regex escapes), so splitting and trimming match the loader.
WS_CLASS = "[\\t\\n\\u000B\\f\\r\\u001C-\\u001F \\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
WS_RUN = WS_CLASS + "+"
_TRIM = f"^{WS_RUN}|{WS_RUN}$"

# ISO code normalisation (lower-cased, '-' removed) -> stored code.
ISO_CANONICAL = {
    "itit": "it-IT", "it": "it-IT",
    "fifi": "fi-FI", "fi": "fi-FI",
    "enen": "en-EN", "en": "en-EN",
    "und": "und",
}



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_hash(text, variant_id) -> Column:
    """G1: SHA-256 hex of the text followed by the variant id (UTF-8)."""
    return F.sha2(F.concat(_c(text), _c(variant_id).cast("string")), 256)


def trim_ws(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Spark's trim strips spaces only)."""
    return F.regexp_replace(_c(c), _TRIM, "")


def split_ws(c) -> Column:
    """Whitespace split without empty pieces (Python ``str.split()``)."""
    return F.filter(F.split(_c(c), WS_RUN), lambda t: t != F.lit(""))


def first_piece(c, sep: str = "?") -> Column:
    """Text before the first ``sep`` (whole text when absent)."""
    return F.split_part(_c(c), F.lit(sep), F.lit(1))


def fold(c) -> Column:
    """Case-folded, trimmed text: the lemma dedup key."""
    return F.lower(trim_ws(c))


def normalize_iso(c, strip_underscore: bool = False) -> Column:
    """Lower-case and drop '-', map the known codes, otherwise keep the value as received."""
    key = F.lower(F.replace(_c(c), F.lit("-"), F.lit("")))
    if strip_underscore:
        key = F.replace(key, F.lit("_"), F.lit(""))
    mapping = F.create_map(*[F.lit(x) for kv in ISO_CANONICAL.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, key), _c(c))


def map_or_keep(c, mapping: dict) -> Column:
    """Value map with passthrough for unknown values."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(c)), _c(c))


def strict_bool(c) -> Column:
    """Only boolean true is true; missing and NULL are false.

    The input is a boolean-typed field of a declared schema, so the JSON text
    ``"true"`` never arrives as true (the reader leaves it NULL).
    """
    return F.coalesce(_c(c), F.lit(False))


def json_object(**cols) -> Column:
    """JSON object with NULL members kept."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in cols.items()]), {"ignoreNullFields": "false"})


def json_text(json_col, path: str) -> Column:
    """Text of a JSON member (``->>``)."""
    return F.get_json_object(_c(json_col), path if path.startswith("$") else f"$.{path}")


def has_path(json_col, key: str) -> Column:
    """The document has ``key`` with a non-null value."""
    return F.get_json_object(_c(json_col), f"$.{key}").isNotNull()


def parsed(json_col) -> Column:
    """G10/G11 on many members: the document parsed once into a VARIANT; malformed text is NULL."""
    return F.try_parse_json(_c(json_col))


def variant_text(doc, path: str) -> Column:
    """G11 on a parsed document: the member's text; NULL when it is missing or null."""
    return F.try_variant_get(_c(doc), path if path.startswith("$") else f"$.{path}", "string")


def member_state(doc, key: str) -> Column:
    """G10 on a parsed document: 'value', 'null' (the member is there and null) or 'missing'; NULL without a document."""
    member = F.try_variant_get(_c(doc), f"$.{key}", "variant")
    return (F.when(_c(doc).isNull(), F.lit(None).cast("string")).when(member.isNull(), F.lit("missing"))
             .when(F.is_variant_null(member), F.lit("null")).otherwise(F.lit("value")))


def in_order(c, collation: str | None = None) -> Column:
    """What a text sorts by: itself (binary order), or itself under a collation ("UNICODE", "UNICODE_CI_AI", "de", ...).

    Different texts may be equal under a collation: add the plain text behind it where the order must be total.
    """
    return F.collate(_c(c), collation) if collation else _c(c)


def score(c) -> Column:
    """NUMERIC(5,2)."""
    return _c(c).cast("decimal(5,2)")


def asset_format(kind) -> Column:
    """Audio -> mp3, anything else -> jpg."""
    return F.when(_c(kind) == "audio", F.lit("mp3")).otherwise(F.lit("jpg"))


def load_stamp(date: str | None = None) -> Column:
    """Load date; pass a fixed date for repeatable runs."""
    return F.lit(date).cast("date") if date else F.current_date()


# --- predicates -------------------------------------------------------------

def has_member(array_col, value) -> Column:
    """``value = ANY(array)`` (NULL when the array is NULL)."""
    return F.array_contains(_c(array_col), value)


def present(c) -> Column:
    """Neither NULL nor the empty string (whitespace-only text is kept)."""
    return _c(c).isNotNull() & (_c(c) != F.lit(""))


def valid_confidence(c) -> Column:
    """NULL or within [0, 1]."""
    return _c(c).isNull() | _c(c).between(0.0, 1.0)


def eligible(variant_id="variant_id", confidence="variant_confidence",
             min_conf: float = EXPORT_MIN_CONFIDENCE) -> Column:
    """Classified and confident enough for export; NULL confidence is excluded."""
    return _c(variant_id).isNotNull() & (_c(confidence) >= F.lit(min_conf))


def not_admin(claim) -> Column:
    """``claim != 'admin'`` keeps SQL's three-valued logic (a missing claim is not true)."""
    return _c(claim) != F.lit("admin")
