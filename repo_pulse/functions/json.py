"""JSON access with warehouse `json_value` semantics.

A payload is parsed once with ``from_json`` into a struct whose scalar leaves
are STRING (so ``"12"`` and ``12`` both reach the safe casts). ``from_json``
hands back the JSON text of an object or array held in a string leaf, while
``json_value`` yields NULL there. Only text that starts with ``{`` or ``[``
can be such a container, so only those suspects are re-checked on a Variant
parse of the payload; ordinary values never pay for a second parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _is_container(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def json_scalar(text: Column, payload: Column, path: str) -> Column:
    """Scalar at ``path`` as STRING; NULL when it is an object or array.

    ``text`` is the string leaf from the one ``from_json`` parse and
    ``payload`` the raw JSON text it came from.
    """
    suspect = text.startswith("{") | text.startswith("[")
    node = F.try_variant_get(F.try_parse_json(payload), path, "variant")
    return F.when(suspect, F.when(_is_container(node), F.lit(None)).otherwise(text)).otherwise(text)


def json_scalar_in_variant(v: Column, path: str) -> Column:
    """Scalar at ``path`` inside a Variant, as STRING; NULL for containers."""
    node = F.try_variant_get(v, path, "variant")
    return F.when(_is_container(node), F.lit(None)).otherwise(F.try_variant_get(v, path, "string"))


def label_names_csv(labels: Column) -> Column:
    """Comma-joined non-NULL ``name`` scalars of an ``array<variant>``, in order.

    A missing, JSON null or non-array ``labels`` gives ``''`` (never NULL).
    """
    names = F.transform(labels, lambda lab: json_scalar_in_variant(lab, "$.name"))
    return F.coalesce(F.array_join(names, ","), F.lit(""))


def parse_payload(payload: Column, schema: str) -> Column:
    """One ``from_json`` for every path read from a payload (parse once)."""
    return F.from_json(payload, schema)
