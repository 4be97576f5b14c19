"""Projections: casts, labels, stamps, defaults, renames, text shaping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import as_ts


def cast_columns(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """P1. ``{"col": "int"}`` or ``{"col": ("date", "yyyy-MM-dd")}``.

    Bad input becomes NULL (``try_cast`` / ``try_to_date``), never an error,
    so a single malformed row cannot fail the job under ANSI mode.
    """
    cols = {}
    for name, kind in spec.items():
        c = F.col(name)
        if isinstance(kind, tuple):
            typ, fmt = kind
            if typ == "date":
                cols[name] = F.try_to_date(c.cast("string"), fmt)
            elif typ == "timestamp":
                cols[name] = F.try_to_timestamp(c.cast("string"), F.lit(fmt))
            else:
                raise ValueError(f"pattern casts support date/timestamp, not {typ}")
        else:
            cols[name] = c.try_cast(str(kind))
    return df.withColumns(cols)


def bucket(df: DataFrame, col: str, bounds: Sequence[tuple[object, str]],
           else_label: str, out: str, null_label: str | None = None) -> DataFrame:
    """P2. Range label: first ``col < upper`` wins, else ``else_label``.

    A NULL value falls through to ``else_label`` (as a CASE chain does)
    unless ``null_label`` is given.
    """
    expr = None
    c = F.col(col)
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for upper, label in bounds:
        expr = F.when(c < F.lit(upper), F.lit(label)) if expr is None else expr.when(c < F.lit(upper), F.lit(label))
    expr = F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))
    return df.withColumn(out, expr)


def label_in(df: DataFrame, col: str, values: Sequence[object], yes: str, no: str,
             out: str) -> DataFrame:
    """P3. Membership label; NULL goes to ``no``."""
    return df.withColumn(out, F.when(F.col(col).isin(list(values)), F.lit(yes)).otherwise(F.lit(no)))


def stamp(df: DataFrame, out: str, kind: str = "date", as_of=None) -> DataFrame:
    """P4. Processing date/timestamp; ``as_of`` pins it for reproducible runs."""
    if as_of is None:
        v = F.current_date() if kind == "date" else F.current_timestamp()
    else:
        v = as_ts(as_of)
        v = v.cast("date") if kind == "date" else v
    return df.withColumn(out, v)


def tenure(df: DataFrame, date_col: str, amount_col: str, as_of=None,
           years_out: str = "experience_years", ratio_out: str = "amount_per_year") -> DataFrame:
    """P5. ``years = datediff(as_of, date) / 365``; ``ratio = amount / (years + 1)``
    (NULL where that is a division by zero)."""
    ref = F.current_date() if as_of is None else as_ts(as_of).cast("date")
    years = F.datediff(ref, F.col(date_col).cast("date")) / F.lit(365)
    return df.withColumns({
        years_out: years,
        ratio_out: F.try_divide(F.col(amount_col), years + F.lit(1)),
    })


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """P6 (flat columns). NULL -> default, column created if absent."""
    cols = {}
    for name, value in defaults.items():
        if name in df.columns:
            cols[name] = F.coalesce(F.col(name), F.lit(value))
        else:
            cols[name] = F.lit(value)
    return df.withColumns(cols)


def json_fields(df: DataFrame, json_col: str, fields: Mapping[str, tuple[str, object]],
                reject_null: Sequence[str] = (), reason_col: str = "reject_reason") -> DataFrame:
    """P6 (JSON payloads). ``fields = {"name": (type, default)}``.

    A *missing* key takes the default; an explicit JSON ``null`` for a key in
    ``reject_null`` marks the row with ``reject_reason`` instead (the reference
    fails such messages). Other explicit nulls also take the default.
    """
    v = F.try_parse_json(F.col(json_col))
    cols = {}
    reason = None
    for name, (typ, default) in fields.items():
        path = f"$.{name}"
        val = F.try_variant_get(v, path, typ)
        cols[name] = val if default is None else F.coalesce(val, F.lit(default).cast(typ))
        if name in reject_null:
            is_null = F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))
            cond = F.when(is_null, F.lit(f"null:{name}"))
            reason = cond if reason is None else F.coalesce(reason, cond)
    if reject_null:
        bad_json = F.when(v.isNull(), F.lit("bad_json"))
        cols[reason_col] = F.coalesce(bad_json, reason) if reason is not None else bad_json
    return df.withColumns(cols)


def pick(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P7. Multi-field projection with rename: ``{"new": "path.to.field"}``."""
    return df.select(*[F.col(path).alias(new) for new, path in mapping.items()])


# Defaults of a notification request (recipient, subject,
# message, type) and the initial status.
NOTIFICATION_DEFAULTS = {
    "recipient": "default@example.com",
    "subject": "Bildirim",
    "message": "Merhaba!",
    "type": "email",
}
QUEUED = "queued"


def normalise_notifications(df: DataFrame, body_col: str = "body", as_of=None,
                            id_col: str | None = None) -> DataFrame:
    """P8. Request -> notification row.

    The request is either ``{"body": "<json text>"}`` / ``{"body": {...}}``
    or the bare object. ``message_id`` is ``id_col`` when given (replay-safe),
    else a SHA-256 of the raw request (stable across retries).
    Rows whose JSON cannot be parsed get ``reject_reason = 'bad_json'``.
    """
    raw = F.col(body_col)
    outer = F.try_parse_json(raw)
    inner_text = F.try_variant_get(outer, "$.body", "string")
    inner_obj = F.try_variant_get(outer, "$.body", "variant")
    body = (F.when(F.try_parse_json(inner_text).isNotNull(), F.try_parse_json(inner_text))
            .when(inner_obj.isNotNull() & F.schema_of_variant(inner_obj).startswith("OBJECT"), inner_obj)
            .otherwise(outer))
    d = NOTIFICATION_DEFAULTS
    mid = F.col(id_col).cast("string") if id_col else F.sha2(raw, 256)
    ts = F.current_timestamp() if as_of is None else as_ts(as_of)
    return df.withColumns({
        "message_id": mid,
        "timestamp": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "recipient": F.coalesce(F.try_variant_get(body, "$.recipient", "string"), F.lit(d["recipient"])),
        "subject": F.coalesce(F.try_variant_get(body, "$.subject", "string"), F.lit(d["subject"])),
        "message": F.coalesce(F.try_variant_get(body, "$.message", "string"), F.lit(d["message"])),
        "notification_type": F.coalesce(F.try_variant_get(body, "$.type", "string"), F.lit(d["type"])),
        "status": F.lit(QUEUED),
        "reject_reason": F.when(outer.isNull(), F.lit("bad_json")),
    })


_FIELD = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def template_column(template: str) -> Column:
    """``"Hi {name}!"`` -> concat('Hi ', name, '!'); NULL fields render empty."""
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(F.col(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def render(df: DataFrame, template: str, out: str) -> DataFrame:
    """P9. Text template per row."""
    return df.withColumn(out, template_column(template))


def build_requests(df: DataFrame, text_col: str, instruction: str, max_tokens: int = 1000,
                   out_prompt: str = "prompt", out_request: str = "request",
                   version: str | None = None) -> DataFrame:
    """P10. Prompt text and chat-request JSON (``max_tokens``, one user message)."""
    prompt = F.concat(F.lit(instruction), F.lit("\n\n"), F.col(text_col))
    fields = []
    if version is not None:
        fields.append(F.lit(version).alias("anthropic_version"))
    fields += [
        F.lit(int(max_tokens)).alias("max_tokens"),
        F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))).alias("messages"),
    ]
    return df.withColumns({out_prompt: prompt, out_request: F.to_json(F.struct(*fields))})


def extract_reply(df: DataFrame, body_col: str, path: str = "$.content[0].text",
                  out: str = "reply") -> DataFrame:
    """P11. Reply text out of a response JSON (NULL when absent or invalid)."""
    return df.withColumn(out, F.get_json_object(F.col(body_col), path))
