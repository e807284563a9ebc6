"""Topic and subject names, and lists in settings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.column import Column


def topic(pattern: str, namespace: Column, qualifier: Column, longest: int = 249) -> Column:
    """The topic of a table: ${table}, ${namespace} and ${qualifier} filled in (no prefix for the namespace default), then cleaned."""
    default = F.lower(namespace) == "default"
    table = F.when(default, qualifier).otherwise(F.concat(namespace, F.lit("_"), qualifier))
    t = F.lit(pattern)
    for name, value in (("table", table), ("namespace", F.when(default, "").otherwise(namespace)), ("qualifier", qualifier)):
        t = F.replace(t, F.lit(f"${{{name}}}"), value)
    return clean_topic(t, longest)


def clean_topic(t: Column, longest: int = 249) -> Column:
    """Leading . _ - go, repeats of one of them collapse, other signs become _; nothing left: topic."""
    t = F.regexp_replace(F.regexp_replace(F.trim(t), r"^[._-]+", ""), r"([._-])\1+", "$1")
    t = F.regexp_replace(t, r"[^a-zA-Z0-9._-]", "_")
    return F.substring(F.when(t.isin("", ".", ".."), "topic").otherwise(t), 1, longest)


def valid_topic(t: Column, longest: int = 249) -> Column:
    return F.coalesce(t.rlike(r"^[a-zA-Z0-9._-]+$") & ~t.isin(".", "..") & (F.length(t) <= longest), F.lit(False))


def subject(namespace: Column, qualifier: Column, strategy: str = "table", prefix: str = "", suffix: str = "-value") -> Column:
    """A schema subject: the table's name (as it is, upper, lower, or the qualifier) between prefix and suffix, cleaned."""
    name = F.when(F.lower(namespace) == "default", qualifier).otherwise(F.concat(namespace, F.lit(":"), qualifier))
    name = {"table": name, "upper": F.upper(name), "lower": F.lower(name), "qualifier": qualifier}[strategy]
    return F.regexp_replace(F.concat(F.lit(prefix), name, F.lit(suffix)), r"[^a-zA-Z0-9._-]", "_")


def families(csv: str) -> list[str]:
    """Column families of a comma list: trimmed, without repeats, in order, case kept."""
    return list(dict.fromkeys(x.strip() for x in csv.split(",") if x.strip()))


def salt_map(csv: str) -> dict[str, int]:
    """TABLE=n, TABLE:n or ns:TABLE:n (1 without n; kept within 0 to 8) of a comma list, keys in upper case."""
    out = {}
    for entry in families(csv):
        name, _, n = entry.rpartition("=" if "=" in entry else ":")
        if not name or not n.strip().lstrip("-").isdigit():
            name, n = entry, "1"
        out[name.strip().upper()] = min(8, max(0, int(n)))
    return out


def type_name(raw: str) -> str:
    """A column type's canonical name: upper case, no (...), X[] and ARRAY<X> as X ARRAY, single spaces for _ and runs; VARCHAR for an empty name."""
    import re

    t = re.sub(r"\([^)]*\)", "", raw.strip().upper()).strip()
    if t.endswith("[]"):
        t = t[:-2] + " ARRAY"
    elif m := re.fullmatch(r"ARRAY\s*<(.*)>", t):
        t = m[1] + " ARRAY"
    return " ".join(t.replace("_", " ").split()) or "VARCHAR"


#: Names of payload formats that settings may use.
FORMATS = {
    "json_each_row": ("json_each_row", "json_each", "json"),
    "avro_binary": ("avro_binary", "avro_bin", "avro", "binary"),
    "avro_json": ("avro_json", "avrojson"),
}


def payload_format(raw: str | None, default: str = "json_each_row") -> str:
    """A payload format by any of its names, whatever their case, with - for _ too; the default for others."""
    name = (raw or "").strip().lower().replace("-", "_")
    return next((k for k, names in FORMATS.items() if name in names), default)


def avro_mode(raw: str | None, default: str = "generic") -> str:
    name = (raw or "").strip().lower()
    return name if name in ("generic", "confluent") else default
