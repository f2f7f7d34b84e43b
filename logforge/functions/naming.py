"""Application and subsystem names, and severities, as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from logforge.functions.text import json_at

# The template forms a configured name may have.
JSON_TEMPLATE = r"\{\{\s*\$\.([a-zA-Z0-9._]+)\s*\}\}"
META_TEMPLATE = r"\{\{\s*(?P<key>[a-z\.0-9_]+)\s*\}\}"
META_REGEX_TEMPLATE = r"\{\{\s*(?P<key>[a-z\.0-9_]+)\s*\|?\s*r'(?P<regex>.*)'\s*\}\}"
UNKNOWN_APPLICATION = "unknown-application"
UNKNOWN_SUBSYSTEM = "unknown-subsystem"
NO_APPLICATION = "NO APPLICATION NAME"
NO_SUBSYSTEM = "NO SUBSYSTEM NAME"

# Severity keywords from the strongest down, and the public OTLP numbers.
SEVERITY_KEYWORDS = [
    ("Critical", ["fatal", "panic", "critical"]),
    ("Error", ["error"]),
    ("Warn", ["warn"]),
    ("Info", ["info"]),
    ("Verbose", ["verbose", "trace"]),
    ("Debug", ["debug"]),
]
SEVERITY_NUMBERS = {"Verbose": 1, "Debug": 5, "Info": 9, "Warn": 13, "Error": 17, "Critical": 21}


def java_pattern(pattern: str) -> str:
    """Write named groups the way Java knows them: ``(?P<n>`` → ``(?<n>``, no ``_``."""
    return re.sub(
        r"\(\?P?<([A-Za-z_][A-Za-z0-9_]*)>", lambda m: f"(?<{m[1].replace('_', 'U')}>", pattern
    )


def group_names(pattern: str) -> list[str]:
    """Names of the named groups, in order."""
    return re.findall(r"\(\?P?<([A-Za-z_][A-Za-z0-9_]*)>", pattern)


def group_count(pattern: str) -> int:
    """Number of capture groups; escapes and character classes do not count."""
    bare = re.sub(r"\\.", "", pattern)
    bare = re.sub(r"\[\^?\]?[^\]]*\]", "", bare)
    return len(re.findall(r"\((?!\?)|\(\?P?<[A-Za-z_]", bare))


def _variant_path(dotted: str) -> str | None:
    """Path of nested keys; None if a key can't be written down in one."""
    steps = []
    for key in dotted.split("."):
        quote = '"' if "'" in key else "'"
        if quote in key:
            return None
        steps.append(f"[{quote}{key}{quote}]")
    return "".join(steps)


def json_name(log: Column, json: Column, dotted: str) -> Column:
    """Text of the string, number or boolean at a dotted path of object keys.

    NULL when the log is not JSON, the path is missing, or the value is null, an array
    or an object. A VARIANT forgets that 1.0 had a fraction, so number text is cut from
    the source text unless a repeated key makes the two disagree.
    """
    if not all(dotted.split(".")):
        return F.lit(None).cast("string")
    path = _variant_path(dotted)
    if path is None:
        return F.lit(None).cast("string")
    value = json_at(json, path)
    kind = F.schema_of_variant(value)
    number = F.get_json_object(log, "$" + path.replace('"', "'"))
    number = F.regexp_replace(number, r"(\.[0-9]*[1-9])0+$", "$1")
    number = F.regexp_replace(number, r"\.0+$", ".0")
    same = number.try_cast("double") == value.cast("double")
    number = F.when(same, number).otherwise(value.cast("string"))
    return (
        F.when(kind.isin("STRING", "BOOLEAN"), value.cast("string"))
        .when((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"), number)
    )


def meta_name(template: str, meta: Column) -> Column | None:
    """Evaluate ``{{ key }}`` or ``{{ key | r'regex' }}``; None when it is neither."""
    form = META_REGEX_TEMPLATE if "|" in template else META_TEMPLATE
    found = re.search(form, template)
    if not found:
        return None
    value = F.try_element_at(meta, F.lit(found["key"]))
    regex = java_pattern(found.groupdict().get("regex") or "")
    if not regex:
        return value
    groups = [
        F.nullif(F.regexp_extract(value, regex, i), F.lit(""))
        for i in range(1, group_count(regex) + 1)
    ]
    return F.coalesce(*groups, value)


def resolve_name(configured: str, unknown: str, log: Column, json: Column, meta: Column) -> Column:
    """A configured name for each record: JSON path, metadata template, or plain text.

    A plain text is tried as a JSON path first. A text is a template as soon as it starts
    with ``{{`` or ends with ``}}``; one that gives nothing becomes ``unknown`` if it has
    both, else the text itself.
    """
    found = re.search(JSON_TEMPLATE, configured)
    from_log = None
    if found or "{{" not in configured:
        from_log = json_name(log, json, found[1] if found else configured)
    if not configured.startswith("{{") and not configured.endswith("}}"):
        rest = F.lit(configured)
    else:
        whole = configured.startswith("{{") and configured.endswith("}}")
        fallback = F.lit(unknown if whole else configured)
        value = meta_name(configured, meta)
        rest = fallback if value is None else F.coalesce(value, fallback)
    return rest if from_log is None else F.coalesce(from_log, rest)


def severity(log: Column, detect: bool = True) -> Column:
    """Severity by keyword anywhere in the text; Info when none occurs."""
    if not detect:
        return F.lit("Info")
    text = F.lower(log)
    column = None
    for name, words in SEVERITY_KEYWORDS:
        hit = F.contains(text, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(text, F.lit(word))
        column = F.when(hit, name) if column is None else column.when(hit, name)
    return column.otherwise("Info")


def severity_number(name: Column) -> Column:
    column = None
    for text, number in SEVERITY_NUMBERS.items():
        column = F.when(name == text, number) if column is None else column.when(name == text, number)
    return column
