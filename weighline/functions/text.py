"""Text functions: names, paths and alert wording."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weighline import settings as S
from weighline.functions import times


def clean_text(value: Column) -> Column:
    return F.btrim(value.cast("string"), F.lit(" \t\r\n"))


def safe_article(value: Column) -> Column:
    """Article folder: letters, digits, blanks, dashes and underscores."""
    return F.regexp_replace(clean_text(value), r"[^\p{L}\p{N} _-]", "")


def safe_batch(value: Column) -> Column:
    """Batch folder: letters, digits, dots, underscores and dashes."""
    return F.regexp_replace(value, r"[^\p{L}\p{N}._-]", "")


def topic_folder(topic: Column) -> Column:
    return F.replace(topic, F.lit("/"), F.lit("_"))


def last_segment(topic: Column) -> Column:
    return F.element_at(F.split(topic, "/"), -1)


def virtual_topic(topic: Column, line: Column) -> Column:
    return F.concat(topic, F.lit("/"), line)


def topic_regex(pattern: str) -> str:
    """Regular expression of a topic subscription (``+`` = one level, trailing ``#`` = this level and below)."""
    parts = pattern.split("/")
    deep = parts[-1] == "#"
    body = "/".join("[^/]+" if p == "+" else "".join("\\" + c if c in r".^$*?()[]{}|\+" else c for c in p)
                    for p in (parts[:-1] if deep else parts))
    if not deep:
        return f"^{body}$"
    return f"^{body}(/.*)?$" if body else "^.*$"


def format_line(raw: Column) -> Column:
    """Display name of a line: ``Linea_07`` gives ``LINEA 07``."""
    s = clean_text(raw)
    number = F.regexp_extract(s, S.LINE_NUMBER_PATTERN, 1)
    return (
        F.when(raw.isNull() | (raw == ""), "N/A")
        .when(F.upper(s).contains("PARADA"), s)
        .when(number != "", F.concat(F.lit("LINEA "), number))
        .otherwise(F.upper(F.replace(s, F.lit("_"), F.lit(" "))))
    )


def gap_text(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("bigint")
    return F.format_string("%dh %dm", F.floor(whole / 3600), F.floor(F.pmod(whole, F.lit(3600)) / 60))


def display_time(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    return F.coalesce(times.local_text(ts, "HH:mm:ss", zone), F.lit("--:--"))


def display_date(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    return times.local_text(ts, "dd/MM/yyyy", zone)


def stop_message(line: Column, product: Column, silence_seconds: Column) -> Column:
    return F.format_string(S.STOP_MESSAGE, line, F.floor(silence_seconds / 60).cast("bigint"), product)


def return_message(product: Column, origin_line: Column, ended: Column, gap_seconds: Column,
                   zone: str = S.FACTORY_ZONE) -> Column:
    return F.format_string(S.RETURN_MESSAGE, product, origin_line, times.local_text(ended, "HH:mm:ss", zone),
                           gap_seconds / 3600)


def alert_subject(alert_type: Column, topic: Column) -> Column:
    return F.format_string(S.SUBJECT, alert_type, topic)
