"""Sinks: message publishing (K3) and streaming outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_messages(df: DataFrame, key_len: int = 15, value_of: str | None = None) -> DataFrame:
    """Rows as ``(key, value)`` records: a random key of ``key_len`` chars and
    the row (or the struct column ``value_of``) as JSON text; empty texts are
    skipped. Other columns of ``df`` are kept when ``value_of`` is given."""
    if value_of is None:
        value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
        rest = []
    else:
        value = F.to_json(F.col(value_of))
        rest = [c for c in df.columns if c != value_of]
    return (df.select(*rest, F.expr(f"randstr({int(key_len)})").alias("key"), value.alias("value"))
            .where(F.col("value").isNotNull() & (F.col("value") != "")))


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Write ``(key, value)`` records; with ``fmt='kafka'`` pass
    ``kafka.bootstrap.servers`` and ``topic``. The Kafka connector must be on
    the classpath; any other batch format (e.g. ``json``) works the same."""
    options = dict(options)
    path = options.pop("path", None)
    w = messages.write.format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    if fmt == "kafka":
        w.save()
    else:
        w.mode("append").save(path)
