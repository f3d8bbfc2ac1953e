"""Column expressions shared by the plans. All stay inside Spark's built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buildlens import schemas

# A digest is read as pieces of 15 hex digits, 60 bits each, and every piece as three 20-bit words.
FINGERPRINT_PIECES = 3
PIECE_DIGITS = 15
WORD_BITS = 20


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds between two instants, counting second boundaries: 00.9 to 02.8 is 2."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def composite_key(*ids: Column, attempt: Column) -> Column:
    """``id[_id...]_attempt`` with a missing attempt read as 1; NULL when any id is NULL."""
    parts = [i.cast("string") for i in ids]
    return F.concat(*[x for p in parts for x in (p, F.lit("_"))], F.coalesce(attempt.cast("string"), F.lit("1")))


def is_state(state: Column, *wanted: str) -> Column:
    """Membership flag that is false, not NULL, for a NULL state."""
    return F.coalesce(state.isin(*wanted), F.lit(False))


def severity(priority: Column) -> Column:
    return F.when(priority.isin(*schemas.CRITICAL_PRIORITIES), "CRITICAL").otherwise("MEDIUM")


def text_or_none(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("None"))


def failure_context(workflow: Column, step: Column, reason: Column) -> Column:
    """The one-line summary a fallback classifier reads."""
    return F.concat(
        F.lit("Workflow: "), text_or_none(workflow),
        F.lit(" | Step: "), text_or_none(step),
        F.lit(" | Reason: "), text_or_none(reason),
    )


def folded(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def mentions(text: Column, token: str) -> Column:
    """Case-insensitive contains; false for NULL."""
    return F.coalesce(F.lower(text).contains(token.lower()), F.lit(False))


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of one row over its columns in name order."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\u0001", *cells), 256)


def record_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """:func:`row_hash` over the whole row, or some columns; nested values count as their JSON text, nulls included."""
    simple = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    cells = []
    for name in sorted(columns or df.columns):
        plain = isinstance(df.schema[name].dataType, simple)
        text = F.col(name).cast("string") if plain else F.to_json(F.col(name), {"ignoreNullFields": "false"})
        cells.append(F.coalesce(text, F.lit("∅")))
    return F.sha2(F.concat_ws("\u0001", *cells), 256)


def batch_fingerprint(digest: Column) -> Column:
    """Order-independent fingerprint of the rows of a group, as an aggregate over ``row_hash``.

    The digest is cut into words and the words are summed, so the group is combined map-side and
    never gathered in one task. A 20-bit word leaves room for 2**43 rows per group.
    """
    words = []
    for i in range(FINGERPRINT_PIECES):
        piece = F.conv(F.substring(digest, 1 + i * PIECE_DIGITS, PIECE_DIGITS), 16, 10).cast("bigint")
        for shift in (2 * WORD_BITS, WORD_BITS, 0):
            words.append(F.sum(F.shiftright(piece, shift).bitwiseAND((1 << WORD_BITS) - 1)))
    return F.sha2(F.concat_ws(":", F.count(digest), *words), 256)


def hashable(df: DataFrame) -> list[Column]:
    """Every column in a form Spark can hash or sort."""
    simple = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [
        F.col(f.name) if isinstance(f.dataType, simple) else F.to_json(F.struct(F.col(f.name))) for f in df.schema.fields
    ]
