"""Sinks: upsert, guarded delete, run records, guards and the published projection.

Writers publish a new version of a table beside the old one (see :mod:`.versions`), so a table can be rewritten from
itself, readers of the old version are undisturbed, and a re-run with the same input gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.text import blank, csv_safe, miss_note, rounded
from . import versions

PROTECTED = ("status", "notes")


def upsert(old: DataFrame, new: DataFrame, key: str, protected=PROTECTED, sparse: bool = False) -> DataFrame:
    """Insert unknown keys, update known ones; protected columns keep the old row's value.

    With ``sparse`` a null in ``new`` leaves the old value alone (a found value is never blanked).
    """
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    in_old, in_new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    cols = [F.coalesce(f"o.{key}", f"n.{key}").alias(key)]
    for c in [c for c in old.columns if c != key]:
        if c not in new.columns:
            cols.append(F.col(f"o.{c}").alias(c))
            continue
        updated = F.coalesce(f"n.{c}", f"o.{c}") if sparse else F.col(f"n.{c}")
        keep_old = in_old & (F.lit(c in protected) | ~in_new)
        cols.append(F.when(keep_old, F.col(f"o.{c}")).otherwise(updated).alias(c))
    return both.select(*cols)


def guarded_delete(df: DataFrame, key: str, targets: DataFrame, max_rows=V.DELETE_MAX_ROWS, max_fraction=V.DELETE_MAX_FRACTION) -> DataFrame:
    """Delete matched rows only when few enough in number *and* share; otherwise refuse all.

    The two counts are scalar subqueries in the filter on the rows to delete: nothing is brought
    to the driver by hand, and a refusal leaves the table as it is.
    """
    hit = df.select(key).join(targets.select(key).distinct(), key, "left_semi")
    n, k = (x.agg(F.count(F.lit(1))).scalar() for x in (df, hit))
    return df.join(hit.where((k <= max_rows) & (k <= n * max_fraction)), key, "left_anti")


def enum_guard(df: DataFrame, col: str, allowed, allow_new: bool = False) -> DataFrame:
    """Fail the job on the first value that is not an existing option (unless opted in)."""
    if allow_new:
        return df
    known = F.col(col).isNull() | F.col(col).isin(*allowed)
    checked = F.when(known, F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit(f"value not an option of {col}: "), F.col(col).cast("string"))).cast("string"))
    return df.withColumn(col, checked)


def unknown_options(df: DataFrame, col: str, allowed) -> DataFrame:
    """Values to be written that are not existing options, with their row counts."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed)).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def sparse_patch(df: DataFrame, id_col: str, value_col: str, source_col: str, note=None) -> DataFrame:
    """Patch rows: the value when found, and always a reason why not when it was not."""
    value = F.when(~blank(value_col), csv_safe(value_col))
    source = F.when(~blank(source_col), F.col(source_col)).otherwise(miss_note(F.lit(None).cast("string") if note is None else note))
    return df.select(id_col, value.alias("email"), csv_safe(source).alias("email_source"))


def top_reasons(df: DataFrame, run_cols, reason_col: str, count_col: str, top: int = V.TOP_DROP_REASONS) -> DataFrame:
    """The ``top`` most frequent reasons per run and how many were cut off."""
    totals = df.groupBy(*run_cols).agg(F.count(F.lit(1)).alias("_reasons"))
    w = Window.partitionBy(*run_cols).orderBy(F.desc(count_col), F.asc(reason_col))
    best = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).drop("_rn")
    return best.join(totals, list(run_cols)).select(
        *run_cols, reason_col, count_col, F.greatest(F.lit(0), F.col("_reasons") - top).cast("bigint").alias("truncated"))


def append_run_records(df: DataFrame, path: str) -> None:
    """One JSON line per run, appended."""
    df.write.mode("append").json(path)


def write_snapshot(df: DataFrame, path: str, partition_by=(), unique: str | None = None) -> int:
    """Publish ``df`` as the next version of the table; with ``unique`` only if no two rows share that key."""

    def check(written: DataFrame) -> None:
        if written.groupBy(unique).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            raise ValueError(f"{unique} is not unique in the new version of {path}")

    return versions.publish(df, path, partition_by, check if unique else None)


def read_snapshot(spark, path: str, back: int = 0) -> DataFrame:
    return versions.current(spark, path, back)


def upsert_snapshot(new: DataFrame, path: str, key: str, protected=PROTECTED, sparse: bool = False) -> int:
    """Upsert into the table that is read and written in one go."""
    old = read_snapshot(new.sparkSession, path)
    return write_snapshot(upsert(old, new, key, protected, sparse).select(*old.columns), path, unique=key)


def delete_from_snapshot(targets: DataFrame, path: str, key: str, max_rows=V.DELETE_MAX_ROWS, max_fraction=V.DELETE_MAX_FRACTION) -> int:
    """Guarded delete from the table itself; a refusal publishes the same rows again."""
    return write_snapshot(guarded_delete(read_snapshot(targets.sparkSession, path), key, targets, max_rows, max_fraction), path)


def published_rows(df: DataFrame, sink_columns=None, source_label: str = "discovery", day: str | None = None) -> DataFrame:
    """Final projection: rounded metrics, cadence text, formula-safe text, optional columns only where the sink has them."""
    keywords = F.array_join("matched_keywords", ", ") if "matched_keywords" in df.columns else F.lit("")
    cols = {
        "entity_id": F.col("entity_id"),
        "title": csv_safe("title"),
        "subscribers": F.col("subscribers"),
        "avg_views": rounded("avg_views", 1),
        "engagement_rate": rounded("engagement_rate", 2),
        "upload_frequency": F.concat(F.bround("per_month", 0).cast("bigint").cast("string"), F.lit(" videos/month")),
        "language": csv_safe(F.coalesce(F.nullif("language", F.lit("")), F.lit("Unknown"))),
        "email": csv_safe("email"),
        "risk": F.col("risk"),
        "score": F.col("score"),
        "qualification": F.col("qualification"),
        "status": F.lit("New"),
        "source": csv_safe(F.concat(F.lit(f"{source_label} ("), keywords, F.lit(")"))),
        "notes": F.lit(""),
        "niche": F.col("niche"),
        "date_added": F.lit(day),
    }
    optional = {"handle": "handle", "relevance_state": "relevance_state", "email_source": "email_source"}
    for name, col in optional.items():
        if col in df.columns and sink_columns is not None and name in sink_columns:
            cols[name] = csv_safe(col)
    return df.select(*[c.alias(n) for n, c in cols.items()])
