"""Section ingest and table maintenance: inserts, upserts, change detection.

Inputs are reduced to one row per key before any join, so join keys are unique
on both sides and cannot be skewed.  Every operator returns a new snapshot;
nothing overwrites what is being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidenza.functions.text import capitalize, empty_to_null, strip

# Fixed values of the ingest rules.
MIN_SECTION_CHARS = 20
DEFAULT_LANGUAGE = "en"
AUDIT_COLUMNS = ("downloaded_at", "processed_at", "scraped_at")


# --- structured documents ---------------------------------------------------


def country_name(name: Column, key: Column) -> Column:
    """Given name, else the key with its first letter in upper case."""
    return F.coalesce(empty_to_null(name), capitalize(key))


def combined_text(sections: Column) -> Column:
    """All sections of one document as one text with ``## title`` headings."""
    bodies = F.filter(F.map_entries(sections), lambda e: e["value"]["content"].isNotNull())
    parts = F.transform(
        bodies,
        lambda e: F.concat(
            F.lit("\n## "), e["key"], F.lit("\n"), F.array_join(e["value"]["content"], "\n"), F.lit("\n")
        ),
    )
    return empty_to_null(strip(F.array_join(parts, "")))


def explode_sections(documents: DataFrame, key: Sequence[str] = ("country",)) -> DataFrame:
    """One row per section: title, url and the joined, stripped text."""
    return documents.select(*key, F.explode("sections").alias("section_title", "body")).select(
        *key,
        "section_title",
        F.col("body.url").alias("section_url"),
        strip(F.array_join("body.content", "\n")).alias("text_content"),
    )


def valid_sections(sections: DataFrame, min_chars: int = MIN_SECTION_CHARS) -> DataFrame:
    """Sections that have a url and at least ``min_chars`` characters of text."""
    return sections.filter(
        (F.coalesce(F.col("section_url"), F.lit("")) != "")
        & (F.length("text_content") >= min_chars)
    )


# --- inserts ----------------------------------------------------------------


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of every key; Spark prunes to one row per key before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Existing rows plus the first incoming row of every key not yet present."""
    candidates = first_per_key(incoming, key, order).select(*existing.columns)
    known = existing.select(*key)
    return existing.unionByName(candidates.join(known, list(key), "left_anti"))


# --- upserts ----------------------------------------------------------------


def _same_key(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key])


def _touched(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows that the incoming rows refer to.

    A small batch is broadcast for this, so that a large stored table is only
    scanned and never shuffled.
    """
    return existing.join(incoming.select(*key), list(key), "left_semi")


def newest_per_key(incoming: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order`` (newest first), then by the row's own values."""
    rest = [c for c, kind in incoming.dtypes if c not in key and not kind.startswith("map")]
    return first_per_key(incoming, key, [*order, *rest])


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    columns: Mapping[str, Column],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Full snapshot after merging ``incoming`` into ``existing``.

    Of incoming rows with the same key only the first by ``order`` counts, so
    keys stay unique; pass an order that puts the newest version first.

    ``columns`` gives each output column as an expression over ``old.*`` and
    ``new.*``; ``old._there`` / ``new._there`` tell which sides hold the row.

    Stored rows are left-joined to the batch and new rows are added, in place of
    one full outer join, which would always shuffle the whole stored table.
    """
    incoming = newest_per_key(incoming, key, order)
    old = existing.withColumn("_there", F.lit(True)).alias("old")
    nothing = existing.filter(F.lit(False)).withColumn("_there", F.lit(True)).alias("old")
    new = incoming.withColumn("_there", F.lit(True))
    known = _touched(existing.select(*key), incoming, key)
    added = new.join(known, list(key), "left_anti")
    keys = [F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}")).alias(k) for k in key]
    outputs = [*keys, *[expression.alias(name) for name, expression in columns.items()]]
    stored = old.join(new.alias("new"), _same_key(key), "left").select(*outputs)
    inserted = added.alias("new").join(nothing, _same_key(key), "left").select(*outputs)
    return stored.unionByName(inserted)


def _newest(name: str) -> Column:
    return F.when(F.col("new._there"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))


def country_upsert(
    countries: DataFrame, incoming: DataFrame, now: Column, order: Sequence[str | Column] = ()
) -> DataFrame:
    """Update name and url of known countries, stamp them, insert the others."""
    is_old, is_new = F.col("old._there"), F.col("new._there")
    language = F.coalesce(F.col("new.language"), F.lit(DEFAULT_LANGUAGE))
    return upsert(
        countries,
        incoming,
        ("doc_id",),
        {
            "country_name": _newest("country_name"),
            "country_url": _newest("country_url"),
            "language": F.when(is_old, F.col("old.language")).otherwise(language),
            "created_at": F.when(is_old, F.col("old.created_at")).otherwise(now),
            "last_scraped_at": F.when(is_new, now).otherwise(F.col("old.last_scraped_at")),
        },
        order,
    )


def section_upsert(
    sections: DataFrame, incoming: DataFrame, now: Column, order: Sequence[str | Column] = ()
) -> DataFrame:
    """Merge sections by url; a changed text clears the stored vector."""
    is_old, is_new = F.col("old._there"), F.col("new._there")
    unchanged = is_new.isNull() | F.col("new.text_content").eqNullSafe(F.col("old.text_content"))
    language = F.coalesce(F.col("new.language"), F.lit(DEFAULT_LANGUAGE))
    return upsert(
        sections,
        incoming,
        ("section_url",),
        {
            "country_doc_id": F.when(is_old, F.col("old.country_doc_id")).otherwise(
                F.col("new.country_doc_id")
            ),
            "section_title": _newest("section_title"),
            "text_content": _newest("text_content"),
            "embedding": F.when(is_old & unchanged, F.col("old.embedding")),
            "language": F.when(is_new, language).otherwise(F.col("old.language")),
            "scraped_at": F.when(is_new, now).otherwise(F.col("old.scraped_at")),
        },
        order,
    )


def classify_changes(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    ignored: Sequence[str] = AUDIT_COLUMNS,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """The newest incoming row of each key (see ``upsert``) as ``insert`` or ``update`` with the changed column names.

    Unchanged rows are dropped; audit columns never count as a change.
    """
    compared = [c for c in columns if c not in ignored]
    incoming = newest_per_key(incoming, key, order)
    stored = _touched(existing.select(*key, *compared), incoming, key)
    old = stored.withColumn("_there", F.lit(True)).alias("old")
    new = incoming.select(*key, *compared).alias("new")
    differing = F.array(
        *[F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in compared]
    )
    changed = F.when(F.col("old._there"), F.filter(differing, lambda c: c.isNotNull()))
    return (
        new.join(old, _same_key(key), "left")
        .select(
            *[F.col(f"new.{k}").alias(k) for k in key],
            F.when(F.col("old._there"), "update").otherwise("insert").alias("action"),
            changed.alias("changed"),
        )
        .filter((F.col("action") == "insert") | (F.size("changed") > 0))
    )


# --- constraints ------------------------------------------------------------


def constraint_violations(
    child: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    foreign_key: str | None = None,
    parent: DataFrame | None = None,
    parent_key: str | None = None,
) -> DataFrame:
    """``(constraint, column, violations)``: nulls, repeated keys, orphan rows.

    Orphans are counted per distinct key value, which makes the join immune to
    a key that holds most of the rows.
    """
    checks = []
    if not_null:
        nulls = child.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in not_null]
        checks.append(
            nulls.select(F.lit("not_null").alias("constraint"), F.inline(F.array(*pairs)))
        )
    for columns in unique:
        repeated = child.groupBy(*columns).count().filter("count > 1")
        checks.append(
            repeated.agg(F.count("*").alias("violations")).select(
                F.lit("unique").alias("constraint"),
                F.lit(",".join(columns)).alias("column"),
                "violations",
            )
        )
    if foreign_key is not None:
        used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).count()
        known = parent.select(F.col(parent_key).alias(foreign_key))
        orphans = used.join(known, foreign_key, "left_anti")
        checks.append(
            orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations")).select(
                F.lit("foreign_key").alias("constraint"),
                F.lit(foreign_key).alias("column"),
                "violations",
            )
        )
    return reduce(DataFrame.unionByName, checks)


def cascade_delete(
    children: DataFrame, deleted: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child rows that remain once the parents in ``deleted`` are gone."""
    gone = deleted.select(F.col(parent_key).alias(child_key)).distinct()
    return children.join(gone, child_key, "left_anti")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for every table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
