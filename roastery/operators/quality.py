"""Referential checks, row counts, control totals and rejects."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.operators.lookup import attach_key
from roastery.rules import DEFAULT_RULES, Rules


class OrphanError(ValueError):
    """A fact refers to members its dimension does not have."""


def flag_orphans(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """``fact`` plus ``is_orphan``: the key is NULL or has no match in the dimension.

    The lookup keeps busy keys out of the shuffle, so neither a popular member
    nor a crowd of NULLs lands in one task.
    """
    members = dim.select(F.col(dim_col).alias("_dim_key"), F.col(dim_col).alias("_found"))
    found = attach_key(fact, members, F.col(fact_col), "_dim_key", "_found")
    return found.withColumn("is_orphan", F.col("_found").isNull()).drop("_found")


def orphans(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Fact rows whose key has no match in the dimension; a NULL key counts as unmatched."""
    return flag_orphans(fact, dim, fact_col, dim_col).where("is_orphan").drop("is_orphan")


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Distinct unmatched keys and how many fact rows carry each.

    Rows are counted per key before the join, on the map side, so a key that
    holds a third of the fact reaches the join as one row.
    """
    per_key = fact.groupBy(fact_col).agg(F.count(F.lit(1)).alias("fact_rows"))
    return per_key.join(
        dim.select(F.col(dim_col).alias("_dim_key")), F.col(fact_col) == F.col("_dim_key"), "left_anti"
    )


def orphan_sample(
    fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, n: int = 10
) -> DataFrame:
    """The n unmatched keys that most fact rows carry."""
    return orphan_keys(fact, dim, fact_col, dim_col).orderBy(F.desc("fact_rows"), fact_col).limit(n)


def check_fk(
    fact: DataFrame,
    dim: DataFrame,
    fact_col: str,
    dim_col: str,
    on_orphan: str = "report",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Check one foreign key.

    report      one row: key name, NULL rows, unmatched rows, distinct unmatched keys
    fail        the same row, or ``OrphanError`` if any key is NULL or unmatched
    quarantine  (rows that match, rows that do not)
    """
    if on_orphan == "quarantine":
        flagged = flag_orphans(fact, dim, fact_col, dim_col)
        return flagged.where("not is_orphan").drop("is_orphan"), flagged.where("is_orphan").drop("is_orphan")
    report = fk_report(fact, {fact_col: (dim, dim_col)})
    if on_orphan == "report":
        return report
    if on_orphan == "fail":
        found = report.first()
        if found["orphan_rows"]:
            raise OrphanError(f"{found['orphan_rows']} rows of {fact_col} have no match in {dim_col}")
        return report
    raise ValueError(f"on_orphan must be report, fail or quarantine, not {on_orphan!r}")


def fk_report(fact: DataFrame, foreign_keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per foreign key of a fact, from a single pass over it.

    All keys of a row are laid out as (name, value) pairs and counted per pair
    on the map side; only the distinct pairs are shuffled and joined with the
    pooled dimension keys.  ``orphan_rows`` includes the NULL keys.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("fk"), F.col(c).cast("bigint").alias("value"))
                for c in foreign_keys
            ]
        )
    ).alias("pair")
    counted = (
        fact.select(pairs)
        .groupBy(F.col("pair.fk").alias("fk"), F.col("pair.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    members = reduce(
        DataFrame.union,
        [
            dim.select(F.lit(c).alias("fk"), F.col(dim_col).cast("bigint").alias("value"))
            for c, (dim, dim_col) in foreign_keys.items()
        ],
    ).distinct()
    joined = counted.join(members.withColumn("known", F.lit(1)), ["fk", "value"], "left")
    unmatched = F.col("known").isNull()
    missing = F.col("value").isNull()

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("fact_rows"))), F.lit(0))

    return joined.groupBy("fk").agg(
        F.sum("fact_rows").alias("fact_rows"),
        rows_where(missing).alias("null_rows"),
        rows_where(unmatched & ~missing).alias("unmatched_rows"),
        rows_where(unmatched).alias("orphan_rows"),
        F.count_if(unmatched & ~missing).alias("unmatched_keys"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count: one job for all tables."""
    return reduce(
        DataFrame.union,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ],
    )


def verify_counts(tables: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table before and after a load, and whether they agree."""
    before = table_counts(tables)
    after = table_counts(loaded).withColumnRenamed("row_count", "loaded_count")
    return (
        before.join(after, "table_name", "left")
        .withColumn("matches", F.col("row_count").eqNullSafe(F.col("loaded_count")))
    )


def unknown_members(seen: DataFrame, seen_col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Distinct values of the source that the dimension does not list."""
    return seen.select(F.trim(seen_col).alias(seen_col)).distinct().subtract(
        dim.select(F.col(dim_col).alias(seen_col)).distinct()
    )


def sales_rejects(cleaned: DataFrame) -> DataFrame:
    """Sales rows that lack something, with the reason; a row may appear for several reasons."""
    return _with_reasons(
        cleaned,
        {
            "no_sale_id": F.col("sale_id").isNull(),
            "bad_timestamp": F.col("date_key").isNull(),
            "bad_amount": F.col("amount_usd").isNull(),
        },
    )


def spend_rejects(cleaned: DataFrame) -> DataFrame:
    """Spend rows that lack something, with the reason."""
    return _with_reasons(
        cleaned,
        {
            "unknown_platform": F.col("platform_clean").isNull(),
            "bad_date": F.col("spend_date").isNull(),
            "bad_cost": F.col("cost_clean").isNull(),
        },
    )


def influencer_rejects(campaigns: DataFrame) -> DataFrame:
    """Campaign rows without an id, or with metadata that is no JSON and so gives the influencer nothing, with the reason."""
    unread = F.col("metadata").isNotNull() & F.get_json_object("metadata", "$").isNull()
    return _with_reasons(campaigns, {"no_inf_id": F.col("inf_id").isNull(), "bad_metadata": unread})


def _with_reasons(cleaned: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in reasons.items()]))
    return cleaned.withColumn("reason", F.explode(found))


def quality_report(
    cleaned_sales: DataFrame,
    fact_sales: DataFrame,
    cleaned_spend: DataFrame,
    fact_ad_spend: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """table_name, check_name, value: one aggregate per table.

    Control totals before and after conforming show whether a join multiplied
    or lost rows.
    """
    return reduce(
        DataFrame.union,
        [
            _checks(
                "sales_clean",
                cleaned_sales,
                {
                    "rows": F.count(F.lit(1)),
                    "bad_timestamp": F.count_if(F.col("date_key").isNull()),
                    "bad_amount": F.count_if(F.col("amount_usd").isNull()),
                    "null_user": F.count_if(F.col("user_id").isNull()),
                    "total_amount": F.sum("amount_usd"),
                },
            ),
            _checks(
                "fact_sales",
                fact_sales,
                {
                    "rows": F.count(F.lit(1)),
                    "null_date_key": F.count_if(F.col("date_key").isNull()),
                    "null_user_key": F.count_if(F.col("user_key").isNull()),
                    "null_product_key": F.count_if(F.col("product_key").isNull()),
                    "unknown_user": F.count_if(F.col("user_key") == rules.unknown_user_key),
                    "total_amount": F.sum("amount"),
                },
            ),
            _checks(
                "spend_clean",
                cleaned_spend,
                {
                    "rows": F.count(F.lit(1)),
                    "unknown_platform": F.count_if(F.col("platform_clean").isNull()),
                    "bad_date": F.count_if(F.col("spend_date").isNull()),
                    "bad_cost": F.count_if(F.col("cost_clean").isNull()),
                    "total_cost": F.sum("cost_clean"),
                },
            ),
            _checks(
                "fact_ad_spend",
                fact_ad_spend,
                {
                    "rows": F.count(F.lit(1)),
                    "null_date_key": F.count_if(F.col("date_key").isNull()),
                    "null_platform_key": F.count_if(F.col("platform_key").isNull()),
                    "total_cost": F.sum("total_cost"),
                },
            ),
        ],
    )


def _checks(table: str, df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    measured = df.agg(*[c.cast("decimal(38,6)").alias(name) for name, c in checks.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("value")) for name in checks]
    )
    return measured.select(F.lit(table).alias("table_name"), F.inline(pairs))
