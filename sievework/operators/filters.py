"""Row filters. Each takes and returns DataFrames; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import rules as R
from sievework.functions import wordlists as W
from sievework.functions.text import col, strip


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Named columns."""
    return df.select(*columns)


def where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Rows that meet all conditions, null counting as no."""
    return df.filter(R.all_of(conditions))


def scan(df: DataFrame, columns: list[str], where: list[Column] = (), order: list | None = None, limit: int | None = None) -> DataFrame:
    """Select list, conditions, order and limit, in the order that lets filters and columns reach the files."""
    out = df.filter(R.all_of(list(where))) if where else df
    out = out.orderBy(*order) if order else out
    out = out.limit(limit) if limit is not None else out
    return out.select(*columns)


def drop_noise(df: DataFrame, name: str = "title", noise: list[str] | None = None, salvage: list[str] | None = None) -> DataFrame:
    """Rows without a noise term, or with one that saves them."""
    return df.filter(~(R.contains_any(name, noise or W.NOISE_TOPICS) & ~R.contains_any(name, salvage or W.SALVAGE_SIGNALS)))


def fresh_lenient(df: DataFrame, ts_col: str, type_col: str, limits: dict[str, int], now: Column, default: int = 40) -> DataFrame:
    """Rows that are undated or within the limit of their type, in days."""
    days = F.coalesce(*(F.when(F.col(type_col) == k, F.lit(v)) for k, v in limits.items()), F.lit(default))
    return df.filter(F.col(ts_col).isNull() | (F.col(ts_col).cast("timestamp") >= now - F.make_dt_interval(days)))


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose required columns aren't blank, and the others."""
    fine = R.all_of([F.coalesce(strip(F.col(c).cast("string")), F.lit("")) != "" for c in required])
    return df.filter(fine), df.filter(~fine)


def filter_board_rows(jobs: DataFrame, companies: list[str], keywords: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows in reach whose company is known or whose title has a keyword, and the others."""
    place = R.location_ok("location", W.BOARD_INCLUDE, W.BOARD_EXCLUDE)
    fine = place & (R.contains_any("company", companies) | R.contains_any("title", keywords or W.BOARD_KEYWORDS))
    return jobs.filter(fine), jobs.filter(~fine)


def filter_quality(jobs: DataFrame, core_companies: list[str]) -> DataFrame:
    """Core companies, and jobs of high relevance."""
    return jobs.filter(R.contains_any("company", core_companies) | (F.lower(F.coalesce("relevancy", F.lit(""))) == "high"))


def score_at_least(df: DataFrame, n: int = 3, name: str = "score") -> DataFrame:
    """Rows whose score, read as a number or else 0, is n or more."""
    return df.filter(F.coalesce(F.col(name).try_cast("int"), F.lit(0)) >= n)


def run_rules(jobs: DataFrame) -> DataFrame:
    """P20: jobs with their company's flags, and the struct ``rules``."""
    return jobs.withColumn("rules", R.rule_chain(*(F.col(c) for c in ("title", "location_raw", "url", "is_fdi", "is_irish_founded", "allowlisted"))))


def eligible(df: DataFrame, text_col: str, target_col: str, min_chars: int = 50, status: str | None = None) -> DataFrame:
    """Rows with enough text and no value yet."""
    fine = (F.length(F.coalesce(text_col, F.lit(""))) >= min_chars) & F.col(target_col).isNull()
    return df.filter(fine & (F.col("status") == status) if status else fine)


def select_recheck(results: DataFrame, protected: DataFrame) -> DataFrame:
    """Results without a find or without high confidence, but for protected companies."""
    open_ = results.filter((F.col("ats_platform") == "none_found") | (F.coalesce("confidence", F.lit("")) != "high"))
    return open_.join(protected.select("company_id").distinct(), "company_id", "left_anti")


def company_like(df: DataFrame, text: str, name: str = "name") -> DataFrame:
    """Rows whose company's name has the text in it, case folded; all rows if it's empty."""
    return df.filter(F.contains(F.lower(F.coalesce(name, F.lit(""))), F.lit(text.lower()))) if text else df


def resolve_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """For each name the first column among its aliases that the frame has, or null."""
    return df.select(*(next((col(a) for a in names if a in df.columns), F.lit(None).cast("string")).alias(name) for name, names in aliases.items()))
