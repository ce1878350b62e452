"""Sorts, limits and picks. Ranks that a result needs are columns, since rows of a table have no order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.rules import contains_any
from sievework.operators.metrics import order_rank


def top_jobs(jobs: DataFrame, core: list[str], n: int = 30, tie: str = "job_id") -> DataFrame:
    """O1: core companies first, then by relevance; the first n."""
    band = F.coalesce(*(F.when(F.lower("relevancy") == b, F.lit(i)) for i, b in enumerate(("high", "medium", "low"))), F.lit(3))
    return jobs.orderBy(contains_any("company", core).desc(), band, tie).limit(n)


def order_for_csv(jobs: DataFrame, main_board: str = "LinkedIn", tie: str = "job_id") -> DataFrame:
    """O2: corporate sources first, then by relevance."""
    band = F.coalesce(*(F.when(F.lower("relevancy") == b, F.lit(i)) for i, b in enumerate(("high", "medium", "low"))), F.lit(3))
    return jobs.orderBy((F.col("source") == main_board), band, tie)


def order_news(news: DataFrame, tie: str = "seq") -> DataFrame:
    """O3: highest score first, then newest."""
    return news.orderBy(F.desc("score"), F.desc("published_at"), tie)


def order_by_seniority(jobs: DataFrame, strict: bool = False, tie: str = "job_id") -> DataFrame:
    """The custom order of levels, unknown ones after by name, then company. Strict matches no stored
    (lower-case) level, so levels come by name."""
    rank = F.lit(1) if strict else order_rank(F.regexp_replace("seniority", "^mid$", "mid-level"))
    return jobs.orderBy(rank, F.coalesce("seniority", F.lit("Other")), "company", tie)


def order_events(events: DataFrame) -> DataFrame:
    """By date, undated last."""
    return events.orderBy(F.coalesce(F.col("event_date").cast("string"), F.lit("9999-12-31")), "event_id")


def order_by_count(df: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Largest first, then by key."""
    return df.orderBy(F.desc(n), *keys)


def first_n_text(df: DataFrame, col: str, n: int, by: list[str] = ()) -> DataFrame:
    """The first n names in order and how many more there are. Each task keeps n names of a group at most."""
    ranked = df.select(*by, F.col(col).alias("name")).distinct().withColumn("turn", F.row_number().over(Window.partitionBy(*by).orderBy("name"))) if by else None
    if ranked is None:
        names = df.select(F.col(col).alias("name")).distinct()
        head = names.orderBy("name").limit(n).agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("text"))
        return head.crossJoin(names.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more")))  # one row and one row
    total = df.groupBy(*by).agg(F.countDistinct(col).alias("total"))
    head = ranked.filter(F.col("turn") <= n).groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("text"))
    return head.join(total, list(by)).withColumn("more", F.greatest(F.col("total") - n, F.lit(0))).drop("total")


def cap_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of an order."""
    return df.orderBy(*order).limit(n)


def weekly_pick(news: DataFrame, n: int = 5, story: str = "story_key", source: str = "source") -> DataFrame:
    """All rows with ``picked`` and ``place``. The best row of each source that is also the best of its
    story comes first, by score and time; if they are under n, the best of the others fill up.

    Rows without a source are one source, and rows without a story one story; ``seq`` tells rows apart. The news itself is never
    shuffled: the best of the sources and stories are aggregates, the fill is among the 2 n best rows, and n rows are joined back.
    """
    key = F.struct(F.col("score"), F.col("published_at"), (-F.col("seq")).alias("back"), F.col("seq"))
    best = [news.groupBy(c).agg(F.max(key).alias("k")).select("k").distinct() for c in (source, story)]
    firsts = best[0].join(best[1], "k").orderBy(F.desc("k")).limit(n).withColumn("fill", F.lit(False))
    others = news.select(key.alias("k")).orderBy(F.desc("k")).limit(2 * n).withColumn("fill", F.lit(True))
    chosen = firsts.unionByName(others).groupBy("k").agg(F.min("fill").alias("fill"))  # 3 n rows at most
    top = chosen.orderBy("fill", F.desc("k")).limit(n)
    placed = top.select(F.col("k.seq").alias("seq"), F.row_number().over(Window.orderBy("fill", F.desc("k"))).alias("place"))
    out = news.join(F.broadcast(placed), "seq", "left")  # n rows
    return out.withColumn("picked", F.col("place").isNotNull())


def place_in_group(df: DataFrame, keys: list[str], order: list, into: str = "place") -> DataFrame:
    """``df`` with each row's place in its group, from 1, however large a group is.

    Rows are dealt by ranges of (keys, order), numbered inside each range, and shifted by the rows of the
    group in earlier ranges, so a task holds a range and never a whole group. The ranges are written out,
    since they're read twice. ``order`` must be total for a repeatable result.
    """
    from sievework.operators.graphs import cut

    ranges = cut(df.repartitionByRange(*(F.col(k) for k in keys), *(o if isinstance(o, Column) else F.col(o) for o in order)).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_range").alias("_at"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = ranges.withColumn("_inside", inside).join(shifts, [F.col("_range") == F.col("_at"), *same])
    return joined.withColumn(into, (F.col("_inside") + F.col("_before")).cast("bigint")).select(*df.columns, into)


def order_hero(picks: DataFrame, has_image: Column, order: str = "seq", n: int = 5) -> DataFrame:
    """Rows with an image first, else as they come; the first is the hero, four follow."""
    return picks.orderBy(has_image.desc(), order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(has_image.desc(), order)))


def failure_runs(fetch_log: DataFrame, n: int = 3) -> DataFrame:
    """For each source and run of n failures or more without a success between, where it began, the
    failure that makes n, and its length. Outcomes other than failure and success leave a run as it is; rows without a
    place (null ``seq``) are left out. Ranges of a source are summed up apart and merged (``runs``)."""
    from sievework.operators.graphs import cut
    from sievework.operators.runs import merged, summed_up

    return merged(cut(summed_up(fetch_log, n)), n).filter(F.col("length").isNotNull()).drop("trailing")


def stale_sources(fetch_log: DataFrame, now: Column, days: int = 8) -> DataFrame:
    """Sources that are still tried but whose last success is older than so many days, or that never had one."""
    ts = F.col("ts").cast("timestamp")
    seen = fetch_log.groupBy("source_id").agg(F.max(ts).alias("last_attempt"), F.max(F.when(F.col("upserted") > 0, ts)).alias("last_success"))
    return seen.filter(F.col("last_success").isNull() | (F.col("last_success") < now - F.make_dt_interval(F.lit(days))))


def append_all(dfs: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def minus(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other frame doesn't have."""
    return df.join(other.select(key), key, "left_anti")


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    """The distinct ids that aren't null."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def replace_rows(base: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """U4: the base with rows replaced by their updates; a null is a key, and all updates of a key take its place."""
    gone = updates.select(F.col(key).alias("_key"))
    return base.join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(updates)
