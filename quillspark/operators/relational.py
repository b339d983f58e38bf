"""Small relational operators: ordered dedupe, differences, pages, lookups, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bounds that list queries keep to.
DEFAULT_PAGE = 25
MAX_PAGE = 100


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    while name in df.columns:
        name = "_" + name
    return name


def first_by_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row a key: the first in the given order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def lowest_place(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """(keys, place): the lowest place of each key; aggregated before it is shuffled."""
    return df.groupBy(*keys).agg(F.min(place).alias(place))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], *values: str) -> DataFrame:
    """(keys, values): values of each key's last row in the given order; aggregated before it is shuffled."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(v, at).alias(v) for v in values])


def minus_keys(df: DataFrame, gone: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is not in ``gone``; repeated rows stay repeated."""
    return df.join(gone, on, "left_anti")


def ordered_minus(df: DataFrame, ids: str, gone: DataFrame) -> DataFrame:
    """(ord, id): items of the array column ``ids`` that are not in ``gone`` (column id), in their order, repeats kept."""
    return minus_keys(df.select(F.posexplode(ids).alias("ord", "id")), gone.select("id"), "id").select("ord", "id")


def page(df: DataFrame, *order: Column | str, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 1 to {MAX_PAGE} and offset not negative")
    return df.orderBy(*order).offset(offset).limit(limit)


def page_count(total: Column | str, size: int) -> Column:
    t = F.col(total) if isinstance(total, str) else total
    return F.greatest(F.lit(1), F.ceil(t / F.lit(float(size)))).cast("bigint")


def maybe(df: DataFrame, **equals: object) -> DataFrame:
    """Filter by the values that are given; None stands for no filter."""
    for column, value in equals.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def search(df: DataFrame, query: str | None, *columns: str) -> DataFrame:
    """Rows in which a column holds the query, case aside; ``%`` and ``_`` are wildcards. No query: all rows."""
    if not query:
        return df
    found = F.lit(False)
    for c in columns:
        found = found | F.col(c).cast("string").ilike(f"%{query}%")
    return df.filter(found)


def search_folded(df: DataFrame, query: str, *columns: str) -> DataFrame:
    """As ``search``, but a blank query finds nothing."""
    needle = query.strip().lower()
    if not needle:
        return df.limit(0)
    found = F.lit(False)
    for c in columns:
        found = found | F.lower(F.col(c).cast("string")).like(f"%{needle}%")
    return df.filter(found)


def search_collated(df: DataFrame, query: str, *columns: str) -> DataFrame:
    """Substring search blind to case and accents."""
    found = F.lit(False)
    for c in columns:
        found = found | F.contains(F.collate(F.col(c), "UNICODE_CI_AI"), F.collate(F.lit(query), "UNICODE_CI_AI"))
    return df.filter(found)


def strict_lookup(df: DataFrame, other: DataFrame, on: str, what: str) -> DataFrame:
    """Inner join that fails where a key of ``df`` is missing in ``other``."""
    seen = other.withColumn("__seen", F.lit(True))
    joined = df.join(seen, on, "left")
    missing = F.concat(F.lit(f"{what} is missing: "), F.col(on).cast("string"))
    return joined.withColumn("__seen", F.when(F.col("__seen").isNull(), F.raise_error(missing)).otherwise(True)).filter("__seen").drop("__seen")


def with_defaults(df: DataFrame, key: str, kind: str, value: str, defaults: dict[str, str], aliases: dict[str, str] | None = None) -> DataFrame:
    """(key, kind, value): ``df`` with aliases resolved, and a default where a key has no value of a required kind."""
    names = F.col(value)
    if aliases:
        names = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in aliases.items() for x in p]), names), names)
    own = df.select(key, kind, names.alias(value))
    required = F.explode(F.array(*[F.struct(F.lit(k).alias(kind), F.lit(v).alias(value)) for k, v in defaults.items()]))
    missing = df.select(key).distinct().select(key, required.alias("r")).select(key, f"r.{kind}", f"r.{value}").join(own.select(key, kind).distinct(), [key, kind], "left_anti")
    return own.unionByName(missing)


def sequence_in_batches(start: int, end: int, size: int, spark) -> DataFrame:
    """(id, batch): the ids from start to end, both included, in batches of ``size`` (1 to 1000)."""
    if not 1 <= size <= 1000 or end < start:
        raise ValueError("batches hold 1 to 1000 ids and the range must not end before it starts")
    return spark.range(start, end + 1).select("id", F.floor((F.col("id") - start) / size).cast("bigint").alias("batch"))


def counts_by_status(df: DataFrame, key: str, status: str = "status") -> DataFrame:
    """(key, counts): a map from status to number of rows."""
    per = df.groupBy(key, status).agg(F.count("*").alias("n"))
    return per.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("counts"))


def thread_depth(df: DataFrame, key: Sequence[str], ident: str, parent: str) -> DataFrame:
    """``df`` with ``depth``: the ancestors of each row within its group, however many; a missing parent ends the walk, and
    in a cycle each ancestor counts once. Of rows that repeat an id the least parent counts.

    Each row points to an ancestor and knows how far it is; pointers are doubled each round, so a thread of depth d takes log2(d)
    joins of rows of constant size. Rows that are further from their pointer than their group has rows are in cycles or below them; only
    those are walked with their paths.
    """
    checkpoint_dir(df.sparkSession)
    group = [f"__k{i}" for i in range(len(key))]  # own names, as a key may have any
    at, one = [*group, "__top"], [*group, "__id"]
    rows = df.select(*[F.col(f"`{k}`").alias(g) for k, g in zip(key, group)], F.col(f"`{ident}`").alias("__id"), F.col(f"`{parent}`").alias("__top"))
    base = rows.groupBy(*one).agg(F.min("__top").alias("__top"))
    known = base.select(*group, F.col("__id").alias("__top"))
    links = base.join(known, at, "left_semi").withColumns({"__n": F.lit(1).cast("bigint"), "__moved": F.lit(True)}).checkpoint()
    sizes = base.groupBy(*group).agg(F.count("*").alias("__rows"))
    first = links.select(*one, "__top")
    while True:
        ahead = links.select(*group, F.col("__id").alias("__top"), F.col("__top").alias("__next"), F.col("__n").alias("__more"))
        grown = links.drop("__moved").join(ahead, at, "left").select(*one, F.coalesce("__next", "__top").alias("__top"), (F.col("__n") + F.coalesce("__more", F.lit(0))).alias("__n"), F.col("__next").isNotNull().alias("__moved"))
        links = grown.checkpoint()
        moving = links.filter("__moved")
        if moving.join(sizes, group).filter("__n <= __rows").isEmpty():
            break
    depth = links.filter("not __moved").select(*one, F.col("__n").alias("__depth"))
    if not moving.isEmpty():
        paths = first.join(moving.select(*one), one, "left_semi").select(*one, F.array("__top").alias("__path")).checkpoint()
        total, before = paths.agg(F.sum(F.size("__path"))).first()[0], -1
        while total != before:
            ahead = paths.select(*group, F.col("__id").alias("__top"), F.col("__path").alias("__more"))
            grown = paths.withColumn("__top", F.element_at("__path", -1)).join(ahead, at, "left")
            paths = grown.select(*one, F.array_distinct(F.concat("__path", F.coalesce("__more", F.slice("__path", 1, 0)))).alias("__path")).checkpoint()
            total, before = paths.agg(F.sum(F.size("__path"))).first()[0], total
        depth = depth.unionByName(paths.select(*one, F.size("__path").cast("bigint").alias("__depth")))
    named = depth.select(*[F.col(g).alias(k) for k, g in zip(key, group)], F.col("__id").alias(ident), "__depth")
    return df.join(named, [*key, ident], "left").withColumn("depth", F.coalesce("__depth", F.lit(0)).cast("int")).drop("__depth")
