"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule ``(host, path, verdict)`` fits its host and all subdomains, where the url's
path starts with the rule's. The host's labels, reversed and each ended by a
separator, form a canonical key in which a host and its subdomains are one interval; paths that start alike are one
interval of the keys that begin with their rule's host. Intervals of one kind nest or are disjoint.

Two sweeps find the rules around each url. In the first the keys of the distinct hosts and the ends of the
rule hosts' intervals are sorted together; the sweep keeps a stack with one slot a level (labels of the rule host), filled by an
interval's opening end and emptied by its closing one, so each host finds the rule hosts around it. In the second the probes are (rule
host, path) and the intervals are path prefixes, the level being how deep a prefix lies in others of its host; the top of the stack
is the longest path that fits. Of these, one for each rule host around the url, the longest rule wins.

The key space is cut into ranges at quantiles of the probes' and ends' own keys. An interval is entered in every range that it
reaches, clipped to it. A crowded range is dealt over
several tasks by a salt and its interval ends are repeated in each. Urls are reduced to
distinct hosts and (host, path) before the sweeps and rejoined after them.

Edge cases: a null url, or one without ``://``, has an empty host and path and no
rule. No rules: every url takes the default verdict. Rules with a null or empty host,
null path or null verdict are ignored; rules that repeat count once (of two verdicts for one
(host, path), ``block`` holds). The longest of the fitting rules by host and path
together wins, between equals the one with the longer host. Columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

SEP = "\x01"
#: Between a rule host and a path in the keys of the second sweep.
PATH_SEP = "\x02"
#: Sorts after every text that continues a key.
LAST = "\U0010ffff"
#: Ranges of the key space, and probes that one task sweeps.
RANGES = 64
SWEEP_ROWS = 200_000


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """``www.example.com`` as ``com|example|www|``, ``|`` standing for the separator."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), SEP), F.lit(SEP))


def order_number(key: Column) -> Column:
    """The first seven bytes of a key as a number, in the order of the keys."""
    return F.conv(F.rpad(F.substring(F.hex(F.encode(key, "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("long")


def clean_rules(rules: DataFrame) -> DataFrame:
    """(rule_host, rule_path, verdict, host_level): each rule once; paths of urls start with a slash, so those of rules do, too."""
    r = rules.select(F.lower("host").alias("rule_host"), F.col("path").alias("path"), F.col("verdict").alias("verdict"))
    r = r.filter("rule_host is not null and rule_host <> '' and path is not null and verdict is not null")
    r = r.groupBy("rule_host", "path").agg(F.max("verdict").alias("verdict"))
    return r.select("rule_host", F.when(F.col("path") == "", "").otherwise(F.concat(F.lit("/"), "path")).alias("rule_path"), "verdict", F.size(F.split("rule_host", r"\.")).alias("host_level"))


def sweep(probes: DataFrame, intervals: DataFrame) -> DataFrame:
    """Add to ``probes`` (column key and others) the column ``stack``: what the intervals around each key carry, outermost first.
    intervals: (lo, hi, level, carried), nested or disjoint; those of one level are disjoint and level grows inwards."""
    levels = intervals.agg(F.max("level")).first()[0] or 0
    if not levels:
        return probes.withColumn("stack", F.array().cast(f"array<{dict(intervals.dtypes)['carried']}>"))
    num = order_number(F.col("key"))
    ends = intervals.select(F.explode(F.array("lo", "hi")).alias("key"))
    cuts = probes.select(num.alias("num")).unionByName(ends.select(num.alias("num"))).agg(F.percentile_approx("num", [k / RANGES for k in range(1, RANGES)], 1000)).first()[0]
    cuts = sorted(set(cuts or []))  # RANGES numbers at most

    def range_of(key: str) -> Column:
        return reduce(Column.__add__, [(order_number(F.col(key)) >= F.lit(c)).cast("int") for c in cuts], F.lit(0))

    dealt = probes.withColumn("range", range_of("key"))
    salts = cut(dealt.groupBy("range").agg(F.ceil(F.count("*") / SWEEP_ROWS).cast("int").alias("salts")), "url-ranges")  # at most RANGES rows
    dealt = dealt.join(F.broadcast(salts), "range").withColumn("salt", F.pmod(F.xxhash64(*probes.columns), F.col("salts")).cast("int")).drop("salts")
    # an interval in each range that it reaches: its opening end there or at the range's start, its closing end only where it lies
    reached = intervals.withColumns({"first": range_of("lo"), "last": range_of("hi")}).withColumn("range", F.explode(F.sequence("first", "last")))
    opens = F.struct(F.when(F.col("range") == F.col("first"), F.col("lo")).otherwise("").alias("key"), F.lit(0).alias("kind"), F.col("carried"))
    closes = F.struct(F.col("hi").alias("key"), F.lit(2).alias("kind"), F.lit(None).cast(dict(intervals.dtypes)["carried"]).alias("carried"))
    events = reached.select("range", "level", F.explode(F.when(F.col("range") == F.col("last"), F.array(opens, closes)).otherwise(F.array(opens))).alias("e")).select("range", "level", "e.*")
    events = events.join(F.broadcast(salts), "range").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    rows = dealt.withColumn("kind", F.lit(1)).unionByName(events.withColumn("slot", F.struct("carried")).drop("carried"), allowMissingColumns=True)
    w = Window.partitionBy("range", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slots = [F.last(F.when(F.col("level") == n, F.col("slot")), ignorenulls=True).over(w).getField("carried") for n in range(1, levels + 1)]
    return rows.withColumn("stack", F.array_compact(F.array(*slots))).filter("kind = 1").select(*probes.columns, "stack")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Give every row of ``pages`` the columns host, path, rule and verdict (see the module).

    Columns of ``pages`` with one of these names are replaced; all others and all rows stay.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    pages = pages.withColumns({"host": host, "path": path}).drop("rule", "verdict")
    rules = cut(clean_rules(rules), "url-rules")
    urls = cut(pages.select("host", "path").distinct(), "urls")
    hosts = rules.select(host_key(F.col("rule_host")).alias("lo"), F.col("host_level").alias("level"), F.col("rule_host").alias("carried")).distinct().withColumn("hi", F.concat("lo", F.lit(LAST)))
    around = sweep(urls.select("host").distinct().withColumn("key", host_key(F.col("host"))), hosts)
    around = cut(around.select("host", F.explode("stack").alias("rule_host")), "url-hosts")

    def path_key(rest: str) -> Column:
        return F.concat(host_key(F.col("rule_host")), F.lit(PATH_SEP), F.col(rest))

    own = rules.select("rule_host", path_key("rule_path").alias("lo"), F.struct("rule_host", "rule_path", "verdict").alias("carried")).withColumn("hi", F.concat("lo", F.lit(LAST)))
    turns = own.select("rule_host", "lo", F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("turn")), F.struct(F.col("hi").alias("at"), F.lit(-1).alias("turn")))).alias("e")).select("rule_host", "lo", "e.*")
    depth = F.sum("turn").over(Window.partitionBy("rule_host").orderBy("at", F.desc("turn")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    levels = turns.withColumn("level", depth.cast("int")).filter("turn = 1").select("lo", "level")
    paths = cut(own.join(levels, "lo").select("lo", "hi", "level", "carried"), "url-paths")
    probes = cut(urls.join(around, "host").select("host", "path", path_key("path").alias("key")), "url-probes")
    top = sweep(probes, paths).withColumn("top", F.try_element_at("stack", F.lit(-1))).filter("top is not null")
    size = F.struct(F.length("top.rule_host") + F.greatest(F.length("top.rule_path") - 1, F.lit(0)), F.length("top.rule_host"))
    best = top.groupBy("host", "path").agg(F.max_by("top", size).alias("top"))
    shown = F.concat("top.rule_host", F.lit("/"), F.substring("top.rule_path", 2, 1 << 30))
    best = cut(best.select("host", "path", shown.alias("rule"), F.col("top.verdict").alias("verdict")), "url-verdicts")
    return pages.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


#: The rules of the contract: (host, path, verdict).
CONTRACT_RULES = (
    ("com", "", "allow"),
    ("example.com", "en/", "block"),
    ("www.example.com", "en/", "allow"),
    ("net", "es/", "block"),
    ("net", "fr/", "block"),
)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("host", "path", "verdict"), r)]) for r in CONTRACT_RULES])
    rules = spark.range(1).select(F.inline(rows))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(rule_host, rule_path, rule, rule_verdict) AS (
  VALUES ('com', '', 'com/', 'allow'), ('example.com', 'en/', 'example.com/en/', 'block'),
         ('www.example.com', 'en/', 'www.example.com/en/', 'allow'), ('net', 'es/', 'net/es/', 'block'), ('net', 'fr/', 'net/fr/', 'block')
), m AS (
  SELECT page_id, host, path, rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS rank
  FROM q LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND (rule_path = '' OR starts_with(path, '/' || rule_path))
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM m WHERE rank = 1
"""
