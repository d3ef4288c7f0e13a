"""Filter rules for URLs as a sort-merge range join, in DataFrame operations only.

A key is a host written label by label from its end (``net. example. blog.``) and then
a path, as bytes. A rule is the interval of the keys that begin with its own: those
of its host whose path starts with its path. A URL asks once for its own host and
once for each domain above it that has rules, the path staying the same.

Rules and asked keys are swept in key order. Where a rule opens it is pushed on the
stack of active rules, where it closes the one below it is on top again; intervals
are nested or apart, so the rule below is the longest other one that its key begins
with. Only the top is carried from point to point: all rules below it fit as well,
but are shorter. A URL takes the longest of the tops its asked keys found.

Equal host and path are asked once, whatever number of pages has them. Asked keys of
one domain are dealt over as many groups as their number wants, each group holding
the domain's rules, so a domain with a third of all URLs does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# After each label and, once more, before the path; lower than any byte a host can hold.
SEP, PATH = "\x02", "\x01"
# Higher than any byte of a text: a rule closes right after the last key that begins with its own.
AFTER = b"\xff"
# Asked keys of a group that is swept by one task.
GROUP_ROWS = 250_000
TOP = "struct<n:int,host_labels:int,rule:string,verdict:string>"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """The labels from the last to the first, each ended by a separator."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), SEP), F.lit(SEP))


def url_key(host: Column, path: Column) -> Column:
    """Host and path as one key; keys sort by their bytes."""
    return F.encode(F.concat(host_key(host), F.lit(PATH), path), "utf-8")


def rule_table(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` and what the top of a stack says; a rule given twice counts once, the stricter verdict (block) wins."""
    host = ascii_lower(F.trim(F.coalesce("host", F.lit(""))))
    top = F.struct(
        F.length(F.concat("host", "path")).alias("n"),
        F.size(F.split("host", r"\.", -1)).alias("host_labels"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    return (
        rules.where(host != "")
        .groupBy(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("top", top.cast(TOP))
    )


def rules_below(rules: DataFrame) -> DataFrame:
    """Rules with the one below each on the stack (null: none): the longest other of its host that its path begins with.

    A path is cut at the lengths other rules of the host have, so this grows with the rules and not with their square.
    """
    lengths = rules.select("host", F.length("path").alias("n")).distinct()
    begins = rules.select("host", "path").join(lengths, "host").where("n < length(path)")
    begins = begins.select("host", "path", F.expr("left(path, n)").alias("begin"))
    others = rules.select("host", F.col("path").alias("begin"), F.col("top").alias("below"))
    below = begins.join(others, ["host", "begin"]).groupBy("host", "path").agg(F.max_by("below", F.col("below.n")).alias("below"))
    return rules.join(below, ["host", "path"], "left")


def sweep_points(rules: DataFrame) -> DataFrame:
    """The points of each domain where a rule opens or closes, with the top of the stack from there on."""
    key = url_key(F.col("host"), F.col("path"))
    nothing = F.struct(*[F.lit(None).alias(n) for n in ("n", "host_labels", "rule", "verdict")]).cast(TOP)
    ends = F.array(
        F.struct(key.alias("point"), F.col("top").alias("top")),
        F.struct(F.concat(key, F.lit(AFTER)).alias("point"), F.coalesce("below", nothing).alias("top")),
    )
    return rules_below(rules).select(F.col("host").alias("zone"), F.inline(ends))


def as_of(points: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Each asked row with the top of the last point at or before its own, by one sort of both sides."""
    none = F.lit(None)
    both = points.select(*keys, "point", "top", F.lit(0).alias("asks"), *[none.cast(t).alias(c) for c, t in asked.dtypes if c not in keys and c != "point"])
    both = both.unionByName(asked.select("*", none.cast(TOP).alias("top"), F.lit(1).alias("asks")))
    order = Window.partitionBy(*keys).orderBy("point", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("top", F.last("top", ignorenulls=True).over(order)).where("asks = 1")
    return swept.drop("asks")


def asked_keys(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, zone, point`` for each different host and path and each domain with rules that the host is in.

    Hosts are cut at the numbers of labels rules have, so a host of very many labels asks no more often.
    """
    counts = rules.agg(F.collect_set("top.host_labels").alias("counts")).scalar()
    asked = urls.select("host", "path").distinct().withColumn("labels", F.split("host", r"\.", -1)).withColumn("counts", counts)
    asked = asked.select("host", "path", "labels", F.explode("counts").alias("n")).where("n <= size(labels)")
    asked = asked.select("host", "path", F.array_join(F.slice("labels", -F.col("n"), F.col("n")), ".").alias("zone"))
    asked = asked.join(rules.select(F.col("host").alias("zone")).distinct(), "zone", "left_semi")
    return asked.withColumn("point", url_key(F.col("zone"), F.col("path")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each page's url.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``. A rule fits its
    host and all subdomains if the url's path starts with the rule's; of those that
    fit, the one with the longest host and path together wins, the longer host on a
    tie. Where none fits, ``rule`` is null and the verdict is ``default``. A null url
    or one without ``://`` has an empty host and path, which no rule fits. Rows are
    kept one for one, repeated or without page_id too; other columns are left out.
    An empty rule table gives every page the default. ``salts`` sets the number of
    groups a domain's asked keys are dealt over, which otherwise follows their count.
    """
    rules = rule_table(rules)
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    asked = asked_keys(urls, rules)
    wanted = F.ceil(F.count(F.lit(1)) / GROUP_ROWS) if salts is None else F.lit(salts)
    zones = asked.groupBy("zone").agg(wanted.cast("int").alias("groups"))
    dealt = asked.join(zones, "zone").withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.col("groups")).cast("int")).drop("groups")
    points = sweep_points(rules).join(zones, "zone")
    points = points.select("zone", "point", "top", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"))
    swept = as_of(points, dealt, ["zone", "salt"])
    best = swept.where("top.rule is not null").groupBy("host", "path").agg(F.max("top").alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    )
