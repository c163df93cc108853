"""URL filters, in DataFrame functions only.

Each URL becomes the pairs of a host suffix (whole labels) and a path prefix that ends in ``/`` whose shape some rule
has: its number of labels, its number of slashes, and no more characters than the longest rule of that shape. No
other pair can equal a rule, so a URL's work is linear in its length for a given set of rules, whatever it holds. The
pairs are equi-joined to the rules' (host, path up to its last ``/``) on the first ``prefix_hex`` digits
of a SHA-256, and confirmed on the full digest and on the rest of the rule's path. The longest rule
(host and path together) wins, then the longer host, then a block before an allow. The shapes (a few numbers per
distinct shape of a rule) are the only part of the rules that the driver holds.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path and fits no rule;
so does an empty host. Without a rule the verdict is ``default``. Every row gives one row, repeated rows
and null ids included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower

# The contract's rules: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BROADCAST_RULES, BROADCAST_CHARS = 100_000, 8 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def prepare_rules(rules: DataFrame, prefix_hex: int) -> DataFrame:
    """Distinct rules with the digest of their joinable part; of equal places a block wins."""
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    r = (rules.where("host is not null and host != ''").select(host.alias("r_host"), path.alias("r_path"), "verdict")
         .groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict")))
    # The path up to its last slash; the rest is compared as text.
    folder = F.regexp_extract("r_path", r"(?s)^(.*/)?", 0)
    r = r.withColumn("r_digest", F.sha2(F.concat("r_host", F.lit(" "), folder), 256))
    r = r.withColumn("r_labels", F.size(F.split("r_host", r"\."))).withColumn("r_slashes", F.size(F.split("r_path", "/")) - 1)
    return r.withColumn("r_folder", F.length(folder)).withColumn("r_key", F.substring("r_digest", 1, prefix_hex))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """One row per page: page_id, url, host, path, rule, verdict."""
    r = prepare_rules(rules, prefix_hex)
    shapes = r.groupBy(F.col("r_labels").alias("labels"), F.col("r_slashes").alias("slashes")).agg(
        F.max(F.length("r_host")).alias("host"), F.max("r_folder").alias("folder"), F.count("*").alias("n"),
        F.sum(F.length("r_host") + F.length("r_path")).alias("chars")).collect()
    if sum(z["n"] for z in shapes) <= BROADCAST_RULES and sum(z["chars"] for z in shapes) <= BROADCAST_CHARS:
        r = F.broadcast(r)
    base = (pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url")
            .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
    # substring_index counts from the left, or with a negative count from the right; both are linear.
    base = (base.withColumn("labels", F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1)
            .withColumn("slashes", F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))))
    pairs = F.array_compact(F.array(*[
        F.when((F.col("labels") >= z["labels"]) & (F.col("slashes") >= z["slashes"]) & (F.length(suffix) <= z["host"]) & (F.length(folder) <= z["folder"]),
               F.concat(suffix, F.lit(" "), folder))
        for z in shapes for suffix, folder in [(F.substring_index("host", ".", -z["labels"]),
                                                F.concat(F.substring_index("path", "/", z["slashes"]), F.lit("/" if z["slashes"] else "")))]]))
    one = (base.withColumn("pair", F.explode_outer(F.when(F.col("host") != "", pairs) if shapes else F.lit(None).cast("array<string>")))
           .withColumn("d", F.sha2("pair", 256)).withColumn("k", F.substring("d", 1, prefix_hex)))
    fits = (F.col("d") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path"))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("hn"),
                    F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))
    cols = ["row", "page_id", "url", "host", "path"]
    # A page's rows meet again where they were made when the rules are broadcast (partial aggregation).
    all_rows = one.join(r, one["k"] == r["r_key"], "left").select(*cols, F.when(fits, rank).alias("best"))
    return (all_rows.groupBy(*cols).agg(F.max("best").alias("best"))
            .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def url_report(pages: DataFrame, rules: DataFrame | None = None, **options) -> DataFrame:
    rules = rule_table(pages.sparkSession) if rules is None else rules
    return judge(pages, rules, **options).select("page_id", "host", "path", "rule", "verdict")
