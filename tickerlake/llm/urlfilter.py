"""URL filter: rules first, then gradient-boosted trees on lexical features (DataFrame operations only).

A rule ``host/path`` fits its host and all subdomains if the url's path starts
with the rule's; the longest fitting rule decides.  Other urls are judged by
boosted trees fitted on labelled urls.  Features: lengths, path depth, digit
ratio, character entropy, parameter count, host labels, hyphens, and for the
last one and two labels of the host the smoothed share of blocked urls among
the labelled ones that have it.

Rules reach the tasks as one map, in blocks of at most ``RULES_PER_BLOCK``
rules.  Suffix statistics cover all labelled urls and are joined by the suffix
itself; suffixes of more than 1 in ``SALTS`` urls (fewer than ``SALTS``) are
spread over that many keys.  Only the trees are fitted on a sample, of about
``SAMPLE`` labelled urls: each class gives its share, but ``LEAST`` rows if it
has them.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged by its (empty) features; of equally long rules
the one with the longer host, then the first in text order, wins; null rules
and labelled rows with nulls are ignored; with no labelled url, or one class
only, the method's verdict is that class (``allow`` without any); repeated
rows are judged alike; very long urls are read whole; empty tables give empty
results; columns of the input pass through unless they have the name of a
result column.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import stored

RULES_PER_BLOCK = 50_000
SALTS = 128
SAMPLE = 20_000
LEAST = 1000
TREES = 12
DEPTH = 3
PRIOR = 20.0  # rows by which a suffix's share is drawn to the overall share
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = ["f_length", "f_host_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_hyphens", "f_suffix1", "f_suffix2"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def rule_table(rules: DataFrame) -> DataFrame:
    """rule, rule_host, rule_path, rule_verdict from (rule, verdict); one verdict a rule (block before allow)."""
    return rules.where("rule is not null and verdict is not null").groupBy("rule").agg(F.max("verdict").alias("rule_verdict")).select(
        "rule", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("rule_host"),
        F.when(F.instr("rule", "/") > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("rule_path"), "rule_verdict")


def with_rules(urls: DataFrame, rules: DataFrame, rules_per_block: int = RULES_PER_BLOCK) -> DataFrame:
    """Add ``best``: the winning rule as (length, host length, rule, verdict), or null.  Needs host and path."""
    table = rule_table(rules)
    blocks = table.count() // rules_per_block + 1
    urls = urls.withColumn("best", F.lit(None).cast("struct<length: int, host_length: int, tie: string, rule: string, verdict: string>"))
    for k in range(blocks):
        block = table.where(F.pmod(F.xxhash64("rule_host"), F.lit(blocks)) == k)
        entry = F.struct(
            F.length("rule").alias("length"), F.length("rule_host").alias("host_length"),
            F.translate("rule", "".join(map(chr, range(33, 127))), "".join(map(chr, range(126, 32, -1)))).alias("tie"),
            "rule", F.col("rule_verdict").alias("verdict"), F.col("rule_path").alias("path"))
        by_host = block.groupBy("rule_host").agg(F.collect_list(entry).alias("rules"))
        lookup = by_host.agg(F.map_from_entries(F.collect_list(F.struct("rule_host", "rules"))).alias("m"))
        urls = urls.withColumn("lookup", lookup.scalar())
        fitting = F.filter(
            F.flatten(F.transform(suffixes(F.col("host")), lambda s: F.coalesce(F.col("lookup")[s], F.array()))),
            lambda r: F.startswith(F.col("path"), r["path"]))
        plain = F.transform(fitting, lambda r: F.struct(r["length"], r["host_length"], r["tie"], r["rule"], r["verdict"]))
        urls = urls.withColumn("best", F.array_max(F.array_append(plain.cast(
            "array<struct<length: int, host_length: int, tie: string, rule: string, verdict: string>>"), F.col("best")))).drop("lookup")
    return urls


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def suffix_statistics(labelled: DataFrame) -> list[DataFrame]:
    """For the last one and two labels: (suffix, share), the smoothed share of blocked urls among the labelled ones."""
    host, _ = host_and_path(F.col("url"))
    out = []
    for labels in (1, 2):
        sums = labelled.groupBy(_suffix(host, labels).alias("suffix")).agg(F.sum("label").alias("s"), F.count("*").alias("n"))
        share = sums.agg((F.sum("s") / F.sum("n")).alias("p")).scalar()
        out.append(sums.select("suffix", ((F.col("s") + PRIOR * share) / (F.col("n") + PRIOR)).alias("share")))
    return out


def with_shares(urls: DataFrame, statistics: list[DataFrame]) -> DataFrame:
    """Add f_suffix1 and f_suffix2 (-1 for a suffix without labelled urls) to rows with a url."""
    host, _ = host_and_path(F.col("url"))
    total = urls.count() if statistics else 0
    for k, s in enumerate(statistics, 1):
        counts = urls.groupBy(_suffix(host, k).alias("f_key")).count()
        hot = [r.f_key for r in counts.where(F.col("count") * SALTS > total).collect()]
        salt = F.when(F.col("f_key").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int")
        last = F.when(F.col("suffix").isin(hot), SALTS - 1).otherwise(0)
        salted = s.select(F.col("suffix").alias("f_key"), F.explode(F.sequence(F.lit(0), last)).alias("f_salt"), F.col("share").alias(f"f_suffix{k}"))
        # A merge join at every size: the table of suffixes grows with the labelled urls.
        urls = urls.withColumn("f_key", _suffix(host, k)).withColumn("f_salt", salt).join(salted.hint("merge"), ["f_key", "f_salt"], "left")
        urls = urls.withColumn(f"f_suffix{k}", F.coalesce(f"f_suffix{k}", F.lit(-1.0))).drop("f_key", "f_salt")
    return urls


def with_features(urls: DataFrame, statistics: list[DataFrame]) -> DataFrame:
    """Add the FEATURES columns to rows with a url."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return with_shares(urls, statistics).withColumns({
        "f_length": size, "f_host_length": F.length(host).cast("double"),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "f_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / size, "f_entropy": entropy,
        "f_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "f_labels": F.size(F.split(host, r"\.")).cast("double"),
        "f_hyphens": F.length(F.regexp_replace(host, "[^-]", "")).cast("double")})


class Filter:
    """Suffix statistics and trees; ``constant`` stands in where there is one class of labels or none."""

    def __init__(self, statistics: list[DataFrame], model: GBTClassificationModel | None, constant: str):
        self.statistics, self.model, self.constant = statistics, model, constant

    def verdicts(self, urls: DataFrame) -> DataFrame:
        """Add ``method``: allow or block."""
        if self.model is None:
            return urls.withColumn("method", F.lit(self.constant))
        scored = self.model.transform(VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(with_features(urls, self.statistics)))
        scored = scored.withColumn("method", F.when(F.col("f_prediction") > 0.5, "block").otherwise("allow"))
        return scored.drop(*FEATURES, "f_vector", "f_prediction", "f_raw", "f_probability")


def _sample(rows: DataFrame, found: dict[float, int], size: int) -> DataFrame:
    """About ``size`` of the rows (url, label), each class by its own rate, so that none is left out.

    Of n copies of a row n times the rate stay, rounded up or down by a hash of the row.
    """
    total = sum(found.values())
    rate = {label: min(1.0, max(size * n / total, LEAST) / n) for label, n in found.items()}
    u = F.pmod(F.xxhash64("url", "label", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("count") * F.when(F.col("label") == 1, rate[1.0]).otherwise(rate[0.0]) + u).cast("int")
    kept = rows.groupBy("url", "label").count().withColumn("copies", copies).where("copies > 0")
    return kept.select("url", "label", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def fit(labelled: DataFrame, size: int = SAMPLE) -> Filter:
    """Fit on labelled urls: (url, label) with label 1 for block, 0 for allow."""
    rows = labelled.where("url is not null and label in (0, 1)").select("url", F.col("label").cast("double").alias("label"))
    found = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(found) < 2:
        return Filter([], None, "block" if 1.0 in found else "allow")
    statistics = [stored(s, "url-suffixes") for s in suffix_statistics(rows)]
    rows = stored(_sample(rows, found, size), "url-labels")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(with_features(rows, statistics)).select("label", "f_vector")
    trees = GBTClassifier(featuresCol="f_vector", labelCol="label", predictionCol="f_prediction", maxIter=TREES, maxDepth=DEPTH, seed=3)
    trees = trees.setRawPredictionCol("f_raw").setProbabilityCol("f_probability")
    return Filter(statistics, trees.fit(vectors), "allow")


RESULT = ["host", "path", "rule", "verdict"]


def judge(urls: DataFrame, rules: DataFrame, labelled: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows with host, path, rule and verdict appended."""
    own = F.struct(*[F.col(f"`{c}`") for c in urls.columns if c not in RESULT]).alias("own")
    host, path = host_and_path(F.col("url"))
    rows = with_rules(urls.select("url", own, host.alias("host"), path.alias("path")), rules)
    judged = fit(labelled, size).verdicts(rows)
    return judged.select("own.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", "method").alias("verdict"))
