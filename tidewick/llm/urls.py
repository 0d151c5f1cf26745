"""URL filter: host and path rules, and gradient-boosted trees on lexical features where no rule fits."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidewick.session import prepare, shared_dir, written

Rule = tuple[bool, str]  # (allow, "host/path")
RULES: list[Rule] = [(True, "org/"), (False, "example.org/es/"), (False, "example.org/en/1"), (True, "com/fr/"), (False, "com/de/")]
SAMPLE = 20_000  # labelled urls that the trees are grown on, by the smallest hash
TREES, LEVELS = 20, 4
BLOCK_FROM = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- parts of a url
def rest_of(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


# ---- rules
def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, null if none does. A rule's host fits itself and its subdomains; its path fits paths
    that start with it. Of equally long rules the one listed first counts. The list is a parameter of bounded length."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = (host == name) | host.endswith("." + name)
        out = F.when(fits & path.startswith("/" + start), F.lit(rule)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: list[Rule]) -> Column:
    allowed = [r for allow, r in rules if allow]
    return F.when(rule.isNull(), None).when(rule.isin(allowed), "allow").otherwise("block")


# ---- features
def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    length = F.length(text)
    # Over distinct characters: a count is what the text loses when the character is taken out.
    each = F.aggregate(
        F.array_distinct(F.split(text, "")), F.lit(0.0),
        lambda total, c: total + F.when(c == "", 0.0).otherwise(
            (length - F.length(F.replace(text, c, F.lit("")))) * F.ln(length - F.length(F.replace(text, c, F.lit(""))))))
    return F.when(length > 0, (F.ln(length) - each / length) / F.lit(0.6931471805599453)).otherwise(0.0)


def lexical(urls: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> tuple[DataFrame, list[str]]:
    """``urls`` with feature columns, and their names."""
    whole, h, p = F.coalesce(F.col(url), F.lit("")), F.col(host), F.col(path)
    query = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)

    def share(text: Column, pattern: str) -> Column:
        return F.when(F.length(text) > 0, (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / F.length(text)).otherwise(0.0)

    features = {
        "f_length": F.length(whole).cast("double"), "f_host_length": F.length(h).cast("double"), "f_path_length": F.length(p).cast("double"),
        "f_depth": F.greatest(F.lit(0), F.size(F.split(p, "/")) - 1).cast("double"), "f_labels": F.size(F.split(h, r"\.")).cast("double"),
        "f_digits": share(whole, "[0-9]"), "f_host_digits": share(h, "[0-9]"), "f_path_digits": share(p, "[0-9]"),
        "f_hyphens": F.regexp_count(h, F.lit("-")).cast("double"), "f_entropy": entropy(h), "f_path_entropy": entropy(p),
        "f_params": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0).cast("double"),
        "f_fragment": whole.contains("#").cast("double"), "f_secure": whole.startswith("https:").cast("double"),
        "f_last_digits": share(F.regexp_extract(p, r"([^/]*)/*$", 1), "[0-9]"), "f_dot_in_path": p.contains(".").cast("double"),
        "f_slash_end": p.endswith("/").cast("double"),
    }
    return urls.withColumns(features), list(features)


SUFFIXES = {
    "s_top": lambda: F.regexp_extract("host", r"([^.]*)$", 1),
    "s_domain": lambda: F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1),
    "s_first": lambda: F.regexp_extract("path", r"^/([^/]*)", 1),
}
MOST_SUFFIXES = 2_000  # of each kind; rarer ones get the overall share


def suffix_shares(labelled: DataFrame) -> dict[str, tuple[dict[str, float], float]]:
    """For each kind of suffix: smoothed share of blocked urls per value, and the share over all."""
    out = {}
    base = float(labelled.agg(F.avg("label")).first()[0] or 0.0)
    for name, value in SUFFIXES.items():
        rows = labelled.groupBy(value().alias("v")).agg(F.count("*").alias("n"), F.sum("label").alias("k")).orderBy(F.desc("n"), "v").limit(MOST_SUFFIXES).collect()
        out[name] = ({r["v"]: (r["k"] + 5 * base) / (r["n"] + 5) for r in rows}, base)
    return out


def featured(urls: DataFrame, shares: dict) -> tuple[DataFrame, list[str]]:
    frame, names = lexical(urls)
    for name, (known, base) in shares.items():
        pairs = [F.lit(x) for kv in known.items() for x in kv]
        found = F.try_element_at(F.create_map(*pairs), SUFFIXES[name]()) if pairs else F.lit(None).cast("double")
        frame = frame.withColumn(name, F.coalesce(found, F.lit(base)))
    return frame, names + list(shares)


# ---- the model
class UrlFilter:
    """Trees and suffix statistics; ``only`` is set if the labels held one class alone."""

    def __init__(self, model: GBTClassificationModel | None, shares: dict, only: float = 0.0):
        self.model, self.shares, self.only = model, shares, only

    @classmethod
    def fit(cls, labelled: DataFrame, bound: int = SAMPLE, trees: int = TREES, levels: int = LEVELS) -> "UrlFilter":
        """``labelled``: url, host, path, label (1 blocked, 0 allowed). At most ``bound`` rows are used."""
        spark = labelled.sparkSession
        shared_dir(spark)  # trees cut their lineage there
        chosen = labelled.where("label IS NOT NULL").select("url", "host", "path", F.col("label").cast("double").alias("label"))
        sample = written(chosen.orderBy(F.xxhash64("url"), "url").limit(bound), "url-sample")
        classes = [r[0] for r in sample.select("label").distinct().collect()]
        if len(classes) < 2:
            return cls(None, {}, classes[0] if classes else 0.0)
        shares = suffix_shares(sample)
        frame, names = featured(sample, shares)
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(frame).select("label", "features")
        return cls(GBTClassifier(maxIter=trees, maxDepth=levels, seed=7, checkpointInterval=5).fit(vectors), shares)

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with url, host, path) and block_score, the probability of being blocked."""
        if self.model is None:
            return urls.withColumn("block_score", F.lit(float(self.only)))
        keep = urls.columns
        frame, names = featured(urls, self.shares)
        vectors = VectorAssembler(inputCols=names, outputCol="_features").transform(frame)
        model = self.model.setFeaturesCol("_features").setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_label")
        return model.transform(vectors).select(*keep, vector_to_array("_probability")[1].alias("block_score"))


def with_parts(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    return rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))


def judge(pages: DataFrame, rules: list[Rule] | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_score.

    Where a rule fits, its verdict counts; else the trees': block from a score of one half. They are trained on
    ``labelled`` (url, label) or, without it, on the urls that rules decide. A null url, or one without ``://``, has
    empty host and path, so no rule, and is scored by its features. Repeated rows are judged each; other columns are
    ignored; without labels of both kinds every url gets the one verdict there is (allow if none).
    """
    prepare(pages.sparkSession)
    rules = RULES if rules is None else rules
    parts = with_parts(pages, rules)
    if labelled is None:
        known = parts.where("rule IS NOT NULL").withColumn("label", (rule_verdict(F.col("rule"), rules) == "block").cast("double"))
    else:
        known = labelled.select(F.col("url").cast("string").alias("url"), "label").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    scored = UrlFilter.fit(known).score(parts)
    verdict = F.coalesce(rule_verdict(F.col("rule"), rules), F.when(F.col("block_score") >= BLOCK_FROM, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
