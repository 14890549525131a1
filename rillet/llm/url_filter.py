"""URL filters: allow and block rules, and gradient-boosted trees where no rule fits.

Rules are host suffixes with a path prefix. URLs that a rule decides are the
labelled ones; boosted trees learn from lexical features of a bounded sample of
them and decide the rest. The suffix statistics among the features cover all
labelled URLs. DataFrame functions and Spark ML throughout.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import ascii_lower, written

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Labelled URLs the trees are fitted to (those with the smallest hash of URL and page_id,
#: so that a URL of many pages doesn't fill the sample).
SAMPLE = 20_000
TREES, DEPTH = 10, 4
#: A suffix seen less often among the labelled URLs leans to the share of all.
PRIOR = 20
#: The rates of a fitted URL come from the other folds.
FOLDS = 10

FEATURES = ["url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio", "path_digit_ratio",
            "entropy", "params", "hyphens", "dots", "has_extension", "https", "last_segment_length", "first_segment_length",
            "suffix_rate", "suffix_count", "domain_rate", "domain_count", "section_rate", "section_count"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty for a null URL or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _digits(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", ""))


def entropy(text: Column) -> Column:
    """Bits per character of the characters' distribution (0 for an empty text)."""
    size = F.length(text)
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    p = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    return F.aggregate(chars, F.lit(0.0), lambda s, c: s - p(c) * F.log2(p(c)))


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (with ``_url``, ``_host``, ``_path``) plus the lexical features and suffix keys."""
    url, host, path = F.col("_url"), F.col("_host"), F.col("_path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    first = F.coalesce(F.get(segments, F.lit(0)), F.lit(""))
    last = F.coalesce(F.get(segments, F.size(segments) - 1), F.lit(""))
    cols = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": F.size(segments), "host_labels": F.size(labels), "digit_ratio": _ratio(_digits(url), F.length(url)),
        "path_digit_ratio": _ratio(_digits(path), F.length(path)), "entropy": entropy(url),
        "params": F.when(query == "", F.lit(0)).otherwise(_count(query, "&") + 1), "hyphens": _count(url, "-"), "dots": _count(host, "."),
        "has_extension": last.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"), "https": url.startswith("https").cast("int"),
        "last_segment_length": F.length(last), "first_segment_length": F.length(first),
    }
    return pages.select("*", *(c.cast("double").alias(f"_x_{n}") for n, c in cols.items()),
                        F.element_at(labels, -1).alias("_suffix"), F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("_domain"),
                        first.alias("_section"))


def suffix_statistics(labelled: DataFrame, key: str, *by: str) -> DataFrame:
    """(key, by..., blocked and all of the labelled URLs with that value of a suffix key)."""
    name = key[1:]
    return labelled.groupBy(key, *by).agg(F.sum("_label").alias(f"_b_{name}"), F.count(F.lit(1)).alias(f"_n_{name}"))


def _with_statistics(rows: DataFrame, stats: dict[str, DataFrame], share: float, folds: dict[str, DataFrame] | None = None) -> DataFrame:
    """``rows`` with the rate and log count of each suffix key, leaning to ``share``.

    ``folds`` (the same statistics by ``_fold``) is given for the rows that the trees are fitted to: a row's rates then
    come from the other folds, so no row sees its own label, and rows of one fold and key
    see the same rate whatever their label (a rate without the row's own label alone would give it away)."""
    for key, table in stats.items():
        name = key[1:]
        b, n = F.coalesce(F.col(f"_b_{name}"), F.lit(0.0)), F.coalesce(F.col(f"_n_{name}"), F.lit(0)).cast("double")
        rows = rows.join(table, key, "left")
        if folds:
            rows = rows.join(folds[key].withColumnsRenamed({f"_b_{name}": "_fb", f"_n_{name}": "_fn"}), [key, "_fold"], "left")
            b, n = b - F.coalesce("_fb", F.lit(0.0)), n - F.coalesce("_fn", F.lit(0))
        rows = rows.withColumns({f"_x_{name}_rate": (b + PRIOR * share) / (n + PRIOR), f"_x_{name}_count": F.log1p(n)}).drop(
            f"_b_{name}", f"_n_{name}", "_fb", "_fn")
    return rows


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_x_{f}" for f in FEATURES], outputCol="_features").transform(rows)


def url_verdicts(pages: DataFrame, rules=RULES, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability of every page.

    ``block_probability`` is null where a rule decides. The trees learn from at
    most ``sample`` rule-decided URLs, the suffix statistics from all. With rule-decided URLs of one kind only, that
    kind is the verdict of all others; with none at all it is ``allow``."""
    given = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    named = given.withColumn("_host", host).withColumn("_path", path)
    rule, verdict = matched_rule(F.col("_host"), F.col("_path"), rules)
    rows = written(lexical(named.withColumn("_rule", rule).withColumn("_verdict", verdict)), "urls")
    labelled = rows.where("_verdict is not null").withColumn("_label", (F.col("_verdict") == "block").cast("double"))
    n, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0.0))).first()
    decided = F.coalesce(F.col("_verdict"), F.when(F.col("_p") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    if 0 < blocked < n:
        share = blocked / n
        labelled = labelled.withColumn("_fold", F.pmod(F.xxhash64("_url", F.lit(3)), F.lit(FOLDS)).cast("int"))
        keys = ("_suffix", "_domain", "_section")
        stats = {k: written(suffix_statistics(labelled, k), "suffixes") for k in keys}
        folds = {k: written(suffix_statistics(labelled, k, "_fold"), "suffix-folds") for k in keys}
        fit_rows = written(labelled.orderBy(F.xxhash64("_url", "page_id"), "_url", "page_id").limit(sample).coalesce(4), "labelled-urls")
        fitted = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, seed=7,
                               predictionCol="_pred").setProbabilityCol("_prob").setRawPredictionCol("_raw")
        model = fitted.fit(_assembled(_with_statistics(fit_rows, stats, share, folds)).select("_features", "_label"))
        scored = model.transform(_assembled(_with_statistics(rows, stats, share)))
        scored = scored.withColumn("_p", F.when(F.col("_verdict").isNull(), F.element_at(vector_to_array("_prob"), 2)))
    else:
        scored = rows.withColumn("_p", F.when(F.col("_verdict").isNull(), F.lit(1.0 if n and blocked == n else 0.0)))
    return scored.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                         decided.alias("verdict"), F.col("_p").alias("block_probability"))
