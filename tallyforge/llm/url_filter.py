"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest."""
from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.session import stored

FEATURES = (
    "url_length", "host_length", "host_labels", "path_length", "depth", "digit_ratio", "entropy", "parameters", "fragment", "hyphens", "secure", "suffix_rate", "suffix_seen",
)
MOST_RULES = 1000


def host_of(url):
    """Host, A-Z lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """Path, without query and fragment; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host, path, rules):
    """The longest rule (of equal ones the first by text) that fits, as a column; null if none does.

    ``rules`` maps ``host/path`` to a verdict. A rule fits its host and subdomains when the path starts with its path.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules; join longer lists by host")
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        owner, _, rest = rule.partition("/")
        fits = ((host == owner) | host.endswith("." + owner)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if out is None else out


def _entropy(text):
    """Bits of the distribution of characters."""
    chars = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    parts = F.transform(F.array_distinct(chars), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(F.filter(parts, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))


def suffix_of(host):
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def features(pages, url="url"):
    """``pages`` with host, path, suffix and the lexical features of the url (``_f_`` columns)."""
    u = F.coalesce(F.col(url), F.lit(""))
    rows = pages.withColumns({"_host": host_of(F.col(url)), "_path": path_of(F.col(url))})
    n = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    numbers = {
        "url_length": n, "host_length": F.length("_host"), "host_labels": F.size(F.split("_host", r"\.")), "path_length": F.length("_path"),
        "depth": F.size(F.filter(F.split("_path", "/"), lambda s: s != "")),
        "digit_ratio": F.regexp_count(u, F.lit("[0-9]")) / F.greatest(n, F.lit(1)), "entropy": _entropy(u),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")), "fragment": F.contains(u, F.lit("#")).cast("int"),
        "hyphens": F.regexp_count(u, F.lit("[-_]")), "secure": F.startswith(u, F.lit("https:")).cast("int"),
    }
    return rows.withColumn("_suffix", suffix_of(F.col("_host"))).withColumns({f"_f_{k}": v.cast("double") for k, v in numbers.items()})


class UrlModel:
    """Suffix statistics of the labelled URLs and the trees over all features."""

    def __init__(self, suffixes, base, trees):
        self.suffixes, self.base, self.trees = suffixes, base, trees

    def blocked(self, rows):
        """``rows`` of :func:`features` with the probability to block."""
        if self.trees is None:
            return rows.withColumn("_block", F.lit(float(self.base)))
        known = self.suffixes.select("_suffix", F.col("rate").alias("_f_suffix_rate"), F.log1p("n").alias("_f_suffix_seen"))
        full = rows.join(known, "_suffix", "left").fillna({"_f_suffix_rate": float(self.base), "_f_suffix_seen": 0.0})
        scored = self.trees.transform(_assembler().transform(full))
        return scored.withColumn("_block", vector_to_array("probability")[1])


def _assembler():
    return VectorAssembler(inputCols=[f"_f_{f}" for f in FEATURES], outputCol="_x")


def fit(labelled, url="url", label="blocked", trees=20, depth=4, prior=20.0, seed=11):
    """Learn from labelled URLs (label 1: block; null labels are left out).

    A suffix has the share of blocked URLs among its labelled ones, drawn to the overall share by ``prior`` rows; for
    training, a row's share comes from the other four fifths of the rows alone. With one class only, or no rows, every URL gets that class's share (0 without rows).
    """
    rows = stored(features(labelled.where(F.col(label).isNotNull()).select(F.col(url), F.col(label).cast("double").alias("y")), url).drop(url), "urls")
    total = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    base = total[1] / total[0] if total[0] else 0.0
    if base in (0.0, 1.0):
        return UrlModel(None, base, None)
    counts = rows.groupBy("_suffix").agg(F.count("*").alias("n"), F.sum("y").alias("b"))
    suffixes = stored(counts.withColumn("rate", (F.col("b") + prior * base) / (F.col("n") + prior)), "suffixes")
    fold = F.pmod(F.xxhash64("_host", "_path"), F.lit(5))
    own = rows.groupBy("_suffix", fold.alias("_fold")).agg(F.count("*").alias("n_own"), F.sum("y").alias("b_own"))
    n, b = F.col("n") - F.col("n_own"), F.col("b") - F.col("b_own")
    rest = stored(own.join(suffixes, "_suffix").select("_suffix", "_fold", ((b + prior * base) / (n + prior)).alias("_f_suffix_rate"), F.log1p(n).alias("_f_suffix_seen")), "suffix-folds")
    others = rows.withColumn("_fold", fold).join(rest, ["_suffix", "_fold"])
    train = stored(_assembler().transform(others).select("_x", "y"), "url-training")
    machine = GBTClassifier(featuresCol="_x", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=1.0, seed=seed)
    return UrlModel(suffixes, base, machine.fit(train))


def judge(pages, rules, model, key="page_id", url="url", threshold=0.5):
    """Each row's key, host, path, rule, verdict (allow or block), and the model's probability to block.

    A fitting rule decides, else the model: block from the threshold on. Null and malformed URLs have empty host and
    path and go to the model. Repeated rows and null keys each get a row; other columns are ignored.
    """
    rows = model.blocked(features(pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")), "_url"))
    rows = rows.withColumn("rule", rule_for(F.col("_host"), F.col("_path"), rules))
    verdict = None
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(what)) if verdict is None else verdict.when(F.col("rule") == rule, F.lit(what))
    learned = F.when(F.col("_block") >= threshold, "block").otherwise("allow")
    return rows.select(F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", (learned if verdict is None else verdict.otherwise(learned)).alias("verdict"), F.col("_block").alias("block_probability"))


def labelled_pages(pages, labels):
    """URLs with the labels of the record they name: the first number of the path. Low quality or toxic means block."""
    number = F.regexp_extract(path_of(F.col("url")), "([0-9]+)", 1).try_cast("long")
    truth = labels.select("doc_id", F.greatest(1 - F.col("quality"), F.col("toxic")).alias("blocked")).dropna().groupBy("doc_id").agg(F.max("blocked").alias("blocked"))
    return pages.select("url", number.alias("doc_id")).where("doc_id is not null").join(truth, "doc_id").select("url", "blocked")
