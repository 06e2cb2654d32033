"""URL filtering, with DataFrame functions and MLlib trees only.

Explicit rules decide first: a rule fits its host and all subdomains if the
url's path starts with the rule's path; the longest fitting rule wins (the
block rule where an allow and a block rule are equally long). All other urls
are judged by gradient-boosted trees on lexical features: lengths, depth,
digit ratio, character entropy, parameter counts, and statistics of the host's
and the path's suffixes. The trees learn from labelled urls; in the registered
query those are the urls that a rule decides.

Suffix statistics are block rates per suffix itself, counted over all labelled
urls and joined back; an unlabelled suffix has none (rate 0.5, count 0). Entropy
counts every character. The trees are fitted on about ``MAX_TRAIN_ROWS`` distinct
labelled urls, chosen by a hash of the url.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule; if no labelled url exists, or all have one label, the model's
verdict is that label (``allow`` if there is none). Repeated rows are judged
alike. Extra columns are kept unless they carry a result's name.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .quality import let

MAX_TRAIN_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The contract's rules: verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def with_host_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path`` of ``url``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` (like ``net/es/``) and ``rule_verdict``; null where none fits.
    ``rules`` is configuration held on the driver: (verdict, host, path)."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1:]))
    host, path = F.col("host"), F.col("path")
    rule = verdict = None
    for kind, h, p in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return urls.withColumns({"rule": none if rule is None else rule,
                             "rule_verdict": none if verdict is None else verdict})


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character over the text's own characters: sorted, so that each one's
    run ends where the next character differs."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))

    def of(sorted_chars: Column) -> Column:
        n = F.size(sorted_chars).cast("double")
        ends = F.filter(F.transform(sorted_chars, lambda c, i: F.when(
            ~c.eqNullSafe(F.get(sorted_chars, i + 1)), i + 1).otherwise(0)), lambda e: e > 0)
        runs = F.transform(ends, lambda e, i: (e - F.coalesce(F.get(ends, i - 1), F.lit(0))).cast("double"))
        bits = F.aggregate(runs, F.lit(0.0), lambda a, r: a + r * F.log2(r))
        return F.when(n > 0, F.log2(n) - bits / n).otherwise(0.0)

    return let(chars, of)


def _features(urls: DataFrame, url: str) -> tuple[DataFrame, list[str]]:
    u, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    cols = {
        "f_len": F.length(u).cast("double"), "f_host_len": F.length(host).cast("double"),
        "f_path_len": F.length(path).cast("double"),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "f_labels": _count(host, "."), "f_hyphens": _count(host, "-"),
        "f_digits": _count(u, "0123456789") / n, "f_entropy": _entropy(host),
        "f_path_entropy": _entropy(path),
        "f_params": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "f_https": u.startswith("https").cast("double"), "f_fragment": F.contains(u, F.lit("#")).cast("double"),
        "k_host": F.substring_index(host, ".", -1), "k_domain": F.substring_index(host, ".", -2),
        "k_path": F.concat_ws(" ", F.regexp_extract(path, r"(\.[A-Za-z0-9]+|/)$", 1), F.regexp_extract(path, r"^/([a-z]{2})/", 1)),
    }
    return urls.withColumns(cols), [k for k in cols if k[0] == "f"]


def gbt_verdicts(urls: DataFrame, label: str, url: str = "url", max_train_rows: int = MAX_TRAIN_ROWS,
                 max_iter: int = 12) -> DataFrame:
    """Add ``model_verdict`` (allow or block). ``label`` names a column with
    allow, block or null; rows with a label train the trees."""
    # the caller's row travels as one column, so its names meet none of those made here
    own = urls.select(F.struct(*urls.columns).alias("row"), F.col(url).alias("url"), "host", "path",
                      (F.col(label) == "block").cast("double").alias("y"))
    feats, cols = _features(own, "url")
    labelled = feats.where("y is not null")
    n, blocks, n_urls = labelled.agg(F.count(F.lit(1)), F.sum("y"), F.approx_count_distinct("url")).first()
    if not n or blocks in (0, n):
        return urls.withColumn("model_verdict", F.lit("block" if n and blocks else "allow"))
    for key in ("k_host", "k_domain", "k_path"):
        stats = labelled.groupBy(key).agg(((F.sum("y") + 1) / (F.count(F.lit(1)) + 2)).alias(f"{key}_rate"),
                                          F.log1p(F.count(F.lit(1))).alias(f"{key}_n"))
        stats = stored(stats, "url-suffixes")  # a row per suffix: the planner knows its size
        feats = feats.join(stats, key, "left").fillna({f"{key}_rate": 0.5, f"{key}_n": 0.0})
        cols += [f"{key}_rate", f"{key}_n"]
    vectors = VectorAssembler(inputCols=cols, outputCol="v")
    chosen = feats.where("y is not null").where(
        F.pmod(F.xxhash64("url", F.lit("train")), F.lit(1_000_000)) < int(1e6 * min(1.0, max_train_rows / max(n_urls, 1))))
    train = stored(vectors.transform(chosen).select("v", "y").distinct(), "url-train")  # a url that repeats counts once
    if train.select("y").distinct().count() < 2:
        return urls.withColumn("model_verdict", F.lit("block" if 2 * blocks > n else "allow"))
    model = GBTClassifier(featuresCol="v", labelCol="y", maxIter=max_iter, maxDepth=4, stepSize=0.3,
                          seed=7, predictionCol="p", checkpointInterval=-1).fit(train)
    model = model.setRawPredictionCol("r").setProbabilityCol("q")
    out = model.transform(vectors.transform(feats))
    return out.select("row.*", F.when(F.col("p") > 0.5, "block").otherwise("allow").alias("model_verdict"))


def url_filter(urls: DataFrame, rules=RULES, url: str = "url", max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """Add host, path, rule, model_verdict and verdict."""
    own = ("host", "path", "rule", "rule_verdict", "model_verdict", "verdict")
    src = urls.drop(*(c for c in urls.columns if c.lower() in own))
    judged = gbt_verdicts(with_rule(with_host_path(src, url), rules), "rule_verdict", url, max_train_rows)
    return judged.withColumn("verdict", F.coalesce("rule_verdict", "model_verdict")).drop("rule_verdict")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


SQL: dict[str, str] = {}
