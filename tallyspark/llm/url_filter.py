r"""URL filters: allow and block rules first, then gradient-boosted trees on
lexical features.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end; a null url or one
without ``://`` has neither (both empty). A rule ``host/path`` fits its host
and all its subdomains when the url's path starts with the rule's (``net/``
has path ``/``); the longest rule wins.

The urls that a rule decides are the labelled ones. The trees
(``pyspark.ml`` ``GBTClassifier``) learn from at most ``TRAIN_ROWS`` distinct
ones, those of each verdict with the lowest hashes (half from each verdict),
weighted by their rows; they judge the others. Features: lengths of url, host, path and query, path
depth, host labels, digit ratio, character entropy, hyphens, parameter counts,
scheme, and block rates and counts of the last one and last two host labels.
Those suffix statistics count every labelled url, in a fixed number of hash
buckets, so the tables to broadcast have a fixed size.

Cases: with no labelled url, or one verdict only, there is nothing to learn:
the method's verdict is then ``allow``, or that one verdict. Repeated rows are
judged alike; empty tables give an empty result; very long urls are read
whole; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import lowest, table
from tallyspark.session import stage

# The rules of the registered query: (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

TRAIN_ROWS = 20_000
TREES = 12
DEPTH = 4
ONE_LABEL_BUCKETS = 1024
TWO_LABEL_BUCKETS = 4096
PRIOR = 2.0         # weight of the overall block rate in a suffix's rate
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("url_len", "host_len", "path_len", "query_len", "depth", "labels", "digit_ratio", "entropy",
            "hyphens", "params", "values", "https", "tld_rate", "tld_n", "domain_rate", "domain_n")


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(whole, pattern, 1), UPPER, LOWER), F.regexp_extract(whole, pattern, 2))


def best_rule(host: Column, path: Column, rules) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        r_host, _, r_path = rule.partition("/")
        on_host = (host == r_host) | host.endswith("." + r_host)
        fits.append(F.when(on_host & path.startswith("/" + r_path),
                           F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def count_of(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    chars = F.array_distinct(F.split(text, "", -1))
    bits = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(pages: DataFrame, id_col: str, url_col: str, rules) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = split_url(F.col(url_col))
    df = pages.select(F.col(id_col).alias("id"), url.alias("url"), host.alias("host"), path.alias("path"))
    query = F.regexp_extract("url", r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    df = df.select(
        "id", "host", "path", best_rule(F.col("host"), F.col("path"), rules).alias("fit"),
        F.xxhash64("url").alias("url_hash"),
        F.pmod(F.xxhash64(F.element_at(labels, -1)), F.lit(ONE_LABEL_BUCKETS)).alias("tld"),
        F.pmod(F.xxhash64(F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))),
               F.lit(TWO_LABEL_BUCKETS)).alias("domain"),
        F.length("url").alias("url_len"), F.length("host").alias("host_len"), F.length("path").alias("path_len"),
        F.length(query).alias("query_len"), count_of(F.col("path"), "/").alias("depth"),
        F.size(labels).alias("labels"),
        (F.length(F.regexp_replace("url", "[^0-9]", "")) / F.greatest(F.length("url"), F.lit(1))).alias("digit_ratio"),
        entropy(F.col("url")).alias("entropy"), count_of(F.col("url"), "-").alias("hyphens"),
        F.when(F.length(query) > 0, count_of(query, "&") + 1).otherwise(0).alias("params"),
        count_of(query, "=").alias("values"), F.col("url").startswith("https").cast("int").alias("https"))
    return df.select("*", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled")).drop("fit")


def _suffix_table(labelled: DataFrame, key: str, overall: float) -> DataFrame:
    """One row per hash bucket: at most ``TWO_LABEL_BUCKETS`` rows."""
    blocked = F.sum(F.col("label"))
    n = F.count(F.lit(1))
    return labelled.groupBy(key).agg(((blocked + PRIOR * overall) / (n + PRIOR)).alias(f"{key}_rate"),
                                     F.log1p(n).alias(f"{key}_n"))


def training_urls(labelled: DataFrame, counts: dict, each: int) -> DataFrame:
    """At most ``each`` distinct urls per label, one row per url. Their weights
    follow the rows of a url and add up to what ``each`` rows of the label
    weigh, or all its rows if these are fewer."""
    urls = stage(labelled.groupBy("label", "url_hash").agg(F.count(F.lit(1)).alias("n")), "url-distinct")
    sizes = {r["label"]: r["n"] for r in urls.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = stage(urls.where(lowest(urls, "label", "url_hash", sizes, each)), "url-drawn")
    sums = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    scale = F.create_map(*[F.lit(v) for k, n in sums.items() for v in (k, min(counts[k], each) / n)])
    drawn = drawn.select("label", "url_hash", (F.col("n") * scale[F.col("label")]).alias("weight"))
    # bounded by the sample size, whatever the table's
    rows = labelled.drop("id", "host", "path", "rule", "ruled").join(F.broadcast(drawn), ["label", "url_hash"])
    return stage(rows.dropDuplicates(["label", "url_hash"]), "url-sample")


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
               train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, block_score``
    (the trees' probability of ``block``; null where nothing was learned)."""
    rows = stage(lexical(pages, id_col, url_col, rules), "url-rows")
    labelled = rows.where(F.col("ruled").isNotNull()).withColumn("label", (F.col("ruled") == "block").cast("double"))
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = rows.select(F.col("id").alias(id_col), "host", "path", "rule", "ruled")
    if len(counts) < 2:
        only = "block" if counts.get(1.0) else "allow"
        return base.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.lit(only)).alias("verdict"),
                           F.lit(None).cast("double").alias("block_score"))
    overall = counts[1.0] / sum(counts.values())
    tables = [(k, stage(_suffix_table(labelled, k, overall), f"url-{k}")) for k in ("tld", "domain")]

    def vectors(df):
        for key, t in tables:  # a fixed number of buckets: a proven bound
            df = df.join(F.broadcast(t), key, "left")
        df = df.fillna({"tld_rate": overall, "domain_rate": overall, "tld_n": 0.0, "domain_n": 0.0})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)

    sample = vectors(training_urls(labelled, counts, max(1, train_rows // 2))).select("label", "weight", "features").coalesce(2)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, weightCol="weight").fit(sample)
    scored = model.transform(vectors(rows)).withColumn("block_score", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "block_score")


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
