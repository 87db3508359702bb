"""URL filters: rules, and boosted trees on lexical features for what no rule decides (operator 10, DataFrame functions and
Spark ML).

Rules (host, path, verdict) fit a host and its subdomains where the path begins with theirs; the longest wins. URLs that a
rule decides are the labelled ones: gradient-boosted trees learn block or allow from the length, depth, digit share,
character entropy, parameter counts and suffix statistics of the URL and judge all others. At most ``fit_rows`` labelled
URLs, those with the smallest hashes, train the trees; suffix statistics count all labelled URLs.

Cases: a null URL or one without ``://`` has an empty host and path and no rule, and is judged by the trees as an empty
string. If the labelled URLs are all of one verdict or there are none, the rest is allowed. Repeated URLs get equal
verdicts. An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import small, stage

FIT_ROWS = 20_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    cut = pages.select("page_id", url.alias("url"), rest.alias("rest"))
    return cut.select(
        "page_id", "url",
        F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, UPPER.lower()).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_text(host: str, path: str) -> str:
    return host + path


def first_rule(rules: list[tuple[str, str, str]], value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(rule_text(*r[:2]))):  # a longer rule is asked before the shorter ones
        host, path = F.col("host"), F.col("path")
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


FEATURES = ["n_chars", "n_host", "n_labels", "depth", "digits", "entropy", "parameters", "marks", "fragment", "extension", "suffix_rate", "suffix_rows"]


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` with the features that follow from the text alone, and ``suffix``, the last label of the host."""
    url, length = F.col("url"), F.length("url")
    # Entropy of characters: the sorted characters' runs give the counts. A URL of n characters has at most n runs.
    letters = F.array_sort(F.split(url, ""))
    runs = F.regexp_extract_all(F.array_join(letters, ""), F.lit(r"(?s)(.)\1*+"), F.lit(0))
    share = lambda run: F.length(run) / length
    entropy = F.aggregate(runs, F.lit(0.0), lambda s, run: s - share(run) * F.log2(share(run)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.select(
        "*",
        length.alias("n_chars"),
        F.length("host").alias("n_host"),
        F.size(F.split("host", r"\.")).alias("n_labels"),
        F.regexp_count("path", F.lit("/")).alias("depth"),
        (F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1))).alias("digits"),
        F.when(length > 0, entropy).otherwise(0.0).alias("entropy"),
        F.when(query == "", 0).otherwise(1 + F.regexp_count(query, F.lit("&"))).alias("parameters"),
        F.regexp_count(url, F.lit("[-_~%+=]")).alias("marks"),
        F.regexp_count(url, F.lit("#")).alias("fragment"),
        F.length(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("extension"),
        F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"),
    )


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability of block by the trees, null without trees)."""
    ruled = parsed(pages).select(
        "*", first_rule(rules, lambda r: rule_text(*r[:2])).alias("rule"), first_rule(rules, lambda r: r[2]).alias("ruled")
    )
    table = stage(lexical(ruled), "urls")
    blocked = (F.col("ruled") == "block").cast("double")
    labelled = table.filter("ruled IS NOT NULL").withColumn("label", blocked)
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocks")).first()
    columns = ["page_id", "host", "path", "rule"]
    if not counts["n"] or counts["blocks"] in (0, counts["n"]):
        return table.select(*columns, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    share = counts["blocks"] / counts["n"]
    suffixes = labelled.groupBy("suffix").agg(((F.sum("label") + 10 * share) / (F.count(F.lit(1)) + 10)).alias("suffix_rate"), F.log1p(F.count(F.lit(1))).alias("suffix_rows"))
    known = small(stage(suffixes, "suffixes"))
    filled = table.join(known, "suffix", "left").fillna({"suffix_rate": share, "suffix_rows": 0.0})
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(filled)
    chosen = vectors.filter("ruled IS NOT NULL").orderBy(F.xxhash64("url"), "url").limit(fit_rows)
    chosen = stage(chosen.select("features", blocked.alias("label")), "labelled-urls")
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7).fit(chosen)
    score = vector_to_array("probability")[1]
    rest = trees.transform(vectors).withColumn("score", score)
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rest.select(*columns, F.coalesce("ruled", method).alias("verdict"), "score")
