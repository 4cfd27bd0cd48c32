"""URL filter: host and path rules, and boosted trees for urls that no rule fits.

Urls that a rule decides are the labelled ones; gradient-boosted trees learn
their verdicts from lexical features (lengths, depth, digit ratio, character
entropy, parameter counts, and statistics of the host's suffixes: how many pages
share its last and its last two labels and which part of the labelled ones is
blocked) and judge the rest.  Built-in functions and Spark ML only.

The trees are fitted on a bounded sample, the ``sample`` labelled rows with the
smallest hash of their url; suffix statistics count all rows.

Defined cases: a null url, or one without "://", has empty host and path and no
rule, and is judged by the trees like any other; an empty path fits no rule;
among rules of equal length blocking wins; with labels of one kind only the
verdict is that kind, without any it is allow; repeated rows are judged each; an
empty table gives an empty result; other input columns are ignored.
"""
from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import saved

SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 4, 7
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, query (the rest)."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
            .withColumn("rest", rest)
            .withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
            .withColumn("host", F.translate("raw", _UPPER, _UPPER.lower()))
            .withColumn("tail", F.expr("substring(rest, length(raw) + 1)"))
            .withColumn("path", F.regexp_extract("tail", "^[^?#]*", 0))
            .withColumn("query", F.expr("substring(tail, length(path) + 1)"))
            .select("page_id", "url", "host", "path", "query"))


def rule_column(rules: list[tuple[str, str, str]], what: str) -> Column:
    """Verdict or name of the longest rule (host + path) that fits; else null."""
    out = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(verdict if what == "verdict" else host + path)).otherwise(out)
    return out


def _entropy(text: str) -> Column:
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(F.col(text), c, F.lit("")))) / n
    bits = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda s, c: s - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def _features(urls: DataFrame) -> tuple[DataFrame, list[str]]:
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    cols = {
        "f_length": F.length("url"), "f_host_length": F.length("host"), "f_path_length": F.length("path"), "f_query_length": F.length("query"),
        "f_labels": F.size(F.split("host", r"\.")), "f_depth": F.length(F.regexp_replace("path", "[^/]", "")),
        "f_digits": digits("url") / F.greatest(F.length("url"), F.lit(1)), "f_host_digits": digits("host") / F.greatest(F.length("host"), F.lit(1)),
        "f_entropy": _entropy("url"), "f_host_entropy": _entropy("host"),
        "f_parameters": F.length(F.regexp_replace("query", "[^=]", "")), "f_fragment": F.col("query").contains("#").cast("int"),
        "f_hyphens": F.length(F.regexp_replace("host", "[^-]", "")), "f_secure": F.col("url").startswith("https:").cast("int"),
        "f_suffix_length": F.length("suffix1"),
    }
    return urls.select("*", *[c.cast("double").alias(k) for k, c in cols.items()]), list(cols)


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block)."""
    spark = pages.sparkSession
    urls = (parsed(pages).withColumn("rule", rule_column(rules, "name")).withColumn("ruled", rule_column(rules, "verdict"))
            .withColumn("suffix1", F.regexp_extract("host", r"[^.]*$", 0)).withColumn("suffix2", F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0)))
    names = []
    full, names = _features(urls)
    for k in ("suffix1", "suffix2"):
        blocked, labelled = F.sum((F.col("ruled") == "block").cast("int")), F.count("ruled")
        stats = urls.groupBy(k).agg(F.log1p(F.count("*")).alias(f"f_{k}_pages"), ((F.coalesce(blocked, F.lit(0)) + 1) / (labelled + 2)).alias(f"f_{k}_blocked"))
        full = full.join(saved(spark, stats, k), k)
        names += [f"f_{k}_pages", f"f_{k}_blocked"]
    rows = VectorAssembler(inputCols=names, outputCol="f_all").transform(full)
    taken = (full.where("ruled is not null").orderBy(F.xxhash64("url"), "url", "page_id").limit(sample)
             .select((F.col("ruled") == "block").cast("double").alias("label"), *names))
    taken = saved(spark, taken, "labelled-urls")
    kinds = sorted(r.label for r in taken.select("label").distinct().collect())
    if len(kinds) < 2:
        score = F.lit(kinds[0] if kinds else 0.0)
    else:
        trees = GBTClassifier(featuresCol="f_all", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
        rows = trees.fit(VectorAssembler(inputCols=names, outputCol="f_all").transform(taken)).transform(rows)
        score = vector_to_array("probability")[1]
    rows = rows.withColumn("score", score)
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
