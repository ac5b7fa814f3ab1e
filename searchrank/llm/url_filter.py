"""URL filter: prefix rules first, then gradient-boosted trees on lexical features.

``judge`` applies the longest fitting rule; urls without one get the
verdict of MLlib's gradient-boosted trees, trained on the urls that a rule
labels.  Everything is DataFrame expressions and MLlib (no Python in
tasks).

Features: lengths of url, host and path; depth; number of host labels;
digit ratio; character entropy; number of parameters; fragment; and of the
host's suffix (last label) its share of all urls and its smoothed share of
blocked labels.  Suffix statistics count all rows; a labelled url is given the
share of the other ``FOLDS`` - 1 folds of urls, so that the trees do not read
their answer there.  Only the fit uses a sample: at most ``train_rows`` distinct labelled
urls, the first in order of a hash.  ``evaluate`` fits without a fifth of the
labelled urls and tells the area under the curve on them.

Defined cases: null url, or one without ``://``, has empty host and path
(no rule fits); without any labelled url every remaining verdict is
``allow``; with labels of one kind only, that kind; repeated rows keep their
rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchrank.llm.common import az_lower, stage

#: (verdict, host + path prefix)
Rule = tuple[str, str]
#: Distinct labelled urls the trees are fitted on, at most.
TRAIN_ROWS = 20_000
#: Pseudo-counts that draw the block share of rare suffixes to the overall one.
SMOOTH = 20.0
#: Parts of the urls; one part's labels are left out of the statistic its own urls get.
FOLDS = 5
FEATURES = ["f_len", "f_host", "f_path", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params", "f_fragment",
            "f_suffix_share", "f_suffix_block"]


def host_of(url: Column) -> Column:
    return az_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (both null if none fits)."""
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(slash + rest))
        which = F.when(fits, F.lit(rule)).otherwise(which)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return which, verdict


def _entropy(c: Column) -> Column:
    chars = F.array_remove(F.split(c, ""), "")
    n = F.char_length(c)

    def share(x):
        return (n - F.char_length(F.replace(c, x, F.lit("")))) / n

    return F.coalesce(F.aggregate(F.transform(F.array_distinct(chars), share), F.lit(0.0),
                                  lambda a, p: a - p * F.log2(p)), F.lit(0.0))


def _lexical(d: DataFrame) -> DataFrame:
    u = F.coalesce("url", F.lit(""))
    n = F.char_length(u)
    return d.withColumns({
        "f_len": n.cast("double"), "f_host": F.char_length("host").cast("double"),
        "f_path": F.char_length("path").cast("double"),
        "f_depth": F.array_size(F.array_remove(F.split("path", "/"), "")).cast("double"),
        "f_labels": F.array_size(F.split("host", r"\.")).cast("double"),
        "f_digits": F.coalesce(F.try_divide(F.regexp_count(u, F.lit("[0-9]")).cast("double"), n.cast("double")),
                               F.lit(0.0)),
        "f_entropy": _entropy(u),
        "f_params": F.regexp_count(F.regexp_extract(u, r"(?s)\?([^#]*)", 1), F.lit("[^&]+")).cast("double"),
        "f_fragment": F.contains(u, F.lit("#")).cast("double"),
    })


def _ruled(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, said (its verdict), suffix."""
    d = pages.select("page_id", F.col("url").cast("string").alias("url"))
    d = d.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    return d.withColumn("rule", rule).withColumn("said", said).withColumn("suffix", F.substring_index("host", ".", -1))


def _blocked() -> Column:
    return (F.col("said") == "block").cast("double")


def _featured(d: DataFrame) -> tuple[DataFrame | None, str]:
    """All features of the urls of ``_ruled``; without labels of both kinds None, and the one verdict there is."""
    d = d.withColumn("fold", F.pmod(F.xxhash64("url", F.lit("suffix")), F.lit(FOLDS)))
    part = stage(d.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.count("said").alias("n_said"),
                                                 F.coalesce(F.sum(_blocked()), F.lit(0.0)).alias("n_block")), "suffixes")
    n, n_said, n_block = part.agg(F.sum("n"), F.sum("n_said"), F.sum("n_block")).first()
    if not n_said or n_block in (0, n_said):
        return None, "block" if n_said and n_block else "allow"
    of = Window.partitionBy("suffix")   # FOLDS rows
    part = part.select("suffix", "fold", (F.sum("n").over(of) / F.lit(float(n))).alias("f_suffix_share"),
                       F.sum("n_said").over(of).alias("all_said"), F.sum("n_block").over(of).alias("all_block"),
                       "n_said", "n_block")
    # a labelled url is given the share of the other folds
    mine = F.col("said").isNotNull().cast("double")
    share = (F.col("all_block") - mine * F.col("n_block") + SMOOTH * n_block / n_said) / (
        F.col("all_said") - mine * F.col("n_said") + SMOOTH)
    return _lexical(d.join(part, ["suffix", "fold"])).withColumn("f_suffix_block", share), ""


def _fit(sample: DataFrame, features: Sequence[str], rounds: int, depth: int, seed: int):
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return assemble, GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed).fit(assemble.transform(sample))


def _labelled(d: DataFrame, train_rows: int) -> DataFrame:
    """Distinct labelled urls with their features, the first ``train_rows`` in order of a hash."""
    some = (d.where("said is not null").select("url", _blocked().alias("label"), *FEATURES).distinct()
            .orderBy(F.xxhash64("url"), "url").limit(train_rows))
    return stage(some, "url-sample")


def judge(pages: DataFrame, rules: Sequence[Rule], train_rows: int = TRAIN_ROWS, rounds: int = 20, depth: int = 4,
          seed: int = 7, block_at: float = 0.5) -> DataFrame:
    """(page_id, url) -> page_id, host, path, rule, verdict, block_score (null where a rule decides)."""
    d = _ruled(pages, rules)
    full, only = _featured(d)
    if full is None:
        return d.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(only)).alias("verdict"),
                        F.lit(None).cast("double").alias("block_score"))
    assemble, fit = _fit(_labelled(full, train_rows).drop("url"), FEATURES, rounds, depth, seed)
    scored = fit.setProbabilityCol("p").transform(assemble.transform(full))
    # element 1 of MLlib's probability vector
    p = F.when(F.col("said").isNull(), F.get(_to_array("p"), F.lit(1)))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("said", F.when(p >= block_at, "block").otherwise("allow")).alias("verdict"),
                         p.alias("block_score"))


def evaluate(pages: DataFrame, rules: Sequence[Rule], features: Sequence[str] = FEATURES, train_rows: int = TRAIN_ROWS,
             rounds: int = 20, depth: int = 4, seed: int = 7) -> float | None:
    """Area under the curve on a fifth of the labelled urls, by hash, that the trees have not seen; None without both kinds."""
    full, _ = _featured(_ruled(pages, rules))
    if full is None:
        return None
    sample = _labelled(full, train_rows)
    out = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(5)) == 0
    assemble, fit = _fit(sample.where(~out).drop("url"), features, rounds, depth, seed)
    held = fit.setProbabilityCol("p").transform(assemble.transform(sample.where(out)))
    return BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label").evaluate(held)


def _to_array(name: str) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(name))
