"""Churn modelling and model evaluation.

Fits are Spark ML estimators over all customers; splits and folds are exactly
stratified by the distributed rank of a row's hash within its class
(deterministic, no driver-side index lists).  Evaluation metrics are exact
aggregations: AUC uses the rank-sum form over distinct scores with one
distributed running count for every score and group, so no step sorts the scored
frame in one task.
"""
from __future__ import annotations

import math
import random
import uuid
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import elapsed_days
from ..functions.prefix import running_sum

# Fixed values of the reference's churn models and decisions.
FEATURES = ("age", "recency", "frequency", "monetary")
CHURN_DAYS = 90
HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
STACK_THRESHOLD = 0.35
F1_THRESHOLD = 0.5
TRAIN_PCT = 80
FOLDS = 5
SEED = 42
SINGLE_GBT = dict(maxIter=100, maxDepth=5, stepSize=0.1)
STACK_BASE = dict(maxIter=150, maxDepth=5, stepSize=0.05)
CHALLENGER = dict(maxIter=100, maxDepth=5, stepSize=0.05)
PROMOTE_MARGIN = 0.01
HALVING_TREES, HALVING_FACTOR = 20, 3       # first rung of the search
FPR_TOLERANCE = 0.05
YOUNG_MAX_AGE, OLD_MIN_AGE = 30, 50


# ---------------------------------------------------------------- dataset --
def churn_dataset(customers: DataFrame, baskets: DataFrame, *, cutoff=None,
                  legacy_label: bool = False, days: int = CHURN_DAYS) -> DataFrame:
    """Feature rows (customer_id, age, recency, frequency, monetary, churn).

    Default (time split): features from baskets up to ``cutoff`` (default:
    latest basket minus ``days``) measured at the cutoff; churn = no basket in
    the ``days`` after it.  ``legacy_label=True`` reproduces the reference:
    churn = recency > 90 on all data (the label is a function of a feature).
    """
    latest = baskets.select(F.max("timestamp")).scalar()
    if legacy_label:
        cut = latest
    else:
        cut = F.timestamp_add("DAY", F.lit(-days), latest) if cutoff is None else F.lit(cutoff).cast("timestamp_ntz")
    if legacy_label:
        agg = baskets.groupBy("customer_id").agg(F.max("timestamp").alias("_last"), F.sum("n_lines").alias("frequency"),
                                                 F.sum("amount_sum").alias("monetary"), F.lit(None).cast("boolean").alias("_active"))
    else:
        # both sides of the cutoff in one pass over the baskets
        before = F.col("timestamp") <= cut
        after = (F.col("timestamp") > cut) & (F.col("timestamp") <= F.timestamp_add("DAY", F.lit(days), cut))
        agg = baskets.groupBy("customer_id").agg(F.max(F.when(before, F.col("timestamp"))).alias("_last"),
                                                 F.sum(F.when(before, F.col("n_lines"))).alias("frequency"),
                                                 F.sum(F.when(before, F.col("amount_sum"))).alias("monetary"),
                                                 F.bool_or(after).alias("_active"))
    feats = (customers.select("customer_id", "age").join(agg, "customer_id", "left")
             .select("customer_id", F.col("age").cast("double").alias("age"),
                     F.coalesce(elapsed_days(cut, F.col("_last")), F.lit(0)).cast("double").alias("recency"),
                     F.coalesce("frequency", F.lit(0)).cast("double").alias("frequency"),
                     F.coalesce(F.col("monetary").cast("double"), F.lit(0.0)).alias("monetary"), "_active"))
    churn = F.col("recency") > days if legacy_label else ~F.coalesce("_active", F.lit(False))
    return feats.withColumn("churn", churn.cast("int")).drop("_active")


def feature_matrix(df: DataFrame, label: str = "churn", id_col: str = "customer_id",
                   out: str = "features") -> DataFrame:
    """All numeric columns except label and id, assembled to a vector."""
    num = [f.name for f in df.schema.fields
           if f.name not in (label, id_col) and f.dataType.typeName() in ("double", "integer", "long", "float")]
    return VectorAssembler(inputCols=num, outputCol=out).transform(df)


def stratified(df: DataFrame, *, label: str = "churn", id_col: str = "customer_id", seed: int = SEED) -> DataFrame:
    """``df`` plus ``_rank`` (1..n in hash order within the row's class) and
    ``_class_n``, from one distributed running count over (class, hash, id)."""
    h = df.withColumn("_one", F.lit(1).cast("long")).withColumn("_hash", F.xxhash64(F.col(id_col), F.lit(seed)))
    cum = running_sum(h, [F.col(label), F.col("_hash"), F.col(id_col)], "_one", "_rank")
    per = cum.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_class_n"), (F.min("_rank") - 1).alias("_before"))   # one row per class
    return (cum.join(per, F.col(label).eqNullSafe(F.col("_class"))).withColumn("_rank", F.col("_rank") - F.col("_before"))
               .select(*df.columns, "_rank", "_class_n"))


def holdout(df: DataFrame, *, id_col: str = "customer_id", label: str = "churn", pct: int = TRAIN_PCT, seed: int = SEED) -> DataFrame:
    """K7: stratified split -> is_train: ``pct`` % of each class, to the row."""
    s = stratified(df, label=label, id_col=id_col, seed=seed)
    return s.select(*df.columns, (F.col("_rank") * 100 <= F.col("_class_n") * pct).alias("is_train"))


def stratified_folds(df: DataFrame, *, k: int = FOLDS, label: str = "churn", id_col: str = "customer_id", seed: int = SEED) -> DataFrame:
    """``fold`` 0..k-1: every fold has each class's share, to the row."""
    s = stratified(df, label=label, id_col=id_col, seed=seed + 1)
    return s.select(*df.columns, F.pmod(F.col("_rank"), F.lit(k)).cast("int").alias("fold"))


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """K9: weight positives by neg/pos (1.0 for negatives)."""
    ratio = df.select(F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def _prob(c: str = "probability") -> Column:
    return vector_to_array(F.col(c))[1]


def risk_tier(p) -> Column:
    """>= 0.7 High, >= 0.4 Medium, else Low."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c >= HIGH_RISK, "High").when(c >= MEDIUM_RISK, "Medium").otherwise("Low")


def train_churn(train: DataFrame, *, params: dict = SINGLE_GBT, label: str = "churn", weighted: bool = False,
                seed: int = SEED):
    """K8 (+K9 with ``weighted``): gradient-boosted trees on the four features."""
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train)
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    if weighted:
        gbt = gbt.setWeightCol("weight")
    return gbt.fit(data)


def score_churn(model, df: DataFrame) -> DataFrame:
    """Probability of churn and risk tier for every row."""
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)
    out = model.transform(vec).withColumn("churn_probability", _prob())
    return out.select(*[c for c in df.columns], "churn_probability",
                      risk_tier("churn_probability").alias("risk_segment"))


# -------------------------------------------------------------- metrics --
def auc_by(scored: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """K13 per group: by columns, auc (ties get average ranks; NULL with one class), n_pos, n_neg."""
    per = (scored.select(*by, F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"))
                 .groupBy(*by, "s").agg(F.count_if(F.col("y") == 1).cast("long").alias("pos"),
                                        F.count(F.lit(1)).cast("long").alias("cnt")))
    cum = running_sum(per, [*[F.col(c) for c in by], F.col("s")], "cnt", "cum")
    rank = F.col("cum") - F.col("cnt") + (F.col("cnt") + 1) / 2.0       # still counts the groups before
    agg = cum.groupBy(*by).agg(F.sum(F.col("pos") * rank).alias("r"), F.min(F.col("cum") - F.col("cnt")).alias("off"),
                               F.sum("pos").alias("n_pos"), F.sum("cnt").alias("n"))
    n1, n0 = F.col("n_pos"), F.col("n") - F.col("n_pos")
    return agg.select(*by, ((F.col("r") - F.col("off") * n1 - n1 * (n1 + 1) / 2.0) / F.nullif(n1 * n0, F.lit(0))).alias("auc"),
                      n1.alias("n_pos"), n0.alias("n_neg"))


def auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Exact ROC AUC -> one row (auc, n_pos, n_neg)."""
    return auc_by(scored, score, label, [])


def auc_of(scored: DataFrame, scores: dict[str, str], label: str, by: list[str] = ()) -> DataFrame:
    """AUC of several score columns in one pass: by columns and a column per
    entry of ``scores`` (output name -> score column)."""
    items = ", ".join(f"'{name}', CAST(`{c}` AS DOUBLE)" for name, c in scores.items())
    long = scored.selectExpr(*by, f"`{label}`", f"stack({len(scores)}, {items}) AS (_name, _score)")
    return auc_by(long, "_score", label, [*by, "_name"]).groupBy(*by).pivot("_name", list(scores)).agg(F.first("auc"))


def f1_at(scored: DataFrame, score: str, label: str, threshold: float = F1_THRESHOLD) -> DataFrame:
    """Precision, recall, F1 of (score > threshold)."""
    pred = F.col(score) > threshold
    y = F.col(label) == 1
    c = scored.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
                   F.count_if(~pred & y).alias("fn"))
    p = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    r = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return c.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"),
                    F.coalesce(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)),
                               F.lit(0.0)).alias("f1"))


def precision_top(scored: DataFrame, score: str, label: str, id_col: str, frac: float = 0.2) -> DataFrame:
    """Share of positives among the top ``frac`` rows by score (ties by id),
    ranked with a distributed running count."""
    ones = scored.select(F.col(score).alias("_s"), F.col(id_col).alias("_id"), F.col(label).alias("_y"),
                         F.lit(1).cast("long").alias("_one"))
    ranked = running_sum(ones, [F.col("_s").desc(), F.col("_id").asc()], "_one", "_rank", total_out="_n")
    k = F.ceil(F.col("_n") * F.lit(frac))
    return ranked.where(F.col("_rank") <= k).agg(F.avg(F.col("_y").cast("double")).alias("precision_top"),
                                                 F.count(F.lit(1)).alias("n_top"))


def fpr_gap(scored: DataFrame, score: str, label: str, *, age: str = "age", threshold: float = F1_THRESHOLD,
            tolerance: float = FPR_TOLERANCE) -> DataFrame:
    """False-positive-rate gap between the < 30 and > 50 age cohorts."""
    cohort = F.when(F.col(age) < YOUNG_MAX_AGE, "young").when(F.col(age) > OLD_MIN_AGE, "old")
    pred = F.col(score) > threshold
    neg = F.col(label) == 0
    per = (scored.where(cohort.isNotNull()).groupBy(cohort.alias("cohort"))
                 .agg((F.count_if(pred & neg) / F.nullif(F.count_if(neg), F.lit(0))).alias("fpr")))
    wide = per.groupBy().pivot("cohort", ["young", "old"]).agg(F.first("fpr"))
    gap = F.abs(F.col("young") - F.col("old"))
    return wide.select(F.col("young").alias("fpr_young"), F.col("old").alias("fpr_old"), gap.alias("fpr_gap"),
                       (gap <= tolerance).alias("within_tolerance"))


def champion_decision(scored: DataFrame, champion: str, challenger: str, label: str, *,
                      margin: float = PROMOTE_MARGIN) -> DataFrame:
    """Promote the challenger when its AUC beats the champion's by > margin."""
    j = auc_of(scored, {"champion_auc": champion, "challenger_auc": challenger}, label)
    promote = F.col("challenger_auc") > F.col("champion_auc") + F.lit(margin)
    return j.select("champion_auc", "challenger_auc", promote.alias("promote_challenger"),
                    F.when(promote, F.lit(f"PROMOTE {challenger}")).otherwise(F.lit(f"KEEP {champion}"))
                    .alias("recommendation"))


# ------------------------------------------------------------- stacking --
def _base_model(kind: str, data: DataFrame, label: str, seed: int):
    """The two base learners: weighted boosted trees and a random forest."""
    if kind == "gbt":
        return GBTClassifier(labelCol=label, seed=seed, weightCol="weight", **STACK_BASE).fit(data)
    return RandomForestClassifier(labelCol=label, seed=seed, numTrees=STACK_BASE["maxIter"],
                                  maxDepth=STACK_BASE["maxDepth"]).fit(data)


def _weighted_vectors(data: DataFrame, label: str) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(class_weights(data, label))


def out_of_fold(data: DataFrame, *, k: int = FOLDS, label: str = "churn", seed: int = SEED,
                parallelism: int = FOLDS) -> DataFrame:
    """K-fold out-of-fold probabilities of the two learners (positives of
    the boosted trees weighted by neg/pos); folds are stratified and every row
    is predicted exactly once by models that never saw it.  The 2k fits are
    independent Spark jobs and are submitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    vec = stratified_folds(_weighted_vectors(data, label).drop("features"), k=k, label=label, seed=seed).checkpoint(eager=True)
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(vec)
    jobs = [(f, kind) for f in range(k) for kind in ("gbt", "rf")]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = dict(zip(jobs, pool.map(lambda job: _base_model(job[1], vec.where(F.col("fold") != job[0]), label, seed), jobs)))
    parts = []
    for f in range(k):
        va = vec.where(F.col("fold") == f)
        pg = models[(f, "gbt")].transform(va).select("customer_id", "fold", label, _prob().alias("p_gbt"))
        pr = models[(f, "rf")].transform(va).select("customer_id", _prob().alias("p_rf"))
        parts.append(pg.join(pr, "customer_id"))
    return reduce(DataFrame.unionByName, parts)


def final_base_models(data: DataFrame, *, label: str = "churn", seed: int = SEED) -> dict:
    """The base learners fitted on all rows, for scoring -> {"gbt", "rf"}."""
    vec = _weighted_vectors(data, label)
    return {kind: _base_model(kind, vec, label, seed) for kind in ("gbt", "rf")}


def stack_weights(oof: DataFrame, *, label: str = "churn") -> DataFrame:
    """Weight of each learner = its mean fold AUC / sum of both."""
    folds = auc_of(oof, {"auc_p_gbt": "p_gbt", "auc_p_rf": "p_rf"}, label, ["fold"])
    j = folds.agg(F.avg("auc_p_gbt").alias("auc_p_gbt"), F.avg("auc_p_rf").alias("auc_p_rf"))
    tot = F.col("auc_p_gbt") + F.col("auc_p_rf")
    return j.select("auc_p_gbt", "auc_p_rf", (F.col("auc_p_gbt") / tot).alias("w_gbt"),
                    (F.col("auc_p_rf") / tot).alias("w_rf"))


def stack_strategy(oof: DataFrame, *, label: str = "churn", threshold: float = STACK_THRESHOLD) -> DataFrame:
    """Weighted average vs logistic meta-learner on the OOF frame; pick
    the higher AUC (ties -> weighted average); F1 at 0.35."""
    w = stack_weights(oof, label=label)
    one = w.select(F.struct("*")).scalar()
    blended = oof.withColumn("p_avg", one["w_gbt"] * F.col("p_gbt") + one["w_rf"] * F.col("p_rf"))
    meta_in = VectorAssembler(inputCols=["p_gbt", "p_rf"], outputCol="meta").transform(blended)
    meta = LogisticRegression(featuresCol="meta", labelCol=label).fit(meta_in)
    scored = meta.transform(meta_in).withColumn("p_meta", _prob()).select("customer_id", label, "p_avg", "p_meta").checkpoint(eager=True)
    f1 = lambda c: f1_at(scored, c, label, threshold).select("f1").scalar()
    j = auc_of(scored, {"auc_weighted": "p_avg", "auc_meta": "p_meta"}, label)
    j = j.select("*", f1("p_avg").alias("f1_weighted"), f1("p_meta").alias("f1_meta"), *[one[c].alias(c) for c in w.columns])
    use_avg = F.col("auc_weighted") >= F.col("auc_meta")
    return j.withColumn("strategy", F.when(use_avg, "validation_weighted_average")
                        .otherwise("logistic_regression_meta")) \
            .withColumn("final_auc", F.when(use_avg, F.col("auc_weighted")).otherwise(F.col("auc_meta"))) \
            .withColumn("final_f1", F.when(use_avg, F.col("f1_weighted")).otherwise(F.col("f1_meta")))


# ------------------------------------------------------- tuning, explain --
def search_space(trials: int, seed: int = SEED) -> list[dict]:
    """Random points of the reference's search space (boosted trees of this
    library have no L1/L2 terms; fixed bounds)."""
    rnd = random.Random(seed)
    return [dict(maxDepth=rnd.randint(3, 9), maxIter=rnd.randint(50, 300),
                 stepSize=math.exp(rnd.uniform(math.log(1e-3), math.log(0.3))), minInstancesPerNode=rnd.randint(1, 10),
                 subsamplingRate=rnd.uniform(0.5, 1.0), featureSubsetStrategy=str(round(rnd.uniform(0.5, 1.0), 3)))
            for _ in range(trials)]


def halving_rungs(trials: int, most: int, *, first: int = HALVING_TREES, factor: int = HALVING_FACTOR) -> list[tuple[int, int]]:
    """(trials still in, trees each may have) per rung: a third of the trials
    go on to three times the trees; the last rung has no limit but their own."""
    out, keep, trees = [], trials, first
    while trees < most and keep > 1:
        out.append((keep, trees))
        keep, trees = max(1, keep // factor), trees * factor
    return [*out, (keep, most)]


def tune_churn(train: DataFrame, test: DataFrame, *, trials: int = 15, label: str = "churn", id_col: str = "customer_id",
               parallelism: int = 8, seed: int = SEED) -> DataFrame:
    """Successive halving over the whole space.  Every trial starts with a few
    trees; by AUC on a stratified validation share of ``train`` a third of them go on
    to three times as many, until the survivors have all the trees they ask for.  A fit
    also stops by itself once the validation loss gets no better.  Boosting is
    deterministic in its seed, so the longer fit of a survivor begins with the trees it
    already had; a trial that stopped early or has its trees is not fitted again.

    One row per trial: rank (last rung first, then AUC on the test split), parameters,
    rung reached, trees fitted, AUC of its last model on the test split."""
    from concurrent.futures import ThreadPoolExecutor

    points = search_space(trials, seed)
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    flagged = holdout(train.select(id_col, *FEATURES, label), id_col=id_col, label=label, seed=seed + 2).withColumn("is_valid", ~F.col("is_train"))
    # all fits and scorings read these few columns: written once
    data = vec.transform(flagged.drop("is_train").checkpoint(eager=True))
    judged, held = data.where("is_valid"), vec.transform(test)

    def fit(i: int, trees: int):
        p = {**points[i], "maxIter": min(trees, points[i]["maxIter"])}
        return GBTClassifier(labelCol=label, seed=seed, validationIndicatorCol="is_valid", validationTol=0.0, **p).fit(data)

    def aucs(models: dict, frame: DataFrame) -> dict:
        """One pass of scoring: a probability column per model, one grouped AUC."""
        for i, m in models.items():
            m.setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_v{i}").setPredictionCol(f"_c{i}")
            frame = m.transform(frame).withColumn(f"p{i}", _prob(f"_v{i}")).drop(f"_r{i}", f"_v{i}", f"_c{i}")
        got = auc_of(frame, {f"a{i}": f"p{i}" for i in models}, label).first()
        return {i: got[f"a{i}"] for i in models}
    better = lambda of: (lambda i: (of[i] is None, -(of[i] or 0.0), i))
    models, reached, going = {}, {}, list(range(trials))
    rungs = halving_rungs(trials, max(p["maxIter"] for p in points))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for rung, (keep, trees) in enumerate(rungs):
            if rung:
                by = aucs({i: models[i] for i in going}, judged)
                going = sorted(going, key=better(by))[:keep]
            # a fit that used up its last allowance may go on
            more = [i for i in going if i not in models or models[i].getNumTrees >= min(points[i]["maxIter"], rungs[rung - 1][1]) and models[i].getNumTrees < points[i]["maxIter"]]
            models.update(zip(more, pool.map(lambda i, trees=trees: fit(i, trees), more)))
            reached.update({i: rung + 1 for i in going})
    final = aucs(models, held)
    order = sorted(range(trials), key=lambda i: (-reached[i], *better(final)(i)))
    rows = [(order.index(i) + 1, p["maxDepth"], p["maxIter"], p["stepSize"], p["minInstancesPerNode"], p["subsamplingRate"],
             float(p["featureSubsetStrategy"]), reached[i], models[i].getNumTrees, final[i]) for i, p in enumerate(points)]
    return train.sparkSession.createDataFrame(rows, "rank int, max_depth int, trees int, step_size double, min_instances int, "
                                                    "subsample double, feature_share double, rung int, fitted_trees int, auc double")


def attributions(df: DataFrame, *, label: str = "churn", id_col: str = "customer_id") -> DataFrame:
    """K19 + E10: exact additive attribution of a logistic model on
    standardised features, coef * (z - mean z) per row and feature, ranked by
    magnitude within the row -> (id, feature, value, attribution, rank)."""
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="raw").transform(df)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(vec)
    z = scaler.transform(vec)
    lr = LogisticRegression(labelCol=label, featuresCol="features").fit(z)
    coefs = [float(c) for c in lr.coefficients]
    zarr = z.select(id_col, vector_to_array("features").alias("z"))
    # standardised features have mean 0, so coef * (z - 0)
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col("z")[i] * F.lit(coefs[i])).alias("attribution"),
                                 F.col("z")[i].alias("value")) for i, f in enumerate(FEATURES)])
    return ranked(zarr.select(id_col, F.explode(entries).alias("e")).select(id_col, "e.*"), id_col)


def ranked(attr: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Rank of each feature within its row, largest |attribution| first."""
    # one partition per entity with as many rows as features: bounded
    w = Window.partitionBy(id_col).orderBy(F.abs("attribution").desc(), "feature")
    return attr.withColumn("rank", F.row_number().over(w))


def global_importance(attr: DataFrame, top: int = 10) -> DataFrame:
    """K20 + F4: mean |attribution| per feature, top N."""
    return attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution")) \
        .orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top)


def tree_importance(model, names: tuple[str, ...] = FEATURES, *, per_tree: bool = False) -> DataFrame:
    """Impurity importance of a fitted tree ensemble from its node table -> feature,
    splits, importance (sum 1).  The saved model's nodes are read as a DataFrame; a
    split's gain counts by the rows that reached it.  Boosted trees add their gains up;
    with ``per_tree`` (forests) every tree's gains sum to one first."""
    from ..session import checkpoint_dir
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    path = f"{checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    node = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").where(F.col("split.featureIndex") >= 0)
    gains = node.groupBy("tree", F.col("split.featureIndex").alias("i")).agg(F.count(F.lit(1)).alias("splits"), F.sum(F.col("gain") * F.col("rawCount")).alias("gain"))
    # a tree has at most one row per feature here
    whole = F.sum("gain").over(Window.partitionBy("tree")) if per_tree else F.lit(1.0)
    share = gains.withColumn("share", F.col("gain") / F.nullif(whole, F.lit(0.0)))
    total = share.groupBy("i").agg(F.sum("splits").alias("splits"), F.sum("share").alias("share"))
    every = F.sum("share").over(Window.partitionBy())      # a row per feature
    labels = F.array(*[F.lit(n) for n in names])
    return total.select(F.get(labels, F.col("i")).alias("feature"), "splits", (F.col("share") / every).alias("importance"))


def feature_map(names: list[str], values: list[Column]) -> Column:
    """{feature: value} map column."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*values))
