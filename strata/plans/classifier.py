"""Weakly supervised text classifier on Spark ML.

Labels come from the weak rule (contains great / amazing / excellent);
the model is trained and applied on the same rows, as in the job it
replaces, but on whole texts (no truncation to a fixed token count):

    RegexTokenizer -> ordered grams -> HashingTF -> Normalizer -> LogisticRegression

The model it replaces reads words in order. So beside its words, a text gives
its word pairs and each word with its place (which eighth of the text), hashed
to ``FEATURES`` columns: texts of the same words in another order have other
features. Texts of either label weigh the same in sum, however rare a label is.

Tokenizing, hashing and the optimiser's gradient steps are distributed; only
``FEATURES`` coefficients reach the driver, and no vocabulary is counted. Texts
are hashed once: their counts of grams, which take a few bytes a gram in files,
are stored in the cluster's shared folder for the fit and the rating, and removed
when both are done. They are not cached: Spark reads a cached partition that went
to disk back into one task's memory, whole and beside the blocks that the
optimiser itself keeps (memory, spilling to disk). Output: id, weak label,
probability of positive, and the Positive / Negative prediction at threshold 0.5.
"""
from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import weak_label
from ..session import setting, shared_copy

FEATURES, PLACES = 1 << 16, 8
#: bytes of a row group of stored counts, rows that a task reads of them at once:
#: a vector may have a hundred thousand entries, and a batch's are held unpacked
GROUP, BATCH = 16 << 20, 64
#: MB of a block of the optimiser; Spark serializes a hundred together
BLOCK_MB = 0.25


def ordered_grams(tokens: str):
    """Words, word pairs and words with their place, of a column of tokens."""
    w = F.col(tokens)
    n = F.size(w)
    pairs = F.when(n > 1, F.zip_with(F.slice(w, F.lit(1), n - 1), F.slice(w, F.lit(2), n - 1),
                                     lambda a, b: F.concat(a, F.lit(" "), b))
                   ).otherwise(F.array().cast("array<string>"))
    placed = F.transform(w, lambda x, i: F.concat(F.floor(i * F.lit(PLACES) / n).cast("string"), F.lit("@"), x))
    return F.flatten(F.array(w, pairs, placed))  # ``concat`` takes longer


def counts(df: DataFrame, text_col: str, out: str = "_counts") -> DataFrame:
    """``df`` with a sparse vector of the counts of the text's grams (null
    text: no grams)."""
    data = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    tokens = RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern="\\W+", toLowercase=True).transform(data)
    grams = tokens.withColumn("_grams", ordered_grams("_tokens"))
    return (HashingTF(inputCol="_grams", outputCol=out, numFeatures=FEATURES).transform(grams)
            .drop("_text", "_tokens", "_grams"))


def normalised(counted: DataFrame, out: str = "_features") -> DataFrame:
    """The vectors of ``counts`` at length one."""
    return Normalizer(inputCol="_counts", outputCol=out).transform(counted).drop("_counts")


def features(df: DataFrame, text_col: str, out: str = "_features") -> DataFrame:
    """``df`` with a normalised sparse vector of the text's grams."""
    return normalised(counts(df, text_col), out)


def fit(feats: DataFrame, label: str = "label", *, max_iter: int = 20, reg: float = 1e-4) -> LogisticRegressionModel:
    """Logistic regression of ``feats`` (a ``label`` of 0 or 1 and
    ``_features``), either label with half of the weight. ``feats`` is read
    three times; the optimiser passes over its own blocks of them."""
    sizes = {r[0]: r[1] for r in feats.groupBy(label).count().collect()}  # two rows
    share = F.when(F.col(label) == 1, F.lit(1.0 / sizes.get(1, 1))).otherwise(F.lit(1.0 / sizes.get(0, 1)))
    weighted = feats.withColumn("_weight", share * (sum(sizes.values()) / max(1, len(sizes))))
    return LogisticRegression(featuresCol="_features", labelCol=label, weightCol="_weight", maxIter=max_iter,
                              regParam=reg, probabilityCol="_prob", standardization=False,
                              maxBlockSizeInMB=BLOCK_MB).fit(weighted)


def rate(feats: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """``p_positive`` and ``sentiment`` (Positive above 0.5) added."""
    p = vector_to_array("_prob")[1]
    return (model.transform(feats).withColumn("p_positive", p)
            .withColumn("sentiment", F.when(F.col("p_positive") > 0.5, "Positive").otherwise("Negative"))
            .drop("_prob", "_features", "rawPrediction", "prediction"))


def classify(df: DataFrame, id_col: str, text_col: str, *, max_iter: int = 20, reg: float = 1e-4) -> DataFrame:
    data = df.select(F.col(id_col), F.col(text_col).alias("_in"), weak_label(text_col).cast("double").alias("label"))
    with (shared_copy(counts(data, "_in").drop("_in"), "grams", **{"parquet.block.size": GROUP}) as counted,
          setting(df.sparkSession, "spark.sql.parquet.columnarReaderBatchSize", str(BATCH))):
        feats = normalised(counted)
        rated = rate(feats, fit(feats, max_iter=max_iter, reg=reg))
        return rated.select(F.col(id_col), F.col("label").cast("int").alias("weak_label"), "p_positive",
                            "sentiment").checkpoint()  # a few bytes a row
